"""News warehouse jobs for Spark: extract, stage, merge, aggregate, publish."""
