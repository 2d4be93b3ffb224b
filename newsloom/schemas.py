"""Column orders, table schemas and fixed tokens of the layers."""

from __future__ import annotations

from pyspark.sql import types as T


def text_columns(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column names and orders of the files and tables that the jobs exchange.
ARTICLE_CSV = [
    "article_url", "source_name_raw", "category_raw", "author_raw", "published_at_raw",
    "title_raw", "summary_raw", "content_raw", "tags_raw", "scraped_at", "run_id",
]
STAGING_COLUMNS = [
    "article_url", "source_name", "category", "author", "published_at", "title",
    "summary", "content", "scraped_at", "run_id", "tags",
]
CLEAN_COLUMNS = [
    "article_url", "source_name", "category", "author", "published_at", "title",
    "summary", "content", "tags", "scraped_at",
]
DELTA_COLUMNS = [
    "article_url", "source_name", "category_name", "author_name", "published_at", "title",
    "description", "content", "scraped_at", "run_id", "tags",
]
AGGREGATE_COLUMNS = [
    "article_year", "article_month", "category_key", "tag_key", "source_key", "total_articles",
]
# Position in the wide date file -> column of the date dimension.
DATE_POSITIONS = {
    0: "date_key", 1: "full_date", 4: "day_of_week", 5: "month_name",
    6: "year", 8: "day_of_month", 18: "holiday", 19: "day_type",
}
# Raw file column -> staging column.
RAW_TO_STAGING = {
    "article_url": "article_url", "source_name_raw": "source_name", "category_raw": "category",
    "author_raw": "author", "published_at_raw": "published_at", "title_raw": "title",
    "summary_raw": "summary", "content_raw": "content", "scraped_at": "scraped_at",
    "tags_raw": "tags",
}
# Text put where a field was not found on a page.
NOT_FOUND = "N/A"
# Cell texts that the warehouse load reads as NULL (the default set of the pandas CSV reader).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# End of fixed values.

# What names an article in the warehouse: the CRC-32 of its address, and 60 further bits, as CRCs collide.
ARTICLE_ID = ["article_key", "address_mark"]
# A month of the fact is split into so many buckets, which a merge rewrites one by one.
FACT_BUCKETS = 16

STAGING = text_columns(*STAGING_COLUMNS)
DELTA = text_columns(*DELTA_COLUMNS)

CLEAN = T.StructType([T.StructField("id", T.LongType())] + text_columns(*CLEAN_COLUMNS).fields)

TRANSFORMED = T.StructType([
    T.StructField(f.name, T.TimestampType() if f.name in ("published_at", "scraped_at") else f.dataType)
    for f in DELTA.fields
])

DATE_DIM = T.StructType([
    T.StructField("date_key", T.IntegerType()),
    T.StructField("full_date", T.DateType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("day_of_month", T.IntegerType()),
    T.StructField("holiday", T.StringType()),
    T.StructField("day_type", T.StringType()),
])

ARTICLE_FACT = T.StructType([
    T.StructField("article_key", T.LongType()),
    T.StructField("address_mark", T.LongType()),
    T.StructField("article_url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("date_key", T.IntegerType()),
    T.StructField("category_key", T.LongType()),
    T.StructField("source_key", T.LongType()),
    T.StructField("author_key", T.LongType()),
    T.StructField("scraped_at", T.TimestampType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("row_mark", T.StringType()),
    T.StructField("article_year", T.IntegerType()),
    T.StructField("article_month", T.IntegerType()),
    T.StructField("bucket", T.IntegerType()),
])

MONTH = T.StructType([
    T.StructField("article_year", T.IntegerType()),
    T.StructField("article_month", T.IntegerType()),
])

BRIDGE = T.StructType([
    T.StructField("article_key", T.LongType()),
    T.StructField("address_mark", T.LongType()),
    T.StructField("tag_key", T.LongType()),
])

# Pairs lie in the month of their article.
BRIDGE_BY_MONTH = T.StructType(BRIDGE.fields + MONTH.fields)

MART_AGGREGATE = T.StructType([
    T.StructField(c, T.IntegerType() if c in ("article_year", "article_month") else T.LongType())
    for c in AGGREGATE_COLUMNS
])

RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("config_id", T.LongType()),
    T.StructField("job_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("extracted", T.LongType()),
    T.StructField("loaded", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
])


def dimension(prefix: str) -> T.StructType:
    return T.StructType([
        T.StructField(f"{prefix}_key", T.LongType()),
        T.StructField(f"{prefix}_name", T.StringType()),
    ])
