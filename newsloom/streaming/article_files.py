"""Daily article files as a file stream into staging."""

from __future__ import annotations

from pyspark.sql import SparkSession

from newsloom.operators.staging import stage_rows
from newsloom.schemas import ARTICLE_CSV, text_columns


def stage_new_files(spark: SparkSession, folder: str, pattern: str, table: str, progress: str,
                    run_id: str) -> None:
    """Append the files that have come since the last run, each exactly once, and stop.

    A stream reads columns by their place; a file whose header is not that of the article files stops it.
    `progress` is the stream's checkpoint folder, on storage that all executors share.
    """
    raw = (
        spark.readStream.schema(text_columns(*ARTICLE_CSV))
        .options(header=True, multiLine=True, escape='"', encoding="UTF-8", enforceSchema=False)
        .csv(f"{folder.rstrip('/')}/{pattern}")
    )
    query = (
        stage_rows(raw, run_id).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", progress).trigger(availableNow=True).toTable(table)
    )
    query.awaitTermination()
