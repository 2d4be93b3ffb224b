"""Raw article rows -> staging rows -> clean rows -> typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import parse_published, parse_time
from newsloom.functions.html import clean_content
from newsloom.functions.nulls import column_or_blank
from newsloom.functions.text import trim_spaces
from newsloom.operators.ordering import arrival_ids
from newsloom.schemas import CLEAN_COLUMNS, DELTA_COLUMNS, RAW_TO_STAGING, STAGING_COLUMNS


def stage_rows(raw: DataFrame, run_id: str) -> DataFrame:
    """Rename and order the raw columns, `''` for what is missing, under the loader's own run id."""
    named = {new: column_or_blank(raw, old) for old, new in RAW_TO_STAGING.items()}
    named["run_id"] = F.lit(run_id)
    return raw.select(*[named[c].alias(c) for c in STAGING_COLUMNS])


def clean_rows(staged: DataFrame, fix_quotes: bool = False) -> DataFrame:
    """Only the content is rewritten; the run id is left out."""
    content = clean_content(F.col("content"), fix_quotes)
    return staged.select(*[(content if c == "content" else F.col(c)).alias(c) for c in CLEAN_COLUMNS])


def clean_rows_with_ids(staged: DataFrame) -> DataFrame:
    """Clean rows of a file table under dense ids in the order of their arrival; the rows stay where they are."""
    numbered = arrival_ids(staged, "id")
    return numbered.select("id", *[
        (clean_content(F.col("content")) if c == "content" else F.col(c)).alias(c) for c in CLEAN_COLUMNS
    ])


def transform_rows(clean: DataFrame, run_id: str) -> DataFrame:
    """Typed rows for the delta: names trimmed, times parsed, stamped with the run id."""
    trimmed = {
        "article_url": "article_url", "source_name": "source_name", "category": "category_name",
        "author": "author_name", "published_at": "published_at", "title": "title",
        "summary": "description", "scraped_at": "scraped_at", "tags": "tags",
    }
    texts = clean.select("content", *[trim_spaces(F.col(old)).alias(new) for old, new in trimmed.items()])
    return texts.withColumns({
        "published_at": F.coalesce(parse_time(F.col("published_at")), parse_published(F.col("published_at"))),
        "scraped_at": parse_time(F.col("scraped_at")),
        "run_id": F.lit(run_id),
    }).select(*DELTA_COLUMNS)


def rows_per_run(rows: DataFrame) -> DataFrame:
    return rows.groupBy("run_id").agg(F.count("*").alias("n_rows"))
