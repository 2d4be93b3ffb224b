"""Merging a delta into the dimensions and the article fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.urls import address_mark, article_key
from newsloom.operators.date_dim import date_key
from newsloom.operators.delta import find_changes, newest_articles
from newsloom.operators.dimensions import resolve_keys
from newsloom.schemas import ARTICLE_FACT, ARTICLE_ID, FACT_BUCKETS, MONTH

# Colliding article keys are told apart by the address.
FACT_KEY = ["article_key", "article_url"]


def buffer_rows(delta: DataFrame) -> DataFrame:
    """Rows of the delta file with their times typed again."""
    return delta.withColumns({
        c: F.col(c).try_cast("timestamp") for c in ("published_at", "scraped_at")
    })


def fact_rows(buffer: DataFrame, dim_category: DataFrame, dim_source: DataFrame,
              dim_author: DataFrame) -> DataFrame:
    """Fact rows of the newest version of each article of the buffer, a file table."""
    keyed = resolve_keys(newest_articles(buffer, buffer_rows), {
        "category_name": dim_category, "source_name": dim_source, "author_name": dim_author,
    })
    day = F.to_date("published_at")
    full = keyed.withColumns({
        "article_key": article_key(F.col("article_url")),
        "address_mark": address_mark(F.col("article_url")),
        "bucket": F.pmod(article_key(F.col("article_url")), F.lit(FACT_BUCKETS)),
        "date_key": date_key(day),
        "article_year": F.year(day),
        "article_month": F.month(day),
    })
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ARTICLE_FACT.fields])


def touched_months(rows: DataFrame, old: DataFrame) -> DataFrame:
    """Months whose counts may change: those of the rows of a delta, and those where the fact held these articles before."""
    names = [f.name for f in MONTH.fields]
    return rows.select(*names).unionByName(old.select(*names)).distinct()


def moved_articles(changes: DataFrame, old: DataFrame) -> DataFrame:
    """`ARTICLE_ID` and the new month of changed articles that the fact held in another month."""
    before = old.select(*FACT_KEY, *[F.col(f.name).alias(f"_{f.name}") for f in MONTH.fields])
    stays = F.lit(True)
    for f in MONTH.fields:
        stays = stays & F.col(f.name).eqNullSafe(F.col(f"_{f.name}"))
    return changes.select(*ARTICLE_ID, "article_url", *[f.name for f in MONTH.fields]).join(before, FACT_KEY).filter(
        ~stays).select(*ARTICLE_ID, *[f.name for f in MONTH.fields])


def changed_facts(rows: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows to insert or update, with the kind in `change`; unchanged ones are left out."""
    return find_changes(rows, fact, FACT_KEY, "row_mark")
