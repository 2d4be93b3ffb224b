"""New and changed articles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.nulls import null_tokens
from newsloom.functions.urls import row_mark
from newsloom.operators.lookup import KEY_SET_BYTES, measured_bytes, with_keys
from newsloom.operators.ordering import arrival_ids
from newsloom.session import materialize

# What makes an article row differ; crawl time and run id do not.
MARKED_COLUMNS = [
    "source_name", "category_name", "author_name", "published_at", "title", "description", "content", "tags",
]


def article_mark(rows: DataFrame, columns: Sequence[str] = MARKED_COLUMNS) -> Column:
    """Row digest that is the same before and after the delta file, where tokens become NULL."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    parts = [
        (null_tokens(F.col(c)) if isinstance(types[c], T.StringType) else F.col(c).cast("string")).alias(c)
        for c in columns
    ]
    return row_mark(*parts)


def latest_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by `order`.

    Spark cuts each task's rows to one per key before the shuffle, so a key
    with very many rows does not gather in one place.
    """
    ranked = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def find_changes(incoming: DataFrame, known: DataFrame, key: Sequence[str], mark: str) -> DataFrame:
    """Rows whose key is not known (`insert`) or known under another mark (`update`).

    Both sides hold a key once. Of the known side only key and mark are read,
    and only those of incoming keys go into the join.
    """
    old = with_keys(known.select(*key, F.col(mark).alias("_old_mark")), incoming, key)
    change = F.when(F.col("_is_known").isNull(), "insert").when(
        ~F.col(mark).eqNullSafe(F.col("_old_mark")), "update")
    return (
        incoming.join(old.withColumn("_is_known", F.lit(True)), list(key), "left")
        .withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .drop("_old_mark", "_is_known")
    )


def _newest_places(rows: DataFrame) -> DataFrame:
    """`article_url`, `row_mark`, `_id` of the latest row of each address; rows equal in time and mark go by place."""
    narrow = rows.select("article_url", "scraped_at", article_mark(rows).alias("row_mark"), "_id")
    newest = latest_per_key(narrow, ["article_url"], [F.col("scraped_at").desc_nulls_last(), F.col("row_mark"), F.col("_id")])
    return newest.drop("scraped_at")


def _fetched(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The whole rows at written `places` with the columns these add: while the places fit a broadcast, rows are only scanned."""
    wanted = places.drop("article_url")
    if measured_bytes(wanted) <= KEY_SET_BYTES:
        return rows.join(F.broadcast(wanted), "_id").drop("_id")
    return rows.join(wanted.hint("shuffle_hash"), "_id").drop("_id")


def newest_articles(table: DataFrame, typed: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """The latest row of each address in a file table whose columns `typed` gives their types, with its mark in `row_mark`.

    Rows are chosen by address, time, mark and place alone; texts are read for the chosen ones.
    """
    rows = typed(arrival_ids(table, "_id"))
    return _fetched(rows, materialize(_newest_places(rows), "newest"))


def staging_delta(transformed: DataFrame, known: DataFrame) -> DataFrame:
    """The delta of one load, a file table: latest row per address, kept if new or changed.

    `known` holds `article_url` and `row_mark` of the articles in the warehouse. What is new or changed is found by
    address, mark and place of the rows; texts are read for those rows only, and not sorted.
    """
    rows = arrival_ids(transformed, "_id")
    newest = materialize(_newest_places(rows), "newest")
    return _fetched(rows, materialize(find_changes(newest, known, ["article_url"], "row_mark"), "changed"))
