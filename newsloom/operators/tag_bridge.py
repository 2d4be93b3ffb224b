"""Keeping the article-tag bridge in step with the tag lists of a delta.

For each delta row with tags, the keys of its known tags are compared with the
keys that the bridge holds for the article. Equal: nothing happens. Different:
all bridge rows of the article go, and the new keys come in. Every row is
compared with the bridge as it was before the run.

Articles are told apart by `ARTICLE_ID`: two addresses of one CRC keep their own tags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.tags import has_tags, split_tags
from newsloom.functions.urls import with_article_id
from newsloom.operators.lookup import lookup, with_keys
from newsloom.schemas import ARTICLE_ID


def tag_names(rows: DataFrame) -> DataFrame:
    """One row per name in `tags`."""
    return rows.filter(has_tags(F.col("tags"))).withColumn("tag_name", F.explode(split_tags(F.col("tags"))))


def known_tags(names: DataFrame, dim_tag: DataFrame) -> DataFrame:
    """Put keys to tag names, exactly as written; unknown names are left out."""
    return lookup(names, dim_tag.select("tag_name", "tag_key"), "tag_name", "inner")


def new_tag_sets(delta: DataFrame, dim_tag: DataFrame) -> DataFrame:
    """`ARTICLE_ID`, `tags`, `n_rows`, `new_keys`: the key set of every distinct tag list of an article.

    Equal rows are counted up first: one article may fill much of the delta.
    The set holds at most the tags written in one row.
    """
    lists = (
        with_article_id(delta.filter(has_tags(F.col("tags"))))
        .groupBy(*ARTICLE_ID, "tags").agg(F.count("*").alias("n_rows"))
    )
    names = lists.withColumn("tag_name", F.explode(F.array_distinct(split_tags(F.col("tags")))))
    # A left join, so that a list of unknown names stays, with an empty set.
    keyed = lookup(names, dim_tag.select("tag_name", "tag_key"), "tag_name", "left")
    return keyed.groupBy(*ARTICLE_ID, "tags").agg(
        F.first("n_rows").alias("n_rows"),
        F.array_sort(F.collect_set("tag_key")).alias("new_keys"),
    )


def compare_with_bridge(sets: DataFrame, bridge: DataFrame) -> DataFrame:
    """Add `changed`: does the new set differ from the bridge's?"""
    current = (
        with_keys(bridge, sets, ARTICLE_ID)
        .groupBy(*ARTICLE_ID).agg(F.array_sort(F.collect_set("tag_key")).alias("old_keys"))
    )
    old = F.coalesce("old_keys", F.array().cast("array<bigint>"))
    return sets.join(current, ARTICLE_ID, "left").select(
        *ARTICLE_ID, "n_rows", "new_keys", (F.col("new_keys") != old).alias("changed"))


def replaced_articles(compared: DataFrame) -> DataFrame:
    """Articles whose bridge rows are deleted."""
    return compared.filter("changed").select(*ARTICLE_ID).distinct()


def new_pairs(compared: DataFrame) -> DataFrame:
    """Pairs that come in; a pair named by several rows comes once."""
    return compared.filter("changed").select(
        *ARTICLE_ID, F.explode("new_keys").alias("tag_key")).distinct()


def synced_bridge(bridge: DataFrame, compared: DataFrame) -> DataFrame:
    kept = bridge.join(replaced_articles(compared), ARTICLE_ID, "left_anti")
    return kept.select(*ARTICLE_ID, "tag_key").unionByName(new_pairs(compared))


def sync_metrics() -> list[Column]:
    """Delta rows that led to an update, and rows that were skipped, as aggregates over compared sets."""
    return [
        F.coalesce(F.sum(F.when(F.col("changed"), F.col("n_rows"))), F.lit(0)).alias("updated"),
        F.coalesce(F.sum(F.when(~F.col("changed"), F.col("n_rows"))), F.lit(0)).alias("skipped"),
    ]


def sync_counts(compared: DataFrame) -> DataFrame:
    return compared.agg(*sync_metrics())


def insert_if_absent(bridge: DataFrame, pairs: DataFrame) -> DataFrame:
    """Append the pairs that the bridge does not hold yet."""
    key = [*ARTICLE_ID, "tag_key"]
    fresh = pairs.select(*key).distinct().join(bridge.select(*key), key, "left_anti")
    return bridge.select(*key).unionByName(fresh)
