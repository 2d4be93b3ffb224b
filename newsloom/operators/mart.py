"""Monthly article counts and top trends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.schemas import ARTICLE_ID, MONTH
from newsloom.sources.csv_files import read_mart_file
from newsloom.sources.publication import publish
from newsloom.sources.tables import in_places


def monthly_counts(fact: DataFrame, bridge: DataFrame, category: str = "category_key",
                   tag: str = "tag_key", source: str = "source_key") -> DataFrame:
    """Articles by year, month, category, tag and source.

    `fact` holds an article once; repeated pairs in `bridge` count once. The
    tags of an article are folded into a set before the join, in each task
    first, so that the join moves one row per article and its output needs no
    further distinct.
    """
    tags = bridge.groupBy(*ARTICLE_ID).agg(F.collect_set(tag).alias("_tags"))
    return (
        fact.select(*ARTICLE_ID, "article_year", "article_month", category, source)
        .join(tags, ARTICLE_ID)
        .select("article_year", "article_month", category, F.explode("_tags").alias(tag), source)
        .groupBy("article_year", "article_month", category, tag, source)
        .agg(F.count("*").alias("total_articles"))
    )


def recounted(fact: DataFrame, bridge: DataFrame, months: Sequence[tuple[int | None, int | None]]) -> DataFrame:
    """Monthly counts of some months only, for tables partitioned by month: the others are not read."""
    names = [f.name for f in MONTH.fields]
    return monthly_counts(fact.filter(in_places(names, months)), bridge.filter(in_places(names, months)))


def top_trends(counts: DataFrame, k: int, tag: str = "tag_key") -> DataFrame:
    """The `k` tags with the most articles in each month; ties go by tag."""
    month = ["article_year", "article_month"]
    totals = counts.groupBy(*month, tag).agg(F.sum("total_articles").alias("total_articles"))
    best = Window.partitionBy(*month).orderBy(F.desc("total_articles"), F.col(tag))
    return totals.withColumn("trend_rank", F.row_number().over(best)).filter(F.col("trend_rank") <= k)


def load_mart(spark: SparkSession, paths: Mapping[str, str], database: str) -> dict[str, int]:
    """Load one file per mart table and publish all as one; a missing file stops it before any write."""
    return publish(spark, database, {table: read_mart_file(spark, path) for table, path in paths.items()})
