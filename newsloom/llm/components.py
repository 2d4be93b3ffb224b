"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.session import materialize, setting

#: Links (some 32 bytes each) up to which a turn is planned once and runs as one job, in a task for each core.
FEW_LINKS = 100_000


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


@contextmanager
def _planned_once(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution makes a job of each exchange and plans anew after it, all of which the driver keeps for a while."""
    tasks = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with setting(spark, "spark.sql.adaptive.enabled", "false"), setting(spark, "spark.sql.shuffle.partitions", str(tasks)):
        yield


def components(links: DataFrame) -> DataFrame:
    """(node, label) for all nodes of links (a, b); label is the smallest node that links lead to.

    Alternates two steps until nothing changes: every node's larger neighbours, then its smaller ones, are linked to the
    smallest of its neighbourhood. All work is grouping and joining by node, with partial minima, so that a node with a
    large part of all links is no hot spot; a chain of n links needs about log n turns.
    """
    edges = materialize(links.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    if edges.count() <= FEW_LINKS:
        with _planned_once(edges.sparkSession):
            edges = _stars(edges)
    else:
        edges = _stars(edges)
    leaders = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        leaders.select(F.col("b").alias("node"), F.col("b").alias("label")))


def _stars(edges: DataFrame) -> DataFrame:
    """Links (a, b), a > b, turned into one from each node to the smallest that it leads to, on disk."""
    before = None
    while True:
        edges = materialize(_turn(edges), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges
        before = state


def _turn(edges: DataFrame) -> DataFrame:
    # Minima lie where they are joined, so they are not sent through the driver, however few they are.
    # Larger neighbours go to the least of the neighbourhood.
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    large = around.filter("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.distinct()
    # Then each node's smaller neighbours, and itself, go to the least of these.
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least.hint("merge"), "a")
    return small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b") \
        .unionByName(least.select("a", F.col("m").alias("b"))).distinct()
