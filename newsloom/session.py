"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

ADAPTIVE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a partition that one hot key has blown up, also when that costs a later shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "newsloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session for running the jobs by hand; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    for key, value in ADAPTIVE_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder; on a
    cluster the setting is required, as executors must all see the folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    chosen = context.getCheckpointDir()
    if chosen:
        return chosen.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="newsloom-"))
    return context.getCheckpointDir().rstrip("/")


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of a block; the caller's own value comes back after it."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and go on from the written table.

    Cuts the lineage and fixes values such as row slots, so that every later
    read, also one after a lost executor, sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._scratch = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete tables of `materialize` that nothing will read again: what came from them is written, too."""
    for df in written:
        folder = getattr(df, "_scratch", None)
        if folder:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def materialize_observed(df: DataFrame, label: str, metrics: Sequence[Column]) -> tuple[DataFrame, dict]:
    """The same, with aggregates over the rows, taken as they are written."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    df.observe(seen, *metrics).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get


def spread(df: DataFrame) -> DataFrame:
    """Deal out a table just read, if its files are too few for all cores, before costly work per row.

    A table of many files is left as it is. Not for results of joins or
    aggregations: finding their number of partitions would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
