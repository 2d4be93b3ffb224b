"""Picking the newest file of a folder."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Scheme and host of a location.
_SCHEME = "^[a-z0-9]+:(//[^/]*(?=/))?"


def newest_file(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """The entry of `folder` that was modified last: `path`, `modified`.

    `pattern` is a glob for the entries, which may be files or folders of part
    files. Only file listings are read. Of entries with the same time the last
    by name is taken.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .load(f"{folder.rstrip('/')}/{pattern}")
        .select("path", "modificationTime")
    )
    data_file = ~F.substring_index("path", "/", -1).rlike(r"^[_.]")
    local_folder = re.sub(_SCHEME, "", folder.rstrip("/"))
    local = F.regexp_replace("path", _SCHEME, "")
    entry = F.substring_index(F.substr(local, F.lit(len(local_folder) + 2)), "/", 1)
    per_entry = files.filter(data_file).groupBy(entry.alias("entry")).agg(
        F.max("modificationTime").alias("modified"))
    return per_entry.agg(F.max_by("entry", F.struct("modified", "entry")).alias("entry"),
                         F.max("modified").alias("modified")).filter(
        F.col("entry").isNotNull()).select(
        F.concat(F.lit(folder.rstrip("/") + "/"), "entry").alias("path"), "modified")


def newest_path(spark: SparkSession, folder: str, pattern: str) -> str | None:
    found = newest_file(spark, folder, pattern).first()
    return found["path"] if found else None
