"""Row numbers and running totals over a whole table, without one task seeing it all.

Rows of a file table are numbered as they lie in its files (`arrival_ids`): a row's number is its place in the file, plus the rows
of all files before, so the rows are not moved, sorted or copied. For another order

rows are range-partitioned and sorted, written once, and then shifted by the
total of the partitions before theirs. Only that list of totals, one entry per
partition, is summed up in a single task and broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.lookup import KEY_SET_BYTES, lookup
from newsloom.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row within it below


def _in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def _shift_per_part(parts: DataFrame) -> DataFrame:
    """`_part`, `_sum` -> `_part`, `_shift`: the sum over all parts before."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_shift"))


def number_rows(df: DataFrame, order: Sequence[str], name: str, first: int | Column = 1) -> DataFrame:
    """Add dense numbers in the given order, counting from `first`."""
    placed = materialize(
        _in_order(df, order).withColumn("_slot", F.monotonically_increasing_id()), "numbered"
    )
    placed = placed.withColumn("_part", F.shiftright("_slot", _ROW_BITS))
    shifts = _shift_per_part(placed.groupBy("_part").agg(F.count("*").alias("_sum")))
    row = F.col("_slot").bitwiseAND((1 << _ROW_BITS) - 1)
    start = F.lit(first) if isinstance(first, int) else first
    return placed.join(F.broadcast(shifts), "_part").select(
        *df.columns, (F.col("_shift") + row + start).cast("bigint").alias(name)
    )


def arrival_ids(table: DataFrame, name: str, first: int = 1) -> DataFrame:
    """Add dense numbers to the rows of a scan of parquet files, by file path and place in the file.

    The same files give the same numbers, in every scan and however they are split between tasks. Only one row per file is
    summed up in a single task; within a measured bound these are broadcast.
    """
    located = table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = located.groupBy("_file").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    shifts = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    placed = lookup(located, shifts, "_file", "inner", max_bytes=KEY_SET_BYTES)
    return placed.select(*table.columns, (F.col("_shift") + F.col("_row") + first).alias(name))


def running_total(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Add the sum of `value` over all rows up to each, in the given order."""
    placed = materialize(
        _in_order(df, order).withColumn("_part", F.spark_partition_id()), "running"
    )
    shifts = _shift_per_part(placed.groupBy("_part").agg(F.sum(value).alias("_sum")))
    so_far = Window.partitionBy("_part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return placed.join(F.broadcast(shifts), "_part").select(
        *df.columns, (F.col("_shift") + F.sum(value).over(so_far)).cast("bigint").alias(name)
    )
