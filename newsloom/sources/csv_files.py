"""CSV files that the jobs take in and hand on.

Cells may hold line breaks and quotes, so every reader takes quoted line
breaks and doubled quotes. Such a file cannot be split between tasks; the
writers therefore write a folder of part files, which is read in parallel.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.nulls import blank_for_null, tokens_to_null
from newsloom.schemas import AGGREGATE_COLUMNS, ARTICLE_CSV, DATE_POSITIONS, DELTA, DELTA_COLUMNS

# The line end is taken from the first one in the file, so after the header; files without a header
# that may hold line breaks in their cells are told theirs.
_READ = {"multiLine": True, "escape": '"', "encoding": "UTF-8", "enforceSchema": False}
_WRITE = {
    "escape": '"', "emptyValue": "", "nullValue": "", "encoding": "UTF-8",
    "lineSep": "\n", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def read_with_header(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All columns of the header as text, blank cells as NULL; a byte-order mark is dropped."""
    return spark.read.options(header=True, inferSchema=False, **_READ).csv(path)


def _counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """The number of rows that `write` writes, counted on the way."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def write_with_header(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, **_WRITE).csv(path)


# --- articles ---------------------------------------------------------------------------------

def read_articles(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Raw article rows; columns are found by name, missing ones give `''`."""
    raw = read_with_header(spark, path)
    names = [c.lstrip("﻿") for c in raw.columns]
    return raw.toDF(*names)


def write_daily_articles(df: DataFrame, path: str, day: Column, fmt: str = "parquet") -> int:
    """Articles under a folder per crawl day; writing a day again replaces that day only. Rows written."""
    def write(rows: DataFrame) -> None:
        writer = rows.write.mode("overwrite").partitionBy("crawl_date").option("partitionOverwriteMode", "dynamic")
        if fmt == "csv":
            writer = writer.options(header=True, **_WRITE)
        writer.format(fmt).save(path)

    return _counted(df.select(*ARTICLE_CSV).withColumn("crawl_date", day), write)


# --- delta ------------------------------------------------------------------------------------

def write_delta(df: DataFrame, path: str) -> int:
    """Headerless, in the column order that the warehouse load counts on; times as text. Rows written."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in DELTA_COLUMNS])
    return _counted(texts, lambda rows: rows.write.mode("overwrite").options(header=False, **_WRITE).csv(path))


def read_delta(spark: SparkSession, path: str) -> DataFrame:
    """Headerless rows under the given names, with the NULL tokens read as NULL."""
    return tokens_to_null(spark.read.schema(DELTA).options(header=False, lineSep="\n", **_READ).csv(path))


# --- date dimension ---------------------------------------------------------------------------

def read_wide_dates(spark: SparkSession, path: str) -> DataFrame:
    """Headerless wide rows, `_c0`, `_c1`, ... as text."""
    wide = spark.read.options(header=False, inferSchema=False, **_READ).csv(path)
    if len(wide.columns) <= max(DATE_POSITIONS):
        raise ValueError(f"date file has {len(wide.columns)} columns, {max(DATE_POSITIONS) + 1} needed")
    return wide


def write_wide_dates(wide: DataFrame, path: str) -> None:
    wide.write.mode("overwrite").options(header=False, **_WRITE).csv(path)


# --- mart -------------------------------------------------------------------------------------

def mart_paths(folder: str, day: str) -> dict[str, str]:
    """Mart table -> its dated file."""
    # Tables and file names of the mart exchange.
    files = {
        "Agg_Mart_Top_Trends": "agg_mart_data",
        "DimCategory": "dim_category",
        "DimTag": "dim_tag",
        "DimSource": "dim_source",
    }
    return {table: f"{folder}/{name}_{day}.csv" for table, name in files.items()}


def dump_tables(tables: Mapping[str, DataFrame], paths: Mapping[str, str]) -> int:
    """Write every table to its file, the aggregate with its named columns only; the number of files."""
    for name, df in tables.items():
        wanted = AGGREGATE_COLUMNS if set(AGGREGATE_COLUMNS) <= set(df.columns) else df.columns
        write_with_header(df.select(*wanted), paths[name])
    return len(tables)


def proper_columns(df: DataFrame) -> DataFrame:
    """Trim the header and drop columns without a real name."""
    trimmed = df.toDF(*[c.strip() for c in df.columns])
    # Names that index columns and blank headers get.
    nameless = {"nan", "unnamed: 0", ""}
    return trimmed.select(*[f"`{c}`" for c in trimmed.columns if c.lower() not in nameless])


def read_mart_file(spark: SparkSession, path: str) -> DataFrame:
    """Blanks and tokens stay text here."""
    return proper_columns(blank_for_null(read_with_header(spark, path)))


# --- configuration ----------------------------------------------------------------------------

def read_config(spark: SparkSession, path: str, today: Column | None = None) -> DataFrame:
    """Whatever columns the file has, with types guessed, and the date added if it has none."""
    config = tokens_to_null(spark.read.options(header=True, inferSchema=True, **_READ).csv(path))
    if "date_dim" in config.columns:
        return config
    return config.withColumn("date_dim", (today if today is not None else F.current_date()).cast(T.DateType()))
