"""A corpus pipeline: quality, near-duplicates, decontamination, secrets, mix.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. It is written as Parquet to the shared folder and read again
as the next stage's documents. All but the last return the columns of `documents`.

Stages take nulls in any column, empty and very long texts, repeated rows and an empty table as their operators do: null and
empty texts fail the quality rules; a near-duplicate group is told by its smallest id; repeated rows of a kept id that are
equal in text become one; a null source is a source of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsloom.llm import decontamination, minhash_dedup, mixing, quality_rules, secret_scan
from newsloom.session import materialize, spread

#: SimHash fingerprints, components and mixing order have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None

#: Documents are near duplicates from this similarity of their 5-word shingles.
NEAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and are not mostly boilerplate of their host."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id."""
    return minhash_dedup.first_of_each(docs, percent=NEAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and n_chars to match."""
    return secret_scan.redact(docs, length_col="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, once for each copy, with pass, shard and order within the shard."""
    return mixing.copies(docs, mixing.mix(docs))


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scan", secrets),
    ("source mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over `documents`."""
    docs = spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
