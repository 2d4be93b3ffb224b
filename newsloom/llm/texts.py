"""Words of texts, row keys and joins that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words, and the same as a set of characters.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"

#: A null id counts as the smallest one.
NULL_ID = -(2**63)

#: A set of ids is broadcast up to this many rows (16 bytes each, so 32 MiB).
BROADCAST_ROWS = 2_000_000


def whole_text(text: Column) -> Column:
    """A null text is an empty one."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Words of a text that is not null, in order; none for a text without words."""
    inner = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACES))


def count_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def id_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NULL_ID).cast("long"))


def shown_id(key: str) -> Column:
    return F.nullif(F.col(key), F.lit(NULL_ID).cast("long"))


def text_key(text: Column) -> Column:
    """With the id it names a row; rows that agree in both are copies that share every result."""
    return F.xxhash64(text)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(`id`, `key`, `text`): nulls replaced, all other columns left out."""
    text = whole_text(F.col(text_col))
    return docs.select(id_key(F.col(id_col)).alias("id"), text_key(text).alias("key"), text.alias("text"))


def small(keys: DataFrame) -> DataFrame:
    """A written table of one or two numbers a row, broadcast where it is joined within `BROADCAST_ROWS`."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def rows_with(rows: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of wide `rows` with `wanted`, which has one row for each key.

    `wanted` is a written table, so counting it is cheap. Within `BROADCAST_ROWS` only its keys are broadcast first,
    so that the rows it lacks stay where they are; the join by shuffle that follows is the same either way.
    """
    if wanted.count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(wanted.select(*on)), on, "left_semi")
    return rows.join(wanted.hint("shuffle_hash"), on)


def rows_without(rows: DataFrame, unwanted: DataFrame, on: list[str]) -> DataFrame:
    """Anti join of wide `rows` with a written table of keys, broadcast within `BROADCAST_ROWS`."""
    few = unwanted.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(unwanted) if few else unwanted, on, "left_anti")
