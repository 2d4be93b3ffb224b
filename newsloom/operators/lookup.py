"""Joining rows to a dimension, safe against hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dimension measured at no more than this is broadcast, and a set of keys at no more than that. The driver holds a
# broadcast table several times over (rows, hash table, both serialized), and one run makes several.
BROADCAST_BYTES = 32 * 1024 * 1024
KEY_SET_BYTES = 32 * 1024 * 1024
# Keys that are looked at when a dimension is too large to broadcast.
HOT_KEYS = 64


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as Spark holds them in memory, measured in one pass."""
    size: Column = F.lit(8 * (len(df.columns) + 2))
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif not isinstance(field.dataType, T.AtomicType):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) * 4
    return df.agg(F.sum(size.cast("bigint"))).first()[0] or 0


def hot_values(df: DataFrame, key: str, share: float) -> list:
    """Keys that hold at least `share` of all rows; a bounded sketch, so only a hint for routing."""
    top, rows = df.agg(F.expr(f"approx_top_k(`{key}`, {HOT_KEYS})"), F.count("*")).first()
    # NULL is counted too; it never matches and must not get into a NOT IN.
    return [t["item"] for t in top or [] if t["item"] is not None and t["count"] >= rows * share]


def lookup(facts: DataFrame, dim: DataFrame, key: str, how: str = "left",
           max_bytes: int = BROADCAST_BYTES, hot_share: float = 0.01) -> DataFrame:
    """Join `facts` to `dim`, which holds each `key` once, by `inner`, `left`, `left_anti` or `left_semi`.

    A dimension within `max_bytes` is broadcast. Beyond that, rows with a hot
    key or none meet the few dimension rows of those keys by broadcast (there
    are at most HOT_KEYS), and only the rest is shuffled.
    """
    if measured_bytes(dim) <= max_bytes:
        return facts.join(F.broadcast(dim), key, how)
    hot = hot_values(facts, key, hot_share)
    # Without the hint, Spark goes by the size of compressed files and may broadcast a table many times as large.
    if not hot:
        return facts.join(dim.hint("merge"), key, how)
    in_hot = F.col(key).isin(*hot)
    stays = F.coalesce(in_hot, F.lit(True))
    local = facts.filter(stays).join(F.broadcast(dim.filter(in_hot)), key, how)
    shuffled = facts.filter(~stays).join(dim.filter(~in_hot).hint("merge"), key, how)
    return local.unionByName(shuffled)


def with_keys(table: DataFrame, keys: DataFrame, key: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows of a large table whose key is in `keys` (or is not, by `left_anti`; by `left`, all rows and what `keys` adds).

    While the measured keys fit, they are broadcast and the table is only
    scanned. `keys` should be written rows, as measuring reads them once more.
    """
    wanted = keys if how == "left" else keys.select(*key)
    fits = measured_bytes(wanted) <= KEY_SET_BYTES
    return table.join(F.broadcast(wanted) if fits else wanted.hint("merge"), list(key), how)
