"""Candidates among sets of hashes at or above a Jaccard similarity, by an exact prefix filter.

All hashes are put into one order, the rarest first. Two sets of n and m hashes at the similarity share at least
percent * (n + m) / (100 + percent) of them, their need. So the first hash that both have stands in each at a place
that leaves room for the need behind it: in sets of like size among the first few, in a set much smaller than the other only at the
very front. Sizes are cut into bands; a set enters, for each band of partners that its size allows, its hashes up to the last
such place, under a key of the hash and both bands, and sets meet by key if the need of their own sizes leaves room behind both places. A set with some hashes of its own thus meets none of
the many that it shares frequent ones with.

Each set also goes along with the parities of its hashes in `64 * MARKS` places. Where two sets' parities differ, there is a
hash that only one of them has, so pairs with more such places than two alike sets have hashes apart are left out, too.

The order goes by the number of sets that have a hash, counted in Spark. Hashes of one set alone come first, are met by no one
and so never leave their set; only those of several sets are written under keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm import fingerprints as fp
from newsloom.llm.texts import small
from newsloom.session import discard, materialize, setting

#: Sizes in a band differ by about this factor.
BAND = 1.05
#: Numbers of 64 bits that hold a set's parities.
MARKS = 4
MARK_NAMES = [f"mark{i}" for i in range(MARKS)]
#: Sets that are handed to Python at once.
SETS_AT_ONCE = 500
_BOUNDS = np.unique(np.ceil(BAND ** np.arange(700)).astype(np.float64))
_BOUNDS = _BOUNDS[_BOUNDS < 2**40].astype(np.int64)


def marks(hashes: np.ndarray) -> np.ndarray:
    """Whether the hashes that fall into each place are odd in number, as `MARKS` numbers."""
    places = (fp.mixed(hashes) % fp.U64(64 * MARKS)).astype(np.int64)
    odd = (np.bincount(places, minlength=64 * MARKS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def band_of(size: int) -> int:
    return int(np.searchsorted(_BOUNDS, size, side="right")) - 1


def entries(shared: np.ndarray, n: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of a set of n hashes, the side of each, and how many hashes are left from its place on.

    `shared` are those of its hashes that other sets have, too, in the order; the rest stand before them. The side is 0 beside
    larger partners and 1 beside smaller ones, and each of them for equal bands.
    """
    alone = n - len(shared)
    own = band_of(n)
    keys, sides, rooms = [], [], []
    for band in range(band_of(-(-percent * n // 100)), band_of(100 * n // percent) + 1):
        least = max(int(_BOUNDS[band]), -(-percent * n // 100))
        need = -(-percent * (n + least) // (100 + percent))
        front = shared[:max(0, n - need + 1 - alone)]
        pair = fp.mixed(np.array([(min(own, band) << 20) + max(own, band) + 1], dtype=fp.U64))
        for side in ((0, 1) if band == own else (0,) if own < band else (1,)):
            keys.append(fp.mixed(front ^ pair))
            sides.append(np.full(len(front), side, dtype=np.int32))
            rooms.append(len(shared) - np.arange(len(front), dtype=np.int32))
    return np.concatenate(keys), np.concatenate(sides), np.concatenate(rooms)


def _hashes(sets: DataFrame) -> DataFrame:
    """(node, hash), a row for each hash of each set."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(one.as_buffer(), dtype=np.int64) for one in batch.column("shingles")]
            own = np.repeat(np.arange(len(parts)), [len(part) for part in parts])
            if len(own):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").take(pa.array(own)), pa.array(np.concatenate(parts))], ["node", "hash"])

    return sets.select("node", "shingles").mapInArrow(work, "node long, hash long")


def _heads(sets: DataFrame) -> DataFrame:
    """(node, n, marks), a row for each set."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(one.as_buffer(), dtype=fp.U64) for one in batch.column("shingles")]
            found = np.array([marks(part) for part in parts], dtype=np.int64).reshape(-1, MARKS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([len(part) for part in parts], pa.int32()), *map(pa.array, found.T.copy())],
                ["node", "n", *MARK_NAMES])

    return sets.select("node", "shingles").mapInArrow(
        work, ", ".join(["node long, n int", *[f"{name} long" for name in MARK_NAMES]]))


def _in_order(sets: DataFrame) -> DataFrame:
    """(node, shared): each set's hashes that other sets have, too, those of the fewest sets first; sets without any left out."""
    # Dealt by hash once and counted where they lie, as hashes of one set, which are most, would be moved again for their
    # counts. A hash has at most one short row from each set.
    met = _hashes(sets).withColumn("sets", F.count(F.lit(1)).over(Window.partitionBy("hash"))).filter("sets > 1")
    # A set is one text's, so its list is bounded by the text.
    ordered = met.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("sets", "hash"))).alias("ordered"))
    return materialize(ordered.select("node", F.col("ordered.hash").alias("shared")), "prefix-order")


def entered(sets: DataFrame, percent: int) -> DataFrame:
    """(key, side, node, n, room, marks) of the written `sets` (node, shingles), on disk; n is the set's size."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n").to_numpy()
            made = [entries(shared.values.to_numpy().view(fp.U64), int(n), percent)
                    for shared, n in zip(batch.column("shared"), sizes, strict=True)]
            if not made:
                continue
            keys, sides, rooms = (np.concatenate(parts) for parts in zip(*made, strict=True))
            own = pa.array(np.repeat(np.arange(len(made)), [len(one[0]) for one in made]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp.as_long(keys)), pa.array(sides), batch.column("node").take(own), batch.column("n").take(own),
                 pa.array(rooms), *[batch.column(name).take(own) for name in MARK_NAMES]],
                ["key", "side", "node", "n", "room", *MARK_NAMES])

    with setting(sets.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(SETS_AT_ONCE)):
        ordered = _in_order(sets)
        made = materialize(ordered.join(_heads(sets), "node").mapInArrow(
            work, ", ".join(["key long, side int, node long, n int, room int", *[f"{name} long" for name in MARK_NAMES]])),
            "prefix-entries")
    discard(ordered)
    return made


def still_open(found: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries of keys that nodes of several `labels` (node, label), a written table, have, with the labels, on disk."""
    named = found.join(small(labels), "node")
    keys = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high").select("key")
    return materialize(named.join(small(materialize(keys, "prefix-keys")), "key"), "prefix-open")


def _facing(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    names = ["node", "label", "n", "room", *MARK_NAMES]
    smaller = rows.filter("side = 0").select("key", *[F.col(c).alias(f"{c}_a") for c in names])
    larger = rows.filter("side = 1").select("key", *[F.col(c).alias(f"{c}_b") for c in names])
    return smaller, larger


def _may_be_alike(percent: int) -> Column:
    """Apart so far, with room in both sets for what they must share, this key's hash included, and with parities as alike."""
    both = (F.col("n_a") + F.col("n_b")).cast("long")
    fits = (100 + percent) * F.least("room_a", "room_b").cast("long") >= percent * both
    differ = sum((F.bit_count(F.col(f"{name}_a").bitwiseXOR(F.col(f"{name}_b"))) for name in MARK_NAMES), F.lit(0))
    # Of two sets that share x hashes, both - 2 * x are in one only; x is at least percent * both / (100 + percent).
    near = (100 + percent) * (both - differ) >= 2 * percent * both
    return (F.col("label_a") != F.col("label_b")) & fits & near


def leading_pairs(rows: DataFrame, leaders: int, percent: int) -> DataFrame:
    """Pairs (a, b) of each node with at most `leaders` of the nodes that stand for a side of its keys, those of most keys."""
    smaller, larger = _facing(rows)
    first, last = (side.groupBy("key").agg(F.max(F.struct(*[c for c in side.columns if c != "key"])).alias("top")).select(
        "key", "top.*") for side in (smaller, larger))
    fits = _may_be_alike(percent)
    met = smaller.join(last, "key").filter(fits).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).unionByName(
        larger.join(first, "key").filter(fits).select(F.col("node_b").alias("a"), F.col("node_a").alias("b")))
    counted = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    # A node has a bounded number of keys, and so of leaders.
    best = counted.groupBy("a").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "b")), asc=False), 1, leaders).alias("best"))
    return best.select("a", F.explode("best.b").alias("b"))


def all_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of nodes on opposite sides of a key whose labels differ and whose sizes and places allow it."""
    smaller, larger = _facing(rows)
    # Within a band each node stands on both sides; sizes, then nodes, say on which of them a pair meets.
    once = F.struct("n_a", "node_a") < F.struct("n_b", "node_b")
    return smaller.join(larger, "key").filter(once & _may_be_alike(percent)).select(
        F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def candidates(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of the written `sets` (node, shingles) that may be alike; those of equal label left out."""
    return all_pairs(still_open(entered(sets, percent), labels), percent)
