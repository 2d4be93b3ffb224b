"""Near-duplicates by MinHash and a multi-index Hamming join.

A text's set of 5-word shingles gives a signature of `VALUES` minima of `BITS` bits each; the distance of two signatures is
the number of values in which they differ. Signatures are cut into `CHUNKS` chunks. If two differ in fewer than
`CHUNKS * (ALLOWED + 1)` values, some chunk has at most `ALLOWED` errors (pigeonhole), so both write a common key when each
enumerates its chunks with every choice of `ALLOWED` values left out. With 32 values, 8 chunks and one error that guarantees
all pairs up to distance 15; a pair of similarity 0.85 differs in 5 on average and is missed once in 50 million.

Texts with equal sets are one class and stand for each other. Candidates are confirmed on full shingle sets. A bucket
(all classes with a key) is never turned into all its pairs: its members meet the member that sits in the largest
buckets, which is the one nearest to all others; then components are formed, and members that this leaves apart from
their bucket's others after `STAR_ROUNDS` turns go through an exact prefix filter over the shingles (`prefix_join`): first they
meet leaders of their keys, then all nodes of their keys in other components, so no link is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm import fingerprints as fp
from newsloom.llm.components import components
from newsloom.llm.prefix_join import all_pairs, entered, leading_pairs, still_open
from newsloom.llm.texts import BROADCAST_ROWS, id_key, keyed, rows_with, rows_without, small, text_key, whole_text
from newsloom.session import discard, materialize, setting

SHINGLE_WORDS = 5
PERCENT = 85
VALUES, BITS, CHUNKS, ALLOWED = 32, 16, 8, 1
STAR_ROUNDS = 1
#: Turns in which classes meet leaders of their prefix keys, before they meet all that are still apart.
KEY_TURNS = 2
#: Classes that a class is compared with in one turn.
LEADERS = 2
#: Rows that are handed to Python at once where each holds two sets, or a whole text.
ROWS_AT_ONCE = 500

_rng = np.random.default_rng(20240131)
_FACTORS = _rng.integers(0, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Shingles hashed at once, to stay within the processor's caches.
_AT_ONCE = 1 << 10

#: For each key, the places of the values that are left of its chunk, and a salt of its own.
_SIZE = VALUES // CHUNKS
_LEFT = np.array([[chunk * _SIZE + i for i in range(_SIZE) if i != out] for chunk in range(CHUNKS) for out in range(_SIZE)])
_SHIFTS = np.uint64(BITS) * np.arange(_SIZE - 1, dtype=np.uint64)
_SALTS = fp.mixed(np.arange(1, VALUES + 1, dtype=np.uint64))

FEATURES = "id long, key long, n_shingles long, class binary, keys array<long>"


def shingle_set(text: str, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles; the whole sequence is one if the text has fewer words."""
    words = fp.word_hashes(fp.as_bytes(text), lower=True)
    if len(words) == 0:
        return np.zeros(0, dtype=fp.U64)
    return np.unique(fp.window_hashes(fp.prefix_sums(words), min(size, len(words))))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest of each of `VALUES` hashes over a set that is not empty, cut to `BITS` bits."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, dtype=fp.U64)
    for begin in range(0, len(shingles), _AT_ONCE):
        part = shingles[begin:begin + _AT_ONCE]
        # Hashes are uniform already; an odd factor permutes them.
        least = np.minimum(least, (part[:, None] * _FACTORS).min(axis=0))
    return fp.mixed(least) >> fp.U64(64 - BITS)


def chunk_keys(values: np.ndarray) -> np.ndarray:
    """Keys of all chunks with every choice of `ALLOWED` (one) values left out."""
    return fp.mixed(_SALTS ^ (values[_LEFT] << _SHIFTS).sum(axis=1, dtype=fp.U64))


def features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each row of `docs`; class is a 128-bit hash of the shingle set, empty without shingles."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, classes, keys = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingle_set(text)
                sizes.append(len(found))
                classes.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else b"")
                keys.append(fp.as_long(chunk_keys(signature(found))).tolist() if len(found) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["id", "key", "n_shingles", "class", "keys"])

    return keyed(docs, id_col, text_col).mapInArrow(work, FEATURES)


def shingle_sets(rows: DataFrame) -> DataFrame:
    """(class, text) -> (class, shingles), the set as the bytes of its sorted hashes."""

    @F.pandas_udf("binary")
    def work(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: shingle_set(text).tobytes())

    return rows.select("class", work("text").alias("shingles"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets have 100 * intersection >= percent * union."""

    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        def one(a: bytes, b: bytes) -> bool:
            x, y = np.frombuffer(a, dtype=fp.U64), np.frombuffer(b, dtype=fp.U64)
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                return False
            both = len(np.intersect1d(x, y, assume_unique=True))
            return 100 * both >= percent * (len(x) + len(y) - both)
        return pd.Series([one(a, b) for a, b in zip(left, right, strict=True)], dtype=bool)

    # Sets that cannot be alike by size alone are not brought together.
    sizes = sets.select("class", F.octet_length("shingles").alias("bytes"))
    pairs = pairs.join(sizes.withColumnsRenamed({"class": "a", "bytes": "size_a"}), "a") \
        .join(sizes.withColumnsRenamed({"class": "b", "bytes": "size_b"}), "b") \
        .filter(100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")).select("a", "b")
    pairs = materialize(pairs, "minhash-sized")
    few = pairs.count() <= BROADCAST_ROWS
    # While the pairs are few, sets meet their pairs where they lie, and of the others only those needed are moved.
    left = sets.withColumnsRenamed({"class": "a", "shingles": "set_a"})
    right = sets.withColumnsRenamed({"class": "b", "shingles": "set_b"})
    if few:
        right = right.join(F.broadcast(pairs.select("b").distinct()), "b", "left_semi")
    rows = left.join(F.broadcast(pairs) if few else pairs, "a").join(right, "b")
    return rows.filter(similar("set_a", "set_b")).select("a", "b")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def crowded_buckets(classes: DataFrame) -> DataFrame:
    """(bucket, class, n): the keys that n > 1 classes (class, keys) share, with these."""
    members = classes.select("class", F.explode("keys").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Counts are written before they are joined, so that a bucket with very many members is split.
    shared = materialize(shared, "minhash-shared")
    few = shared.count() <= BROADCAST_ROWS
    return materialize(members.join(F.broadcast(shared) if few else shared, "bucket"), "minhash-members")


def links(members: DataFrame, sets: DataFrame, percent: int = PERCENT, star_rounds: int = STAR_ROUNDS) -> DataFrame:
    """(a, b) links between classes that have the same components as all links at or above `percent`.

    `members` are the rows of `crowded_buckets`, `sets` has the shingles of their classes.
    """
    weights = members.groupBy("class").agg(F.sum("n").alias("weight"))
    members = materialize(members.join(weights, "class").select("class", "bucket", "weight"), "minhash-weighted")

    pairs = materialize(_ordered(_with_leaders(members, members)), "minhash-pairs")
    found = _confirmed(pairs, sets, percent)
    tried = pairs
    for turn in range(star_rounds):
        apart = _apart(members, components(found))
        if apart.isEmpty():
            return found
        if turn < star_rounds - 1:
            pairs = _ordered(_with_leaders(apart, apart.filter("label != main")))
            pairs, new = _tried(pairs, tried, sets, percent)
            tried = tried.unionByName(pairs)
            found = found if new is None else found.unionByName(new)

    # Nodes are numbers here, by the first half of the class's hash.
    nodes = materialize(apart.select("class", "label").distinct().select(
        _number("class").alias("node"), "class", _number("label").alias("label")), "minhash-nodes")
    # Sets stay where they are while the nodes are few.
    numbered = sets.select(_number("class").alias("node"), "shingles")
    apart_sets = materialize(numbered.join(small(nodes.select("node")), "node", "left_semi"), "minhash-apart-sets")
    entries = entered(apart_sets, percent)
    rows = still_open(entries, nodes.select("node", "label"))
    discard(entries, apart_sets)
    for _ in range(KEY_TURNS):
        pairs, new = _tried(_classes(leading_pairs(rows, LEADERS, percent), nodes), tried, sets, percent)
        tried = tried.unionByName(pairs)
        if new is None:  # labels stay as they are, and so do the leaders
            break
        found = found.unionByName(new)
        labels = materialize(nodes.join(components(found).withColumnRenamed("node", "class").withColumnRenamed("label", "to"), "class", "left").select(
            "node", F.coalesce(_number("to"), "node").alias("label")), "minhash-labels")
        left = still_open(rows.drop("label"), labels)
        discard(rows)
        rows = left
    _, new = _tried(_classes(all_pairs(rows, percent), nodes), tried, sets, percent)
    discard(rows)
    return found if new is None else found.unionByName(new)


def _number(column: str) -> Column:
    return F.conv(F.left(F.hex(column), F.lit(15)), 16, 10).cast("long")


def _classes(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of nodes as ordered pairs of their classes."""
    named = nodes.select("node", "class")
    return _ordered(pairs.join(named.toDF("a", "class_a"), "a").join(named.toDF("b", "class_b"), "b").select(
        F.col("class_a").alias("a"), F.col("class_b").alias("b")))


def _tried(pairs: DataFrame, tried: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """The pairs that were not tried before, and those of them that are links, none if there are none."""
    pairs = materialize(pairs.join(tried, ["a", "b"], "left_anti"), "minhash-pairs")
    if pairs.isEmpty():
        return pairs, None
    new = _confirmed(pairs, sets, percent)
    return pairs, None if new.isEmpty() else new


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    with setting(pairs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE)):
        return materialize(confirmed(pairs, sets, percent), "minhash-links")


def _with_leaders(members: DataFrame, among: DataFrame) -> DataFrame:
    """Each class with the `LEADERS` classes that lead most of its buckets, unless they are already connected.

    A bucket's leader is the heaviest one `among` its members. Whom this does not bring together, the prefix filter does.
    """
    leaders = among.groupBy("bucket").agg(F.max(F.struct("weight", "class", *_label(among))).alias("top"))
    leaders = leaders.select("bucket", F.col("top.class").alias("leader"), *(
        F.col(f"top.{c}").alias("leader_label") for c in _label(among)))
    new = F.col("class") != F.col("leader")
    if _label(among):
        new = F.col("label") != F.col("leader_label")
    met = members.join(materialize(leaders, "minhash-leaders"), "bucket").filter(new).groupBy(
        F.col("class").alias("a"), F.col("leader").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    # A class has one bucket for each of its keys, so this list is short.
    best = met.groupBy("a").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "b")), asc=False), 1, LEADERS).alias("best"))
    return best.select("a", F.explode("best.b").alias("b"))


def _label(members: DataFrame) -> list[str]:
    return ["label"] if "label" in members.columns else []


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets with more than one component; main is the bucket's component of the heaviest member.

    Members of the main component stay in, as others may link to any of them.
    """
    labelled = members.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "label", F.coalesce("label", "class"))
    spread = labelled.groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high"),
        F.max(F.struct("weight", "class", "label")).alias("top")).filter("low != high")
    spread = materialize(spread.select("bucket", F.col("top.label").alias("main")), "minhash-spread")
    return materialize(labelled.join(spread, "bucket"), "minhash-apart")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """One row for each row of `docs`: id, key (a hash of the text), n_shingles, component_id, kept.

    component_id is the smallest id of the texts that links lead to, the row's own included; kept says that it is the
    row's own, so rows repeated with that id all stay. Null and empty texts have no shingles and link with nothing. A
    null id counts as the smallest. An empty table gives no rows; other columns are not looked at.
    """
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE)):
        rows = materialize(features(docs, id_col, text_col), "minhash-features")
    texts = rows.filter("n_shingles > 0")
    # A class is shipped as one row from each task, however many copies it has.
    classes = texts.groupBy("class").agg(
        F.min("id").alias("first_id"), F.min(F.struct("id", "key", "keys")).alias("one"))
    classes = materialize(classes.select("class", "first_id", "one.id", "one.key", "one.keys"), "minhash-classes")
    members = crowded_buckets(classes)
    met = classes.join(materialize(members.select("class").distinct(), "minhash-met"), "class", "left_semi")
    wanted = materialize(met.groupBy("id", "key").agg(F.first("class").alias("class")), "minhash-wanted")
    chosen = rows_with(keyed(docs, id_col, text_col), wanted, ["id", "key"])
    # Copies of a row are dropped where the join has put them; rows of equal class but other ids are not chosen.
    chosen = chosen.dropDuplicates(["id", "key"])
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE)):
        sets = materialize(shingle_sets(chosen), "minhash-sets")
    labels = components(links(members, sets, percent))

    named = labels.join(classes.select(F.col("class").alias("node"), "first_id"), "node")
    firsts = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    linked = named.join(firsts, "label").select(F.col("node").alias("class"), "component_id")
    alone = classes.select("class", "first_id")
    of_class = materialize(alone.join(linked, "class", "left").select(
        "class", F.coalesce("component_id", "first_id").alias("component_id")), "minhash-components")
    done = rows.select("id", "key", "n_shingles", "class").join(of_class, "class", "left").withColumn(
        "component_id", F.coalesce("component_id", "id"))
    return done.select("id", "key", "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` that are kept, all their columns unchanged; rows equal in id and text once.

    Of rows that repeat a kept id with different, linked texts the one with the smallest hash stays.
    """
    done = near_duplicates(docs, id_col, text_col, percent)
    kept = done.filter("kept").groupBy("id", "component_id", F.when(F.col("n_shingles") == 0, F.col("key")).alias("alone")) \
        .agg(F.min("key").alias("key")).select("id", "key")
    kept = materialize(kept.distinct(), "minhash-kept")
    gone = done.select("id", "key").distinct().join(kept, ["id", "key"], "left_anti").select(
        F.col("id").alias("_id"), F.col("key").alias("_key"))
    gone = materialize(gone, "minhash-gone")
    rows = docs.select(F.struct("*").alias("kept_row"), id_key(F.col(id_col)).alias("_id"),
                       text_key(whole_text(F.col(text_col))).alias("_key"))
    rows = rows_without(rows, gone, ["_id", "_key"])
    # Repeated rows are few and found by their keys alone, so that other texts need no shuffle.
    again = materialize(done.groupBy("id", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        F.col("id").alias("_id"), F.col("key").alias("_key")), "minhash-repeated")
    single = rows_without(rows, again, ["_id", "_key"]).select("kept_row")
    doubled = rows_with(rows, again, ["_id", "_key"]).dropDuplicates(["_id", "_key"]).select("kept_row")
    return single.unionByName(doubled).select("kept_row.*")
