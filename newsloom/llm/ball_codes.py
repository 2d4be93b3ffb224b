"""Vector codes by product quantisation whose codebooks come from ball k-means, in whole numbers.

Each component x becomes floor(`scale` * x), and each vector is cut into equal parts. Every part position has a codebook of its
own, which begins as that part of the vectors with the smallest ids. A round assigns all parts to their nearest entries and
then moves each entry to floor(sum / count) of its parts; entries without parts stay.

Ball k-means saves distances without changing a result. The parts of an entry form a ball around it. Entry j can be as near to
a part x of entry i as i itself only if the distance of i and j is at most twice the distance of x and i. So the ball's
radius tells its neighbour entries; parts in the stable core, nearer to i than half of the distance to the closest other
entry, stay without work; the others lie in rings, and are compared with as many of i's neighbours, the closest first, as
their ring tells. All distances are whole numbers, squared, so the comparison is exact, and ties go to the lower index. In the
first round all parts start in the ball of entry 0.

Each task works on the parts of its own vectors (the radius is that of the ball's parts in an Arrow batch, which is never
larger than the whole ball's), adds up its parts by entry, and writes vectors, codes and sums as one table to the shared
folder. The driver gets the sums by part and entry, so at most `parts` * `entries` rows, and passes the codebooks on.

Vectors that are null or empty, or hold null or non-finite components, are left out. All others must have one length, a multiple of
`parts`, and components of less than 2**28 after scaling, so that sums stay exact; a vector that does not is reported as
an error. Null ids come after all others; equal ids are ordered by their vectors. Repeated rows count and come out as often as
they are there. Fewer vectors than entries give smaller codebooks, an empty table no row. Only the named columns are read, so
others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from newsloom.operators.lookup import lookup
from newsloom.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Scaled components are below this, so squared distances and their sums fit into 64 bits.
LIMIT = 2**28
#: Parts of a ball are compared in so many groups of like rings.
RING_GROUPS = 4


def whole_vectors(vectors: DataFrame, vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Rows with a usable vector, which becomes whole numbers in `vector_col`."""
    v = F.col(f"`{vector_col}`")
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return vectors.filter(usable).withColumn(
        vector_col, F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def nearest_in_balls(points: np.ndarray, prior: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each point and the squared distance, given an entry that each point belongs to."""
    between = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    by_distance = np.argsort(between, axis=1, kind="stable")
    nearest, distance = prior.astype(np.int64), np.empty(len(points), dtype=np.int64)
    order = np.argsort(prior, kind="stable")
    bounds = np.searchsorted(prior[order], np.arange(len(entries) + 1))
    for entry in range(len(entries)):
        ball = order[bounds[entry]:bounds[entry + 1]]
        if not len(ball):
            continue
        own = ((points[ball] - entries[entry]) ** 2).sum(axis=1)
        distance[ball] = own
        neighbours = by_distance[entry]
        reach = between[entry, neighbours]
        neighbours = neighbours[:np.searchsorted(reach, 4 * own.max(), side="right")]
        ring = np.searchsorted(reach, 4 * own, side="right")
        outside = np.flatnonzero(ring > 1)  # the entry itself is one
        if not len(outside):
            continue
        outside = outside[np.argsort(ring[outside], kind="stable")]
        for some in np.array_split(outside, min(RING_GROUPS, len(outside))):
            compared = neighbours[:ring[some[-1]]]
            to = ((points[ball[some], None, :] - entries[None, compared, :]) ** 2).sum(axis=2)
            least = to.min(axis=1)
            distance[ball[some]] = least
            nearest[ball[some]] = np.where(to == least[:, None], compared, len(entries)).min(axis=1)
    return nearest, distance


def _assigner(books: np.ndarray, with_sums: bool, schema: pa.Schema):
    """A function over Arrow batches that puts codes to vectors, and sums of the parts of each entry behind the last."""
    parts, entries, width = books.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        counts = np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vector")
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(vectors.offsets.to_numpy())
            if (lengths != parts * width).any():
                raise ValueError(f"vectors of {parts * width} components expected, not {sorted(set(lengths.tolist()))}")
            if np.abs(flat).max() >= LIMIT:
                raise ValueError(f"components must be below {LIMIT} after scaling")
            points = flat.reshape(batch.num_rows, parts, width)
            codes = np.zeros((batch.num_rows, parts), dtype=np.uint8)
            if batch.column("code").null_count == 0:
                codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.uint8).reshape(-1, parts)
            found = np.empty_like(codes)
            error = np.zeros(batch.num_rows, dtype=np.int64)
            for part in range(parts):
                own = points[:, part]
                nearest, distance = nearest_in_balls(own, codes[:, part], books[part])
                found[:, part] = nearest
                error += distance
                if with_sums:
                    counts[part] += np.bincount(nearest, minlength=entries)
                    np.add.at(sums[part], nearest, own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), batch.column("vector"),
                 pa.array([row.tobytes() for row in found], pa.binary()), pa.array(error),
                 *[pa.nulls(batch.num_rows, field.type) for field in list(schema)[5:]]], schema=schema)
        used = np.argwhere(counts)
        if with_sums and len(used):
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(len(used), field.type) for field in list(schema)[:5]],
                 pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()),
                 pa.array([int(counts[p, e]) for p, e in used]),
                 pa.array([sums[p, e].tolist() for p, e in used], pa.list_(pa.int64()))], schema=schema)

    return assign


def _assigned(coded: DataFrame, books: np.ndarray, with_sums: bool) -> DataFrame:
    """Codes by `books`; rows with a `part` are sums over the vectors of a task."""
    own = {f.name: f.dataType for f in coded.schema.fields}
    result = T.StructType([
        T.StructField("id", own["id"]), T.StructField("label", own["label"]), T.StructField("vector", T.ArrayType(T.LongType())),
        T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType()), T.StructField("part", T.IntegerType()),
        T.StructField("entry", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("total", T.ArrayType(T.LongType()))])
    return coded.select("id", "label", "vector", "code").mapInArrow(
        _assigner(books, with_sums, to_arrow_schema(result)), result)


def _moved(books: np.ndarray, written: DataFrame) -> np.ndarray:
    """The codebooks after a round: entries at floor(sum / count) of their parts."""
    width = books.shape[2]
    totals = written.filter(F.col("part").isNotNull()).groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"total_{i}") for i in range(width)])
    moved = books.copy()
    for row in totals.collect():  # one row for each entry of each part
        moved[row["part"], row["entry"]] = [row[f"total_{i}"] // row["n"] for i in range(width)]
    return moved


def first_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """Codebooks of the vectors with the smallest ids, as (part, entry, position); without vectors, without entries."""
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not first:
        return np.zeros((parts, 0, 0), dtype=np.int64)
    lengths = {len(r["vector"]) for r in first}
    if len(lengths) > 1 or min(lengths) % parts:
        raise ValueError(f"vectors of one length expected, a multiple of {parts}, not {sorted(lengths)}")
    values = np.array([r["vector"] for r in first], dtype=np.int64)
    return np.ascontiguousarray(values.reshape(len(first), parts, -1).transpose(1, 0, 2))


def encode(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int = PARTS, entries: int = ENTRIES,
           rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """Rows (`id`, `label`, `vector` in whole numbers, `code` as one byte a part, `error`), and the codebooks behind them."""
    if not 0 < entries <= 256:
        raise ValueError("a code holds 1 to 256 entries")
    whole = whole_vectors(vectors.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").alias("vector")),
        "vector", scale)
    books = first_books(whole, parts, entries)
    coded = whole.withColumn("code", F.lit(None).cast("binary"))
    if not books.size:
        return coded.withColumn("error", F.lit(None).cast("long")), books
    for _ in range(rounds):
        written = materialize(_assigned(coded, books, with_sums=True), "ball-codes")
        books = _moved(books, written)
        coded = written.filter(F.col("part").isNull())
    last = materialize(_assigned(coded, books, with_sums=False).select("id", "label", "vector", "code", "error"), "ball-codes")
    return last, books


def books_sha256(books: np.ndarray) -> str:
    """Digest of all components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def code_text(code: str = "code"):
    """Two lower-case hex digits for each part."""
    return F.lower(F.hex(code))


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Add `label_error`, the sum of `error` over equal labels, nulls together.

    A label may hold any share of the rows: sums are formed in each task first, and `lookup` does not shuffle hot labels.
    """
    text = F.col("label").cast("string")
    named = coded.withColumn("_label", F.coalesce(F.concat(F.lit("="), text), F.lit("")))
    totals = named.groupBy("_label").agg(F.sum("error").alias("label_error"))
    return lookup(named, totals, "_label").drop("_label")
