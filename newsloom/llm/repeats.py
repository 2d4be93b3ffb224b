"""Find stretches that repeat across texts, without comparing texts or shipping every window.

Every text is a sequence of words or bytes, and every stretch of `window` of them is a window. Each window chooses an
anchor: the gram inside it with the smallest hash. Equal windows choose equal anchors, so windows only need to be compared
with those of the same anchor. Neighbouring windows with one anchor form a run; a run is told by its anchor and by the
Rabin-Karp hash of all it covers. Runs are counted in Spark with partial sums, so a run that a third of all texts share is
as cheap as any other. What is left are anchors with different runs: the edges of shared passages and edited copies. Only
their windows are looked at one by one, one run standing for all its equals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import fingerprints as fp
from newsloom.llm.texts import keyed, rows_with
from newsloom.session import materialize

#: Windows of one text handled at once; longer texts are worked on in pieces.
PIECE = 1 << 20

ROWS = "id long, key long, n long, sha string, runs array<struct<anchor: long, run: long, start: int, end: int>>"
SPANS = "array<struct<start: int, end: int>>"


@dataclass(frozen=True)
class Units:
    """What a text is a sequence of: a window's and a gram's number of units, and how to get and join them."""

    window: int
    gram: int
    values: Callable[[str], np.ndarray]
    pieces: Callable[[str], list[bytes] | np.ndarray]
    join: Callable[[list[bytes] | np.ndarray], bytes]


def _bytes(text: str) -> np.ndarray:
    return fp.as_bytes(text)


def byte_units(window: int, gram: int) -> Units:
    return Units(window, gram, lambda t: _bytes(t).astype(fp.U64) + fp.U64(1), _bytes, lambda b: b.tobytes())


def word_units(window: int, gram: int) -> Units:
    # bytes.split() cuts at exactly the six characters that separate words.
    return Units(window, gram, lambda t: fp.word_hashes(_bytes(t)), lambda t: t.encode().split(), b" ".join)


def kept_pieces(pieces: list[bytes] | np.ndarray, gone: np.ndarray) -> list[bytes] | np.ndarray:
    if isinstance(pieces, np.ndarray):
        return pieces[~gone]
    return [p for p, g in zip(pieces, gone.tolist(), strict=True) if not g]


def text_runs(values: np.ndarray, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """anchor, run hash, first window and the one after the last, of all runs of a text."""
    parts = []
    n_windows = len(values) - units.window + 1
    for begin in range(0, max(n_windows, 0), PIECE):
        own = values[begin:begin + PIECE + units.window - 1]
        sums = fp.prefix_sums(own)
        grams = fp.window_hashes(sums, units.gram)
        chosen = fp.anchors(grams, units.window - units.gram + 1)
        first, after = fp.runs(chosen)
        parts.append((fp.as_long(grams[chosen[first]]),
                      fp.as_long(fp.stretch_hashes(sums, first, after - 1 + units.window)),
                      first + begin, after + begin))
    if not parts:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def all_runs(docs: DataFrame, id_col: str, text_col: str, units: Units) -> DataFrame:
    """One row for each row of `docs`: its number of units, digest and runs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, found, offsets = [], [], [], [0]
            for text in batch.column("text").to_pylist():
                values = units.values(text)
                sizes.append(len(values))
                digests.append(hashlib.sha256(units.join(units.pieces(text))).hexdigest())
                found.append(text_runs(values, units))
                offsets.append(offsets[-1] + len(found[-1][0]))
            columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
            runs = pa.StructArray.from_arrays(
                [pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2].astype(np.int32)),
                 pa.array(columns[3].astype(np.int32))], ["anchor", "run", "start", "end"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs)], ["id", "key", "n", "sha", "runs"])

    return materialize(keyed(docs, id_col, text_col).mapInArrow(work, ROWS), "repeat-runs")


def shared_runs(rows: DataFrame, across_ids: bool) -> DataFrame:
    """(id, key, anchor, run, start, end, open): runs whose anchor occurs again; open if it has different runs."""
    runs = rows.select("id", "key", F.explode("runs").alias("r")).select("id", "key", "r.*")
    anchors = runs.groupBy("anchor").agg(
        F.min("id").alias("low_id"), F.max("id").alias("high_id"), F.count(F.lit(1)).alias("n"),
        F.min("run").alias("low"), F.max("run").alias("high"))
    anchors = anchors.filter("low_id < high_id" if across_ids else "n > 1").select(
        "anchor", (F.col("low") != F.col("high")).alias("open"))
    # Written before they are joined, so that an anchor with very many runs is split.
    return materialize(runs.join(materialize(anchors, "repeat-anchors"), "anchor"), "repeat-shared")


RUN = "struct<anchor: long, start: int, end: int, extra: boolean>"


def with_texts(docs: DataFrame, id_col: str, text_col: str, runs: DataFrame) -> DataFrame:
    """(id, key, text, runs) of the rows that hold `runs` (id, key, anchor, start, end, extra), one for each id and key."""
    wanted = runs.groupBy("id", "key").agg(
        F.collect_list(F.struct("anchor", "start", "end", "extra")).alias("runs"))
    wanted = materialize(wanted, "repeat-wanted")
    return rows_with(keyed(docs, id_col, text_col), wanted, ["id", "key"])


def window_rows(texts: DataFrame, units: Units) -> DataFrame:
    """(anchor, hash, id, key, start): the windows of the given runs, one by one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                hashes = fp.as_long(fp.window_hashes(fp.prefix_sums(
                    units.values(batch.column("text")[i].as_py())), units.window))
                runs = batch.column("runs")[i].values
                first, after = (runs.field(f).to_numpy() for f in ("start", "end"))
                sizes = after - first
                places = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                n = len(places)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(runs.field("anchor").to_numpy(), sizes)), pa.array(hashes[places]),
                     pa.array(np.full(n, batch.column("id")[i].as_py())),
                     pa.array(np.full(n, batch.column("key")[i].as_py())), pa.array(places.astype(np.int32))],
                    ["anchor", "hash", "id", "key", "start"])

    return texts.mapInArrow(work, "anchor long, hash long, id long, key long, start int")


def remove_spans(docs: DataFrame, id_col: str, text_col: str, spans: DataFrame, units: Units) -> DataFrame:
    """The rows of `docs` that `spans` (id, key, start, end) touch: id, key, n_removed, n_spans, kept (what is left), kept_sha.

    A span may be given more than once.
    """
    wanted = materialize(spans.groupBy("id", "key").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")), "repeat-spans")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, n_spans, left = [], [], []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("spans"), strict=True):
                pieces = units.pieces(text)
                gone = fp.union(own.values.field("start").to_numpy(), own.values.field("end").to_numpy(), len(pieces))
                removed.append(int(gone.sum()))
                n_spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                left.append(units.join(kept_pieces(pieces, gone)))
            digests = [hashlib.sha256(kept).hexdigest() for kept in left]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
                 pa.array(left, pa.binary()), pa.array(digests, pa.string())],
                ["id", "key", "n_removed", "n_spans", "kept", "kept_sha"])

    texts = rows_with(keyed(docs, id_col, text_col), wanted, ["id", "key"])
    return texts.mapInArrow(work, "id long, key long, n_removed long, n_spans long, kept binary, kept_sha string")


def summary(rows: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row for each of `rows` of `all_runs`: id, key, n, n_removed, n_spans, kept_sha256."""
    cleaned = cleaned.select("id", "key", "n_removed", "n_spans", "kept_sha").dropDuplicates(["id", "key"])
    return rows.select("id", "key", "n", "sha").join(cleaned, ["id", "key"], "left").select(
        "id", "key", "n", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha", "sha").alias("kept_sha256"))
