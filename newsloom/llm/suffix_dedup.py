"""Remove byte strings that occur more than once, by suffix arrays and longest previous factors.

One suffix array over all texts would have to pass through one machine. `repeats` first finds the anchors under which a
string can have a partner at all, settles runs that are equal as a whole by counting them, and leaves the different runs
of an anchor. Their bytes meet in one task, anchor by anchor, and a suffix array to the depth of the string length is built
over them by prefix doubling. Suffixes of equal rank share at least that many bytes. In the order of ranks, ties by
position, the neighbour before a suffix is its previous smaller position; where it has the same rank the longest previous
factor reaches the length and this is an earlier match. The next smaller position cannot have a longer one among equals.
Later copies are removed (`keep="first"`), or all of them (`keep="none"`).

Anchors with more than `MOST_RUNS` different runs, whose bytes might not fit into one task, have their strings counted by
hash in Spark instead; the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import fingerprints as fp
from newsloom.llm import repeats
from newsloom.session import materialize

LENGTH = 400
GRAM_BYTES = 64
MOST_RUNS = 4096
#: Bytes under one suffix array, if no single anchor has more. Short arrays sort faster, and more of their ranks fit into
#: one number.
AT_ONCE = 1 << 14
#: Keys of over this many rows, and of over one in this many of all, do not go through a shuffle; they are fewer than this.
CROWDED = 1024

SNIPPETS = "anchor long, id long, key long, start int, extra boolean, snippet binary"


def _ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(fp.U64)


def suffix_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each suffix among all by its first `depth` bytes; equal bytes, equal rank.

    Ranks follow byte order; what lies behind the end counts as zero bytes.
    """
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)]).astype(fp.U64)
    packed = np.zeros(len(text), dtype=fp.U64)
    known = min(8, depth)
    for i in range(known):
        packed = (packed << fp.U64(8)) | padded[i:len(text) + i]
    ranks = _ranks(packed)
    bits = max(1, len(text).bit_length())
    while known < depth:
        # As many known prefixes as fit into 64 bits, each shifted, cover the next one; they overlap in the last step.
        joined = np.zeros_like(ranks)
        for i in range(64 // bits):
            shift = min(i * known, depth - known)
            joined <<= fp.U64(bits)
            joined[:max(len(ranks) - shift, 0)] |= ranks[shift:] + fp.U64(1)
        ranks = _ranks(joined)
        known = min(64 // bits * known, depth)
    return ranks


def matches(ranks: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes at rising `starts`: which have an earlier match, and which have any."""
    own = ranks[starts]
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    earlier, some = np.zeros(len(starts), dtype=bool), np.zeros(len(starts), dtype=bool)
    earlier[order[1:]] = same
    some[order[1:]] = same
    some[order[:-1]] |= same
    return earlier, some


def _snippets(texts: DataFrame, length: int) -> DataFrame:
    """The bytes that the windows of each run cover."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py().encode()
                runs = batch.column("runs")[i].values
                first, after = (runs.field(f).to_pylist() for f in ("start", "end"))
                n = len(runs)
                yield pa.RecordBatch.from_arrays(
                    [runs.field("anchor"), pa.array([batch.column("id")[i].as_py()] * n, pa.int64()),
                     pa.array([batch.column("key")[i].as_py()] * n, pa.int64()), runs.field("start"),
                     runs.field("extra"),
                     pa.array([text[a:b - 1 + length] for a, b in zip(first, after, strict=True)], pa.binary())],
                    ["anchor", "id", "key", "start", "extra", "snippet"])

    return texts.mapInArrow(work, SNIPPETS)


def _array_spans(rows: list[tuple], length: int, keep: str) -> Iterator[tuple]:
    """Spans (id, key, start, end) of the matches among snippets of whole anchors, in order of position."""
    text = np.frombuffer(b"".join(r[5] for r in rows), dtype=np.uint8)
    sizes = np.array([len(r[5]) for r in rows])
    begins = np.cumsum(sizes) - sizes
    n_windows = sizes - length + 1
    within = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    starts = np.repeat(begins, n_windows) + within
    earlier, some = matches(suffix_ranks(text, length), starts)
    # A run with equals elsewhere is settled already unless only its later copies go.
    hit = earlier if keep == "first" else some & ~np.repeat(np.array([r[4] for r in rows], dtype=bool), n_windows)
    row = np.repeat(np.arange(len(rows)), n_windows)
    first = hit & ~np.concatenate([[False], hit[:-1] & (row[1:] == row[:-1])])
    last = hit & ~np.concatenate([hit[1:] & (row[1:] == row[:-1]), [False]])
    for i, a, b in zip(row[first].tolist(), within[first].tolist(), within[last].tolist(), strict=True):
        yield rows[i][1], rows[i][2], rows[i][3] + a, rows[i][3] + b + length


def _by_arrays(snippets: DataFrame, length: int, keep: str) -> DataFrame:
    """Suffix arrays over the snippets of a few anchors at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans(rows: list[tuple]) -> pa.RecordBatch:
            found = list(_array_spans(rows, length, keep)) if rows else []
            columns = list(zip(*found, strict=True)) or [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "key", "start", "end"])

        held: list[tuple] = []
        n_held = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:4] == held[-1][:4]:
                    continue  # from a repeated row of the table
                if n_held >= AT_ONCE and row[0] != held[-1][0]:
                    yield spans(held)
                    held, n_held = [], 0
                held.append(row)
                n_held += len(row[5])
        yield spans(held)

    together = snippets.repartition("anchor").sortWithinPartitions("anchor", "id", "key", "start")
    return together.mapInArrow(work, "id long, key long, start int, end int")


def _by_counts(windows: DataFrame, length: int, keep: str) -> DataFrame:
    """The same for windows (anchor, hash, id, key, start, extra), counted with partial sums."""
    place = F.struct("id", "key", "start")
    counts = windows.groupBy("anchor", "hash").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    again = windows.join(materialize(counts.filter("n > 1"), "suffix-counts"), ["anchor", "hash"])
    again = again.filter(place != F.col("first")) if keep == "first" else again
    return again.select("id", "key", "start", (F.col("start") + length).alias("end"))


def meet(rows: DataFrame, counted: DataFrame, on: list[str], n: str = "n") -> DataFrame:
    """`rows` joined to `counted`, which is written and has each key once, with the number `n` of its rows.

    The rows of a key that very many have would land in one task: such keys meet their rows by broadcast.
    """
    total, most = counted.agg(F.sum(n), F.max(n)).first()
    limit = max(CROWDED, (total or 0) // CROWDED)
    if (most or 0) <= limit:
        return rows.join(counted, on)
    many, few = counted.filter(F.col(n) > limit), counted.filter(F.col(n) <= limit)
    rest = rows.join(F.broadcast(many.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(many), on).unionByName(rest.join(few, on))


def repeated_spans(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, units: repeats.Units,
                   keep: str, most_runs: int = MOST_RUNS) -> DataFrame:
    """(id, key, start, end) in bytes, end exclusive: what is to be removed."""
    found = repeats.shared_runs(rows, across_ids=False)
    place = F.struct("id", "key", "start", "end")
    equal = found.groupBy("anchor", "run", "open").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    equal = materialize(equal, "suffix-runs")
    gone = meet(found, equal.filter("n > 1").select("anchor", "run", "first", "n"), ["anchor", "run"])
    gone = gone.filter(place != F.col("first")) if keep == "first" else gone
    whole = gone.select("id", "key", "start", (F.col("end") - 1 + units.window).alias("end"))

    # One run stands for its equals. Only anchors with a run that is not settled need a look, at all their runs.
    different = equal.filter("open")
    settled = F.lit(0) if keep == "first" else F.min(F.when(F.col("n") > 1, 1).otherwise(0))
    anchors = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_runs"), settled.alias("settled")) \
        .filter("settled = 0").select("anchor", "n_runs")
    chosen = materialize(meet(different, materialize(anchors, "suffix-anchors"), ["anchor"], "n_runs").select(
        "first.*", "anchor", (F.col("n") > 1).alias("extra"), "n_runs"), "suffix-chosen")
    few = chosen.filter(F.col("n_runs") <= most_runs).drop("n_runs")
    many = chosen.filter(F.col("n_runs") > most_runs).drop("n_runs")
    spans = whole.unionByName(_by_arrays(_snippets(
        repeats.with_texts(docs, id_col, text_col, few), units.window), units.window, keep))
    if many.isEmpty():
        return spans
    windows = repeats.window_rows(repeats.with_texts(docs, id_col, text_col, many), units)
    return spans.unionByName(_by_counts(materialize(windows.distinct(), "suffix-windows"), units.window, keep))


def dedup_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                  keep: str = "first", most_runs: int = MOST_RUNS) -> tuple[DataFrame, DataFrame]:
    """(summary, cleaned). The summary has one row for each row of `docs`: id, key, n (bytes), n_removed, n_spans (maximal
    removed stretches), kept_sha256; cleaned has the bytes that are left of rows that lost some.

    A byte goes if a string of `length` bytes over it also starts elsewhere, in the same or another text (`keep="none"`),
    or earlier, by id, then place (`keep="first"`). Strings never cross texts and are judged on the texts as given. A null
    text is empty; a null id counts as the smallest; repeated rows are copies of each other, and with `keep="first"`,
    where they have the same place, all stay; shorter texts keep all; an empty table gives no rows; other columns are not
    looked at.
    """
    units = repeats.byte_units(length, min(GRAM_BYTES, length))
    rows = repeats.all_runs(docs, id_col, text_col, units)
    spans = repeated_spans(docs, rows, id_col, text_col, units, keep, most_runs)
    cleaned = repeats.remove_spans(docs, id_col, text_col, spans, units)
    return repeats.summary(rows, cleaned), cleaned
