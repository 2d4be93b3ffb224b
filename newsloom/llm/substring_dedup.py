"""Remove word passages that occurred before, by Rabin-Karp hashes of every window of a fixed number of words.

See `repeats` for how windows are counted. A window is gone if its words also start in a text with a smaller id; windows are
judged on the texts as given, and the windows that are gone merge into maximal stretches, which are taken out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import repeats
from newsloom.session import materialize

WINDOW_WORDS = 50
GRAM_WORDS = 10


def repeated_spans(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, units: repeats.Units) -> DataFrame:
    """(id, key, start, end) in words, end exclusive: what is covered by windows seen under a smaller id."""
    found = repeats.shared_runs(rows, across_ids=True)
    firsts = found.groupBy("anchor", "run").agg(F.min("id").alias("first_id"))
    found = materialize(found.join(materialize(firsts, "substring-firsts"), ["anchor", "run"]), "substring-runs")
    whole = found.filter("id > first_id").select(
        "id", "key", "start", (F.col("end") - 1 + units.window).alias("end"))
    # All later occurrences of a run are gone; only its first text may keep some of its windows.
    first = found.filter("open AND id = first_id").select("id", "key", "anchor", "start", "end", F.lit(True).alias("extra"))
    windows = materialize(
        repeats.window_rows(repeats.with_texts(docs, id_col, text_col, first), units), "substring-windows")
    least = windows.groupBy("anchor", "hash").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")) \
        .filter("first_id < last_id").select("anchor", "hash", "first_id")
    single = windows.join(materialize(least, "substring-least"), ["anchor", "hash"]).filter("id > first_id").select(
        "id", "key", "start", (F.col("start") + units.window).alias("end"))
    return whole.unionByName(single)


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame]:
    """(summary, cleaned). The summary has one row for each row of `docs`: id, key, n (words), n_removed, n_spans,
    kept_sha256 (of the kept words joined by one space); cleaned has the text that is left of rows that lost words.

    A null text has no words; a null id counts as the smallest; rows with equal id and text lose the same words, and
    rows with equal ids none to each other; texts shorter than a window keep all; an empty table gives no rows; other
    columns are not looked at.
    """
    units = repeats.word_units(window, min(GRAM_WORDS, window))
    rows = repeats.all_runs(docs, id_col, text_col, units)
    spans = repeated_spans(docs, rows, id_col, text_col, units)
    cleaned = repeats.remove_spans(docs, id_col, text_col, spans, units)
    return repeats.summary(rows, cleaned), cleaned
