"""Quality rules: figures of each text, and lines that many documents of a host share.

One pass over the texts works out all figures of a row and the hashes of its normalised lines; only these are kept.
A line is counted once for each document of its host that has it; rows of equal text are one document. Rows are counted first,
then, for lines above the limit by rows, distinct texts. Lines above the limit are taken out; a document of which too
little is left is rejected.

Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.texts import SPACE_CHARS, SPACES, id_key, rows_without, text_key, whole_text, words
from newsloom.session import materialize

SYMBOLS = "[#*$%&|<>]"
#: Base limits: fewest words, and most words in repeated 3-word windows, in percent of the words.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: A line is boilerplate on its host if more documents have it than either figure.
LINE_DOCS = 50
LINE_SHARE = 0.01
#: A document is depleted if less than this share of its words is left.
LEAST_LEFT = 0.3


def text_figures(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row for each row of `docs`: row (a number), id, host, the base figures and lines.

    `lines` holds (hash, n_words) of each line with words; lines are lower-cased, digits become 0 and
    white space is folded before hashing.
    """
    text = whole_text(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), text.alias("text"))
    rows = rows.withColumn("words", words(F.col("text")))
    gram = "xxhash64(words[i], words[i + 1], words[i + 2])"
    rows = rows.withColumn("grams", F.expr(
        f"IF(size(words) < 3, CAST(array() AS array<bigint>), transform(sequence(0, size(words) - 3), i -> {gram}))"))
    rows = rows.withColumn("repeats", F.expr("size(array_distinct(grams)) < size(grams)"))
    # The place of a window goes into as many low bits as its text needs.
    rows = rows.withColumn("low", F.expr("shiftleft(1L, length(bin(size(grams)))) - 1"))
    rows = rows.withColumn("sorted", F.expr(
        "IF(repeats, sort_array(transform(grams, (h, i) -> (h & ~low) | CAST(i AS bigint))), "
        "CAST(array() AS array<bigint>))"))
    same = "(grams[CAST(x & low AS int)] = grams[CAST({} & low AS int)])"
    rows = rows.withColumn("starts", F.expr(
        "IF(repeats, sort_array(transform(filter(sorted, (x, j) -> "
        f"(j > 0 AND {same.format('sorted[j - 1]')}) OR (j < size(sorted) - 1 AND {same.format('sorted[j + 1]')})), "
        "x -> x & low)), CAST(array() AS array<bigint>))"))
    covered = ("aggregate(transform(starts, (s, j) -> IF(j = size(starts) - 1, 3L, least(3L, starts[j + 1] - s))), "
               "0L, (a, b) -> a + b)")
    has_words = f"btrim(l, '{_sql(SPACE_CHARS)}') != ''"
    rows = rows.withColumn("raw_lines", F.expr(f"filter(split(text, '\\n', -1), l -> {has_words})"))
    normal = (F.transform("raw_lines", lambda l: F.struct(
        F.xxhash64(F.regexp_replace(F.regexp_replace(
            F.lower(F.btrim(l, F.lit(SPACE_CHARS))), SPACES, " "), "[0-9]", "0")).alias("hash"),
        F.size(F.split(F.btrim(l, F.lit(SPACE_CHARS)), SPACES)).alias("n_words"))))
    return rows.withColumn("row", F.monotonically_increasing_id()).select(
        "row", "id", text_key(F.col("text")).alias("key"), "host", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("raw_lines") - F.size(F.array_distinct("raw_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("starts") > 0, F.expr(covered)).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        normal.alias("lines"))


def _sql(chars: str) -> str:
    return "".join(f"\\u{ord(c):04x}" for c in chars)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def _host_hash(host: Column) -> Column:
    return F.when(host.isNull(), F.lit(0)).otherwise(F.xxhash64(host))


def _common(found: DataFrame, hosts: DataFrame, line_docs: int, line_share: float, label: str) -> DataFrame:
    """(host, hash) of the lines with more rows in `found` than either limit."""
    counts = found.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") > line_docs)
    return materialize(counts.join(hosts, "host").filter(F.col("n_docs") > line_share * F.col("host_docs")).select(
        "host", "hash"), label)


def common_lines(figures: DataFrame, line_docs: int, line_share: float) -> DataFrame:
    """(host, hash) of the lines above the limits, by the distinct texts of a host that have them."""
    # Hosts and lines are counted with partial sums, so that neither a large host nor a common line meets in one task.
    hosts = figures.groupBy(_host_hash(F.col("host")).alias("host")).agg(F.count(F.lit(1)).alias("host_docs"))
    lines = figures.select(_host_hash(F.col("host")).alias("host"), "key",
                           F.explode(F.array_distinct("lines.hash")).alias("hash"))
    # Rows are at least as many as distinct texts, so that most lines need no look at the texts they are in.
    common = _common(lines, hosts, line_docs, line_share, "quality-row-lines")
    held = lines.join(common, ["host", "hash"], "left_semi").distinct()
    return _common(held, hosts, line_docs, line_share, "quality-text-lines")


def judge(figures: DataFrame, line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE,
          least_left: float = LEAST_LEFT) -> DataFrame:
    """Add n_removed, base_failed and kept to written rows of `text_figures`."""
    common = common_lines(figures, line_docs, line_share)
    lines = figures.select("row", _host_hash(F.col("host")).alias("host"), F.explode("lines").alias("line"))
    removed = lines.select("row", "host", "line.hash", "line.n_words").join(common, ["host", "hash"], "left_semi").groupBy(
        "row").agg(F.sum("n_words").alias("n_removed"))

    judged = figures.drop("lines").join(removed, "row", "left").drop("row").withColumn(
        "n_removed", F.coalesce("n_removed", F.lit(0)).cast("long"))
    depleted = F.col("n_words") - F.col("n_removed") < least_left * F.col("n_words")
    return judged.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & ~depleted)


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                **limits: float) -> DataFrame:
    """One row for each row of `docs`: id, key (a hash of the text), host, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_removed (words in lines above the limit), base_failed, kept.

    A null text is empty and fails; a null host is a host of its own; repeated rows are judged alike; an empty table
    gives no rows; other columns are not looked at.
    """
    return judge(materialize(text_figures(docs, id_col, text_col, host_col), "quality-figures"), **limits)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
              **limits: float) -> DataFrame:
    """The rows of `docs` that the rules keep, all their columns unchanged."""
    verdicts = apply_rules(docs, id_col, text_col, host_col, **limits)
    rejected = verdicts.filter(~F.col("kept")).select(
        id_key(F.col("id")).alias("_id"), "key", _host_hash(F.col("host")).alias("_host")).distinct()
    rejected = materialize(rejected.withColumnRenamed("key", "_key"), "quality-rejected")
    rows = docs.select(
        F.struct("*").alias("kept_row"), id_key(F.col(id_col)).alias("_id"),
        text_key(whole_text(F.col(text_col))).alias("_key"),
        _host_hash(F.col(host_col).cast("string")).alias("_host"))
    return rows_without(rows, rejected, ["_id", "_key", "_host"]).select("kept_row.*")
