"""Spelling variants of the words of a corpus, grouped by one-edit links to more frequent words.

Words that differ by one inserted, deleted or replaced code point are near. They are found by reduced-alphabet generation: every
letter is hashed to one of a few symbols, which makes one reduced word of many words. Two words at one edit have reduced
words at one edit or none, so the full one-edit neighbourhood of every reduced word (itself, and every symbol deleted, replaced or
inserted) is generated over the few symbols and joined to the reduced vocabulary. The words behind the pairs of reduced words that
exist are then compared as they are written. Of two words at one edit, either the first or the last half is the same
(by the length of the shorter one), so words meet only if they also share a half; a group of very many words under one
reduced word is split by that, and nothing is lost.

Words are maximal runs of letters, with A to Z in lower case. `planted_slips` deletes a letter from one run in 97, by a hash of document
and run, so that a corpus has variants to find. Counts go over the whole texts of all documents, with partial sums in
each task, so a word that fills a third of the corpus is one row per task. All later steps work on the vocabulary, in tables.

The form of a word is its most frequent near word, by ties the smallest in code-point order, if that is at least `RATIO` times as
frequent; its root is where the forms of forms end. The number of occurrences grows by `RATIO` from step to step, so the way to a root
is at most the logarithm of the largest count long; roots are found by joins that double the way.

Null and empty texts have no words, a null document id is written as nothing, repeated rows count as often as they are there, and an
empty table gives no row. Texts of any length are read whole. Only the two named columns are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import materialize

#: A word is counted from this length, and is in the vocabulary from this number of occurrences.
MIN_LENGTH, MIN_COUNT = 5, 3
#: A form occurs at least this many times as often as its word.
RATIO = 2
#: Symbols of the reduced alphabet.
SYMBOLS = 5
#: One run in so many loses a letter.
SLIP = 97
RUN = r"[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
_LETTERS = _LOWER + "".join(map(chr, range(0xC0, 0x100)))


def lower_ascii(run: Column) -> Column:
    """A to Z in lower case, other letters as they are."""
    ascii_only = F.octet_length(run) == F.length(run)
    return F.when(ascii_only, F.lower(run)).otherwise(F.translate(run, _UPPER, _LOWER))


def planted_slips(doc_id: Column, run: Column) -> Column:
    """The run, without one of its letters if the hash of document and run is a multiple of `SLIP`."""
    mark = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (mark % F.length(run)).cast("int")
    cut = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(mark % SLIP == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT) -> DataFrame:
    """`word`, `n`: the words of all texts, with their occurrences."""
    text = F.col(f"`{text_col}`").cast("string")
    runs = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    # A slip takes a letter away, so shorter runs cannot become words.
    words = runs.filter(F.length("run") >= min_length).select("id", lower_ascii(F.col("run")).alias("run")).select(
        planted_slips(F.col("id"), F.col("run")).alias("word"))
    counts = words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= min_count)


def reduced(word: Column, symbols: int = SYMBOLS) -> Column:
    """The word with every letter hashed to a symbol."""
    return F.translate(word, _LETTERS, "".join(chr(97 + (ord(c) * 7 + ord(c) // 16) % symbols) for c in _LETTERS))


def neighbourhood(word: Column, symbols: int = SYMBOLS) -> Column:
    """All distinct strings over the symbols at no more than one edit from a reduced word."""
    letters = F.array(*[F.lit(chr(97 + i)) for i in range(symbols)])

    def at(i: Column) -> Column:
        before, after = F.substr(word, F.lit(1), i), F.substr(word, i + 2)
        replaced = F.transform(letters, lambda s: F.concat(before, s, after))
        inserted = F.transform(letters, lambda s: F.concat(before, s, F.substr(word, i + 1)))
        return F.concat(F.array(F.concat(before, after)), replaced, inserted)

    inside = F.flatten(F.transform(F.sequence(F.lit(0), F.length(word) - 1), at))
    return F.array_distinct(F.concat(F.array(word), F.transform(letters, lambda s: F.concat(word, s)), inside))


def _halves(word: Column, shorter: Column) -> Column:
    """First and last half, by the length of the shorter word of a pair, each with its side."""
    half = F.floor(shorter / 2).cast("int")
    return F.array(F.concat(F.lit("<"), F.substr(word, F.lit(1), half)), F.concat(F.lit(">"), F.right(word, half)))


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """`word`, `near`, `near_n`: every ordered pair of words of a written vocabulary (`word`, `n`) at exactly one edit."""
    own = materialize(words.withColumn("key", reduced(F.col("word"), symbols)), "reduced-words")
    keys = own.select("key").distinct()
    around = keys.select("key", F.explode(neighbourhood(F.col("key"), symbols)).alias("other"))
    pairs = around.join(keys.withColumnRenamed("key", "other"), "other", "left_semi")
    pairs = materialize(pairs, "reduced-pairs")

    size, other_size = F.length("word"), F.length("other")
    asked = own.join(pairs, "key").select("word", "other", F.explode(_halves(F.col("word"), F.least(size, other_size))).alias("half"))
    # A word is met by words shorter by one letter, which set the half's length, and by others.
    met = own.select(
        F.col("key").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"),
        F.explode(F.array_distinct(F.concat(_halves(F.col("word"), size), _halves(F.col("word"), size - 1)))).alias("half"))
    found = asked.join(met, ["other", "half"]).filter(
        (F.abs(F.length("near") - F.length("word")) <= 1) & (F.levenshtein("word", "near", 1) == 1))
    # A pair may share both halves.
    return found.select("word", "near", "near_n").distinct()


def forms(words: DataFrame, near: DataFrame, ratio: int = RATIO) -> DataFrame:
    """`word`, `n`, `n_near`, and `form`, `form_n` or nulls."""
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"))


def with_roots(formed: DataFrame) -> DataFrame:
    """Add `root`, the end of the forms of forms: the word itself if it has none."""
    ways = materialize(formed.select("word", F.coalesce("form", "word").alias("root")), "word-roots")
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = materialize(ways.join(onward, "root").select("word", F.col("next").alias("root"), (
            F.col("next") != F.col("root")).alias("moved")), "word-roots")
        ways = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            break
    return formed.join(ways, "word")


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", symbols: int = SYMBOLS) -> DataFrame:
    """Every word with its form, its root and its number of near words."""
    words = materialize(vocabulary(docs, id_col, text_col), "vocabulary")
    formed = materialize(forms(words, near_words(words, symbols)), "word-forms")
    return with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n")
