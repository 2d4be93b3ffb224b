"""Benchmark decontamination: SimHash of item-sized windows, a multi-index Hamming join, and an exact check.

A benchmark item of n words is compared with windows of n words (a shorter text is one window as a whole). Only a window
that holds enough of the item's 5-word shingles can be similar, so the texts' shingles first meet the items' shingles;
every window around the hits that reaches the bound `_fewest_shared` is fingerprinted. Fingerprints have 64 bits in 8
blocks. Two that differ in at most `RADIUS` = 23 bits agree in some block up to 2 bits (pigeonhole), so with each item entered
under all 37 such values of each block, one equality join finds all pairs within the radius. The pairs found are checked on
their shingles with multiplicities: the sum of the smaller counts over the sum of the larger ones has to reach
`SIMILARITY`. At that similarity fingerprints differ by about 10 bits with a deviation of 3.

Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.texts import BROADCAST_ROWS, id_key, keyed, rows_with, rows_without, text_key, whole_text, words
from newsloom.session import materialize

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS, BLOCK_ERRORS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_ERRORS + 1) - 1
#: A window of m shingles is fingerprinted if it holds this share of what similarity asks for; less cannot pass.
SHARED_BOUND = 0.5


def shingles_of(text: Column, size: int) -> Column:
    """Hashes of all shingles of a text, in order; none for a text of fewer words.

    The words are bound to a lambda's variable, so that they are split once wherever the optimizer moves this.
    """
    def hashes(own: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(own) - size),
                           lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(size)]))

    none = F.array().cast("array<bigint>")
    return F.get(F.transform(F.array(words(F.lower(text))), lambda own: F.when(
        F.size(own) < size, none).otherwise(hashes(own))), F.lit(0))


def item_shingles(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, size, n, shingles) of items with words; an item of fewer words than a shingle is one shingle by itself.

    `item` names an id, null included, and a text: texts that share an id are items of their own.
    """
    rows = items.select(F.col(id_col).alias("item_id"), whole_text(F.col(text_col)).alias("text"))
    rows = rows.withColumn("item", F.xxhash64(F.col("item_id").isNull(), "item_id", "text")).dropDuplicates(["item"])
    rows = materialize(rows.withColumn("n", F.size(words(F.col("text")))), "item-texts")
    sized = [
        rows.filter(F.col("n") == size if size < SHINGLE_WORDS else F.col("n") >= size).select(
            "item", "item_id", F.lit(size).alias("size"), "n", shingles_of(F.col("text"), size).alias("shingles"))
        for size in range(1, SHINGLE_WORDS + 1)]
    every = sized[0]
    for more in sized[1:]:
        every = every.unionByName(more)
    return materialize(every, "items")


def fingerprints(windows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fingerprint) of rows with keys and a shingle: bit b is set if more shingles have it than not."""
    votes = [F.sum(F.getbit("shingle", F.lit(b)) * 2 - 1).alias(f"v{b}") for b in range(BLOCKS * BLOCK_BITS)]
    bits = [f"IF(v{b} > 0, shiftleft(1L, {b}), 0L)" for b in range(BLOCKS * BLOCK_BITS)]
    return windows.groupBy(*keys).agg(*votes).select(*keys, F.expr(" | ".join(bits)).alias("fingerprint"))


def _flips() -> list[int]:
    return [m for m in range(1 << BLOCK_BITS) if m.bit_count() <= BLOCK_ERRORS]


def _blocks(rows: DataFrame) -> DataFrame:
    cut = [F.struct(F.lit(b).alias("block"), F.shiftrightunsigned("fingerprint", b * BLOCK_BITS).bitwiseAND(
        (1 << BLOCK_BITS) - 1).alias("value")) for b in range(BLOCKS)]
    return rows.select(*rows.columns, F.explode(F.array(*cut)).alias("cut")).select(*rows.columns, "cut.*")


def hamming_join(windows: DataFrame, items: DataFrame, on: list[str]) -> DataFrame:
    """All pairs of rows that agree in `on` and whose fingerprints differ in at most `RADIUS` bits, each once.

    Both sides carry a `fingerprint`; other column names must differ. `items` should be the smaller side.
    """
    names = [c for c in items.columns if c not in (*on, "fingerprint")]
    entered = _blocks(items.withColumnRenamed("fingerprint", "item_fingerprint").withColumn(
        "fingerprint", F.col("item_fingerprint"))).drop("fingerprint")
    entered = entered.withColumn("flip", F.explode(F.array(*map(F.lit, _flips())))).withColumn(
        "value", F.col("value").bitwiseXOR(F.col("flip"))).drop("flip")
    pairs = _blocks(windows).join(entered, [*on, "block", "value"])
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint")))
    return pairs.filter(distance <= RADIUS).select(
        *windows.columns, *names, distance.alias("distance")).dropDuplicates()


def _fewest_shared(m_window: Column, m_item: Column, similarity: float) -> Column:
    """A bound below the shingles that two lists of these lengths share at `similarity`."""
    return SHARED_BOUND * similarity * (m_window + m_item) / (1 + similarity)


def _counted(shingles: str) -> Column:
    """Each shingle hashed with how often it came before, if it did, so that sets of these are lists with multiplicities."""
    before = f"size(filter(slice({shingles}, 1, i), y -> y = x))"
    counted = f"transform({shingles}, (x, i) -> IF(array_position({shingles}, x) > i, x, xxhash64(x, {before})))"
    return F.expr(f"IF(size(array_distinct({shingles})) = size({shingles}), {shingles}, {counted})")


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row for each document and item it holds: id, key (a hash of the text), item_id, start (word), n_words,
    similarity, distance (of fingerprints), of the most similar window, the first of equals.

    Texts are compared in lower case. Null and empty texts and items match nothing; repeated rows of a document give one
    row; a null id counts as the smallest; a null item id is an id like others; of several texts under one item id each is
    looked for, and the most similar window of any counts; empty tables give no rows; other columns are not looked at.
    """
    known = item_shingles(items, item_col, item_text_col)
    found = None
    for size in range(1, SHINGLE_WORDS + 1):
        own = known.filter(F.col("size") == size)
        if size == SHINGLE_WORDS or not own.isEmpty():
            part = _leaks_of_size(docs, own, id_col, text_col, size, similarity)
            found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words", "distance"))
    return found.groupBy("id", "key", "item_id").agg(best.alias("best")).select(
        "id", "key", "item_id", (-F.col("best.back")).alias("start"), "best.n_words", "best.similarity", "best.distance")


def _leaks_of_size(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, size: int,
                   similarity: float) -> DataFrame:
    # Where a text has a shingle of an item.
    texts = keyed(docs, id_col, text_col).select("id", "key", shingles_of(F.col("text"), size).alias("shingles"))
    # The outer form adds no filter on the list, which would be worked out twice.
    places = texts.select("id", "key", (F.size("shingles") + size - 1).alias("n_doc"),
                          F.posexplode_outer("shingles").alias("place", "shingle"))
    sought = known.select("item", F.col("n").alias("n_item"), F.explode("shingles").alias("shingle")).distinct()
    sought = materialize(sought, "item-shingles")
    hits = places.join(F.broadcast(sought) if sought.count() <= BROADCAST_ROWS else sought, "shingle")
    hits = materialize(hits, "item-hits")

    # Windows around the hits, and how many hits each has.
    length = F.least("n_item", "n_doc")
    last = F.least(F.col("place"), F.col("n_doc") - length)
    first = F.least(last, F.greatest(F.lit(0), F.col("place") + size - length))
    around = hits.select("id", "key", "item", "n_item", length.alias("n_words"),
                         F.explode(F.sequence(first, last)).alias("start"))
    counted = around.groupBy("id", "key", "item", "n_item", "n_words", "start").agg(F.count(F.lit(1)).alias("hits"))
    enough = F.col("hits") >= _fewest_shared(F.col("n_words") - size + 1, F.col("n_item") - size + 1, similarity)
    windows = materialize(counted.filter(enough).select("id", "key", "item", "n_item", "n_words", "start"), "windows")

    # Their shingles, from the few texts that have such windows; several items may ask for one window.
    wanted = windows.groupBy("id", "key").agg(F.collect_set(F.struct("n_item", "n_words", "start")).alias("windows"))
    chosen = rows_with(keyed(docs, id_col, text_col), materialize(wanted, "window-texts"), ["id", "key"])
    chosen = chosen.select("id", "key", "windows", shingles_of(F.col("text"), size).alias("shingles"))
    chosen = materialize(chosen, "window-docs").dropDuplicates(["id", "key"])
    cut = F.expr(f"transform(windows, x -> struct(x.n_item AS n_item, x.n_words AS n_words, x.start AS start, "
                 f"slice(shingles, x.start + 1, greatest(x.n_words - {size - 1}, 0)) AS own))")
    cut = materialize(chosen.select("id", "key", F.explode(cut).alias("x")).select("id", "key", "x.*"), "window-shingles")

    place = ["id", "key", "n_item", "n_words", "start"]
    prints = fingerprints(cut.select(*place, F.explode("own").alias("shingle")), place)
    item_prints = fingerprints(known.select("item", F.explode("shingles").alias("shingle")), ["item"])
    # A window is compared with the items that it shares enough shingles with.
    near = hamming_join(windows.join(prints, place), item_prints, ["item"])

    # The exact check.
    pairs = near.join(cut, place).join(known.select("item", "item_id", "shingles"), "item")
    both = F.size(F.array_intersect(_counted("own"), _counted("shingles")))
    pairs = pairs.withColumn("similarity", both / (F.size("own") + F.size("shingles") - both))
    return pairs.filter(F.col("similarity") >= similarity).select(
        "id", "key", "item_id", "start", "n_words", "similarity", "distance")


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **names: str) -> DataFrame:
    """The rows of `docs` that hold no item, all their columns unchanged."""
    found = leaks(docs, items, id_col, text_col, **names)
    found = materialize(found.select(F.col("id").alias("_id"), F.col("key").alias("_key")).distinct(), "leaks")
    rows = docs.select(F.struct("*").alias("kept_row"), id_key(F.col(id_col)).alias("_id"),
                       text_key(whole_text(F.col(text_col))).alias("_key"))
    return rows_without(rows, found, ["_id", "_key"]).select("kept_row.*")
