"""Mix sources to target weights with exact block quotas and a splitting tree over output shards.

Each source's documents are hashed into blocks, in an order that is a random permutation. A source's target in words is
some whole passes over its documents plus a part of one more pass: whole blocks in block order, and of the block
in which the target falls, documents in hash order. The draws (block and pass) of all sources are then dealt to
output shards by a tree: at each node half of the draws, a multivariate hypergeometric sample of the sources,
goes left. A shard takes the next run of each source's permuted draws, so shards never share a draw, and orders
its rows by a hash of its own.

Only totals reach the driver: one row for each source, or, of more than `MAX_SOURCES` sources, for each of `GROUPS` groups of them
by hash. A group's draws are then dealt by one permutation of them all, which again is a multivariate hypergeometric sample of
its sources for every shard: one more level of the tree. Everything else is DataFrame operations: no window spans more than a
source's or a group's blocks (at most `MAX_BLOCKS` for a source) or one block's documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.texts import count_words, id_key, text_key, whole_text
from newsloom.session import materialize

#: Weights by rank of the source, repeating.
WEIGHTS = (1, 2, 3)
#: No document is repeated more often.
MOST_PASSES = 3
BLOCK_DOCS = 256
MAX_BLOCKS = 65_536
MAX_SOURCES = 100_000
GROUPS = 4096


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """One row for each source of `sized` (source_key, source, size): source_size, n_docs, target.

    Sources in code point order, null last, weigh `weights`, repeating, and share all words; a target stops at
    `most` times its source's size and the rest is shared by weight among the others. Taken in rising order of
    (limit / weight), a source is at its limit if its share of what is left would reach it.
    """
    totals = sized.groupBy("source_key", "source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    totals = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long"))
    totals = totals.withColumn("limit", F.col("source_size") * most)
    everything = Window.partitionBy()
    rising = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    totals = totals.withColumn("total", F.sum("source_size").over(everything))
    left = F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0))
    totals = totals.withColumn(
        "full", F.col("limit") * F.sum("weight").over(after) <= F.col("weight") * left)
    free_words = F.col("total") - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0)).over(everything)
    free_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)
    return totals.select(
        "source_key", "source", "source_size", "n_docs", F.when(F.col("full"), F.col("limit").cast("double"))
        .otherwise((F.col("weight") * free_words).cast("double") / free_weight).alias("target"))


def _split(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Deal each source's quota to `shards` leaves of a binary tree."""
    if shards == 1:
        return [quotas]
    left = shards // 2
    taken = rng.multivariate_hypergeometric(quotas, int(quotas.sum()) * left // shards, method="marginals")
    return _split(taken, left, rng) + _split(quotas - taken, shards - left, rng)


def shard_bounds(quotas: list[int], shards: int, seed: int) -> list[list[int]]:
    """For each source, the number of its draws in the first 1, 2, ... shards."""
    if not quotas:
        return []
    leaves = _split(np.array(quotas, dtype=np.int64), shards, np.random.default_rng(seed))
    return np.cumsum(np.stack(leaves), axis=0).T.tolist()


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES, shards: int = 8, seed: int = 7,
        max_sources: int = MAX_SOURCES) -> DataFrame:
    """One row for each row of `docs`: id, key, source, size, source_size, target, shards (one for each copy taken).

    `size(shards)` is how often the mix repeats the row; `key` is a hash of the text. Equal rows get results that
    are interchangeable. A null text has size 0, a null source is a source of its own, an empty table gives no rows.
    Columns of `docs` other than the three named ones are not looked at.
    """
    spark = docs.sparkSession
    text = whole_text(F.col(text_col))
    source = F.col(source_col).cast("string")
    sized = materialize(docs.select(
        F.col(id_col).alias("id"), text_key(text).alias("key"), source.alias("source"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("source_key"),
        count_words(text).alias("size")), "mix-sizes")

    target, size = F.col("target"), F.col("source_size")
    passes = F.when(size == 0, 0).otherwise(F.floor(target / size)).cast("long")
    targets = materialize(
        source_targets(sized, weights, most)
        .withColumn("passes", F.when(size == 0, 1).otherwise(passes).cast("int"))
        .withColumn("rest", target - passes * size)
        .withColumn("n_blocks", F.least(F.ceil(F.col("n_docs") / BLOCK_DOCS), F.lit(MAX_BLOCKS)).cast("long")),
        "mix-sources")

    permuted = F.xxhash64(F.lit(seed), "source_key", id_key(F.col("id")), "key")
    placed = sized.join(targets.drop("source"), "source_key").withColumn("order", permuted) \
        .withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "order"), F.col("n_blocks")))
    blocks = placed.groupBy("source_key", "block", "passes", "rest").agg(F.sum("size").alias("words"))
    so_far = Window.partitionBy("source_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("words").over(so_far), F.lit(0))
    blocks = materialize(
        blocks.withColumn("room", F.col("rest") - start)
        .withColumn("draws", F.col("passes") + F.when(F.col("room") > 0, 1).otherwise(0)), "mix-blocks")

    own = blocks.groupBy("source_key").agg(F.sum("draws").alias("quota"))
    many = own.limit(max_sources + 1).count() > max_sources
    dealt_by = F.pmod(F.xxhash64(F.lit(seed + 4), "source_key"), F.lit(GROUPS)).cast("string") if many else F.col("source_key")
    quotas = own.groupBy(dealt_by.alias("dealt_by")).agg(F.sum("quota").alias("quota")).orderBy("dealt_by").collect()
    bounds = spark.createDataFrame(
        [(row.dealt_by, ends) for row, ends in
         zip(quotas, shard_bounds([row.quota for row in quotas], shards, seed), strict=True)],
        "dealt_by string, bounds array<long>")
    return _with_shards(placed, blocks.withColumn("dealt_by", dealt_by), bounds, seed, ["source_key"] if many else [])


def _with_shards(placed: DataFrame, blocks: DataFrame, bounds: DataFrame, seed: int, within: list[str]) -> DataFrame:
    """Deal the draws of each block, permuted within its source or group of sources, to the shards and give the rows theirs."""
    draws = blocks.filter("draws > 0").select(
        "dealt_by", "source_key", "block", F.explode(F.sequence(F.lit(1), F.col("draws"))).alias("pass"))
    names = [*within, "block", "pass"]
    permuted = Window.partitionBy("dealt_by").orderBy(F.xxhash64(F.lit(seed + 2), *names), *names)
    draws = draws.withColumn("rank", F.row_number().over(permuted) - 1).join(bounds, "dealt_by")
    shard = F.size(F.filter("bounds", lambda end: end <= F.col("rank")))
    dealt = draws.groupBy("source_key", "block").agg(
        F.array_sort(F.collect_list(F.struct(F.col("pass"), shard.alias("shard")))).getField("shard").alias("dealt"))
    dealt = blocks.select("source_key", "block", "room", "words", "passes", "draws") \
        .join(dealt, ["source_key", "block"], "left")

    rows = placed.drop("passes").join(dealt, ["source_key", "block"])
    # Only in the block in which the target falls does it matter where a row lies.
    split = (F.col("draws") > F.col("passes")) & (F.col("room") < F.col("words"))
    inside = Window.partitionBy("source_key", "block").orderBy("order", "id", "size")
    middle = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2
    columns = ["id", "key", "source", "size", "source_size", "target"]
    whole = rows.filter(~split).select(*columns, F.coalesce("dealt", F.array().cast("array<int>")).alias("shards"))
    part = rows.filter(split).withColumn("taken", middle <= F.col("room")).select(
        *columns, F.when(F.col("taken"), F.col("dealt")).otherwise(F.slice("dealt", 1, F.col("passes"))).alias("shards"))
    return whole.unionByName(part)


def copies(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """The rows of `docs`, once for each copy the mix takes, with shard, pass and order (to sort a shard by).

    These three replace columns of `docs` that have their names.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("pass", "shard", "order")]
    rows = docs.select(F.struct(*kept).alias("kept_row"), id_key(F.col(id_col)).alias("id"),
                       text_key(whole_text(F.col(text_col))).alias("key"))
    # Equal rows may be repeated unequally; they then share the larger number.
    taken = mixed.select(id_key(F.col("id")).alias("id"), "key", "shards").groupBy("id", "key").agg(
        F.max("shards").alias("shards"))
    rows = rows.join(taken, ["id", "key"]).select("kept_row", "id", "key", F.posexplode("shards").alias("pass", "shard"))
    return rows.select("kept_row.*", "pass", "shard", F.xxhash64(F.lit(seed + 3), "shard", "id", "key", "pass").alias(
        "order"))


def words_taken() -> Column:
    return F.col("size") * F.size("shards")
