"""Catalog tables: append, replace, merge and publish.

Plain parquet tables have no MERGE or transactions. Full replacements and
publications are written beside the live table and swapped in when every
write has succeeded; merges rewrite only the partitions they touch.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators.lookup import with_keys
from newsloom.session import materialize, setting


def create_table(spark: SparkSession, table: str, schema: T.StructType,
                 partition_by: Sequence[str] = ()) -> None:
    """Create the table unless it is there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    places = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{places}")


def append_rows(df: DataFrame, table: str) -> int:
    """Append by column name; columns that `df` lacks become NULL. Rows written."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        create_table(spark, table, df.schema)
    return insert_by_name(df, table)


def in_places(columns: Sequence[str], places: Collection[Sequence]) -> Column:
    """Does a row lie in one of these partitions? On partition columns alone, so the other partitions are not read."""
    def marked(values: Sequence) -> str:
        return "/".join("-" if v is None else f"={v}" for v in values)

    place = F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns])
    return place.isin(*[marked(p) for p in places]) if places else F.lit(False)


def insert_by_name(df: DataFrame, table: str, overwrite: bool = False) -> int:
    """Insert by column name, columns that `df` lacks as NULL; the number of rows, counted as they are written.

    With `overwrite`, the partitions that `df` has rows for are replaced.
    """
    spark = df.sparkSession
    target = spark.table(table).schema
    present = {c.lower(): c for c in df.columns}
    unknown = set(present) - {f.name.lower() for f in target.fields}
    if unknown:
        raise ValueError(f"{table} has no columns {sorted(unknown)}")

    def value(name: str, kind: T.DataType) -> Column:
        if name.lower() not in present:
            return F.lit(None)
        c = F.col(f"`{present[name.lower()]}`")
        is_text = isinstance(df.schema[present[name.lower()]].dataType, T.StringType)
        # A blank is a text only; as a number or a date it is missing.
        return F.nullif(F.trim(c), F.lit("")) if is_text and not isinstance(kind, T.StringType) else c

    columns = [value(f.name, f.dataType).cast(f.dataType).alias(f.name) for f in target.fields]
    rows = df.select(*columns)
    places = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if places:
        # Gather a partition's rows into few files; a large partition is split again at run time.
        rows = rows.hint("rebalance", *places)
    # Observed behind the last shuffle, so that a repeated task counts once.
    seen = Observation()
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.insertInto(table, overwrite=overwrite)
    return seen.get["n"]


# --- replacement by swap ------------------------------------------------------------------------
#
# A replacement is loaded into clones `<table>_temp_<suffix>`. When all are loaded, a row in the swap log says so: before
# it, nothing has happened, and after it, the swap is completed, by this run or by the next start (`recover`).

LOADED, DONE = "LOADED", "DONE"
SWAP_LOG_SCHEMA = T.StructType([
    T.StructField("suffix", T.StringType()), T.StructField("tables", T.StringType()),
    T.StructField("state", T.StringType()), T.StructField("logged_at", T.TimestampType())])


def _database(table: str) -> str:
    return table.rsplit(".", 1)[0]


def _swap_log(database: str) -> str:
    return f"{database}.swap_log"


def _log_swap(spark: SparkSession, database: str, suffix: str, names: Sequence[str], state: str) -> None:
    create_table(spark, _swap_log(database), SWAP_LOG_SCHEMA)
    # One file, which is there as a whole or not at all.
    insert_by_name(spark.range(0, 1, 1, 1).select(
        F.lit(suffix).alias("suffix"), F.lit(",".join(names)).alias("tables"), F.lit(state).alias("state"),
        F.current_timestamp().alias("logged_at")), _swap_log(database))


def temp_suffix() -> str:
    return f"_temp_{uuid.uuid4().hex[:8]}"


def _aside(suffix: str) -> str:
    return suffix.replace("_temp_", "_old_")


def publish(spark: SparkSession, frames: Mapping[str, DataFrame]) -> dict[str, int]:
    """Replace tables of one database by the given rows, all of them or none; rows per table.

    Between the renames of a table it is missing for a moment. Where readers must see several tables change as
    one, use `sources.publication`.
    """
    suffix = temp_suffix()
    database = _database(next(iter(frames)))
    loaded = {}
    try:
        for table, df in frames.items():
            clone = table + suffix
            if spark.catalog.tableExists(table):
                spark.sql(f"CREATE TABLE {clone} LIKE {table}")
            else:
                create_table(spark, clone, df.schema)
            loaded[table] = insert_by_name(df, clone)
    except Exception:
        for table in frames:
            spark.sql(f"DROP TABLE IF EXISTS {table + suffix}")
        raise
    _log_swap(spark, database, suffix, list(frames), LOADED)
    _swap(spark, database, suffix, list(frames))
    return loaded


def _swap(spark: SparkSession, database: str, suffix: str, names: Sequence[str]) -> None:
    """Put loaded clones in the place of their tables, from wherever an earlier attempt was left."""
    for table in names:
        clone, old = table + suffix, table + _aside(suffix)
        if spark.catalog.tableExists(clone):
            if spark.catalog.tableExists(table):
                _rename(spark, table, old)
            _rename(spark, clone, table)
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    _log_swap(spark, database, suffix, names, DONE)


def recover(spark: SparkSession, database: str) -> None:
    """Complete swaps that were logged as loaded and not done, and drop clones of those that were not loaded."""
    if not spark.catalog.databaseExists(database):
        return
    if spark.catalog.tableExists(_swap_log(database)):
        spark.catalog.refreshTable(_swap_log(database))
        log = spark.table(_swap_log(database))
        done = log.filter(F.col("state") == DONE).select("suffix")
        # Only swaps of runs that broke off: as a rule none.
        for row in log.filter(F.col("state") == LOADED).join(done, "suffix", "left_anti").orderBy("logged_at").collect():
            _swap(spark, database, row["suffix"], row["tables"].split(","))
    for row in spark.sql(f"SHOW TABLES IN {database}").filter(F.col("tableName").rlike("_temp_[0-9a-f]{8}$")).collect():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{row['tableName']}")


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def replace_rows(df: DataFrame, table: str) -> int:
    """Truncate and load; on failure the old rows stay."""
    return publish(df.sparkSession, {table: df})[table]


def upserted(current: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """`current` with the rows of the incoming keys replaced by `incoming`."""
    kept = current.join(incoming.select(*key).distinct(), list(key), "left_anti")
    return kept.select(*current.columns).unionByName(incoming.select(*current.columns))


def merge_rows(spark: SparkSession, table: str, incoming: DataFrame, key: Sequence[str],
               partition_by: Sequence[str], removed: DataFrame | None = None, written: bool = False) -> None:
    """Type-1 merge into a partitioned table, rewriting only the partitions with affected rows.

    `incoming` replaces all rows of its keys and those of `removed`. Both may
    come out of the table itself, so they are written down first, unless the
    caller says that they stem from `written` rows. Key and partition columns
    are read to find the partitions, and which of them end up empty; whole rows
    are read and written once, in these partitions. The list of them is held in the
    driver: partitions are calendar months or buckets of them, so it is short.
    """
    key, partition_by = list(key), list(partition_by)
    incoming = incoming.select(*spark.table(table).columns)
    if not written:
        incoming = materialize(incoming, "merge")
    gone = incoming.select(*key)
    if removed is not None:
        gone = gone.unionByName(removed.select(*key))
    gone = materialize(gone.distinct(), "merge-keys")

    held = with_keys(spark.table(table).select(*key, *partition_by), gone.withColumn("_gone", F.lit(True)), key, "left")
    per_place = held.groupBy(*partition_by).agg(
        F.count_if(F.col("_gone").isNotNull()).alias("_gone"), F.count("*").alias("_held")).filter("_gone > 0")
    old = {tuple(r[c] for c in partition_by): r["_held"] - r["_gone"] for r in per_place.collect()}
    new = {tuple(r) for r in incoming.select(*partition_by).distinct().collect()}
    if not old and not new:
        return
    current = spark.table(table)
    kept = with_keys(current.filter(in_places(partition_by, old.keys() | new)), gone, key, "left_anti")
    insert_by_name(kept.select(*current.columns).unionByName(incoming), table, overwrite=True)
    drop_places(spark, table, partition_by, [p for p, left in old.items() if not left and p not in new])


def drop_places(spark: SparkSession, table: str, partition_by: Sequence[str], places: Sequence[Sequence]) -> None:
    """Drop partitions that an overwrite has not reached, as no row is left for them."""
    for values in places:
        spec = ", ".join(f"{c}={_sql_literal(v)}" for c, v in zip(partition_by, values))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(table)


def replace_places(df: DataFrame, table: str, partition_by: Sequence[str], places: Sequence[Sequence]) -> int:
    """Replace the named partitions of a table by `df`, which has rows for these only; rows written."""
    spark = df.sparkSession
    rows = materialize(df, "replaced-places")
    left = {tuple(r) for r in rows.select(*partition_by).distinct().collect()}
    n = insert_by_name(rows, table, overwrite=True)
    drop_places(spark, table, partition_by, [p for p in places if tuple(p) not in left])
    return n


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "\\'") + "'"


def read_jdbc(spark: SparkSession, url: str, table: str, split_on: str, low: int, high: int,
              tasks: int, **options: str) -> DataFrame:
    """A database table in `tasks` ranges of the column `split_on`; the driver jar is the user's to add."""
    return spark.read.jdbc(url, table, column=split_on, lowerBound=low, upperBound=high,
                           numPartitions=tasks, properties=options)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    """Batched inserts; `mode="overwrite"` truncates and keeps the table's definition."""
    df.write.option("truncate", True).option("batchsize", 10_000).jdbc(
        url, table, mode=mode, properties=options)
