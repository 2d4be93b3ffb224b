"""Several tables that readers see change as one.

The rows of a published table lie in `<table>__rows`, partitioned by publication. `<table>` itself is a view of the rows of the
current publication, which is the newest row of `publications`, the one pointer that all views of a database follow. A
publication loads its partitions first and then adds that row: one file, which is there as a whole or not at all. Before
it all tables are as they were, after it all are new. What a broken-off publication has left is removed by the next, or by
`recover`. The publication before the current one is kept for readers that still scan it.

Other sessions see a new publication once their file listing is renewed (`refresh`).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.sources.tables import create_table, insert_by_name

#: Publications that stay, the current one included.
KEPT = 2
POINTERS = T.StructType([
    T.StructField("publication", T.StringType()), T.StructField("number", T.LongType()),
    T.StructField("n_rows", T.LongType()), T.StructField("published_at", T.TimestampType())])


def _pointers(database: str) -> str:
    return f"{database}.publications"


def _store(database: str, table: str) -> str:
    return f"{database}.{table}__rows"


def create(spark: SparkSession, database: str, schemas: Mapping[str, T.StructType]) -> None:
    """Create published tables that are not there; they are empty before the first publication."""
    create_table(spark, _pointers(database), POINTERS)
    for table, schema in schemas.items():
        stored = T.StructType([*schema.fields, T.StructField("publication", T.StringType())])
        create_table(spark, _store(database, table), stored, ["publication"])
        columns = ", ".join(f"`{f.name}`" for f in schema.fields)
        spark.sql(f"""CREATE VIEW IF NOT EXISTS {database}.{table} AS SELECT {columns} FROM {_store(database, table)}
            WHERE publication = (SELECT max_by(publication, number) FROM {_pointers(database)})""")


def publish(spark: SparkSession, database: str, frames: Mapping[str, DataFrame]) -> dict[str, int]:
    """Replace the tables by the given rows, all at once; rows per table. Tables of the database that are not named become empty."""
    recover(spark, database)
    new = {table: df.schema for table, df in frames.items() if not spark.catalog.tableExists(f"{database}.{table}")}
    create(spark, database, new)
    publication = uuid.uuid4().hex
    loaded = {}
    for table, df in frames.items():
        if "publication" in {c.lower() for c in df.columns}:
            raise ValueError(f"{table}: a column named publication cannot be published")
        loaded[table] = insert_by_name(df.withColumn("publication", F.lit(publication)), _store(database, table))
    _point_to(spark, database, publication, sum(loaded.values()))
    recover(spark, database)
    return loaded


def _point_to(spark: SparkSession, database: str, publication: str, n_rows: int) -> None:
    pointers = spark.table(_pointers(database))
    number = (pointers.agg(F.max("number")).first()[0] or 0) + 1
    insert_by_name(spark.range(0, 1, 1, 1).select(
        F.lit(publication).alias("publication"), F.lit(number).cast("long").alias("number"),
        F.lit(n_rows).cast("long").alias("n_rows"), F.current_timestamp().alias("published_at")), _pointers(database))


def recover(spark: SparkSession, database: str) -> None:
    """Remove rows of publications that were never pointed to, and of those before the last `KEPT`."""
    if not spark.catalog.tableExists(_pointers(database)):
        return
    refresh(spark, database)
    kept = {r["publication"] for r in spark.table(_pointers(database)).orderBy(F.desc("number")).limit(KEPT).collect()}
    for store in _stores(spark, database):
        for row in spark.sql(f"SHOW PARTITIONS {store}").collect():
            publication = row["partition"].split("=", 1)[1]
            if publication not in kept:
                spark.sql(f"ALTER TABLE {store} DROP IF EXISTS PARTITION (publication='{publication}')")


def refresh(spark: SparkSession, database: str) -> None:
    """Look at the files again: another session may have published."""
    for table in [_pointers(database), *_stores(spark, database)]:
        spark.catalog.refreshTable(table)


def _stores(spark: SparkSession, database: str) -> list[str]:
    found = spark.sql(f"SHOW TABLES IN {database}").filter(F.endswith("tableName", F.lit("__rows"))).collect()
    return [f"{database}.{r['tableName']}" for r in found]
