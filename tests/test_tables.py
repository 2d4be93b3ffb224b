import re

import pytest
from pyspark.sql import functions as F

from newsloom.operators import delta, dimensions, mart
from newsloom.operators.lookup import lookup, measured_bytes, with_keys
from newsloom.operators.ordering import arrival_ids, number_rows, running_total
from newsloom.schemas import dimension
from newsloom.session import materialize, scratch_dir
from newsloom.sources import csv_files, publication, tables


@pytest.fixture
def db(spark, request):
    name = request.node.name.replace("[", "_").replace("]", "")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return name


def rows(df):
    return sorted(map(tuple, df.collect()))


def tables_of(spark, db):
    return sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect())


def test_scratch_dir_is_the_configured_one(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_publish_all_or_none(spark, db):
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.publish(spark, {f"{db}.t1": one, f"{db}.t2": one})
    two = spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string")
    assert tables.publish(spark, {f"{db}.t1": two, f"{db}.t2": two.select("v")}) == {f"{db}.t1": 2, f"{db}.t2": 2}
    assert rows(spark.table(f"{db}.t1")) == [(2, "b"), (3, "c")]
    assert {r.k for r in spark.table(f"{db}.t2").collect()} == {None}
    bad = spark.createDataFrame([("x", "b")], "k string, v string")
    with pytest.raises(Exception):
        tables.publish(spark, {f"{db}.t1": one, f"{db}.t2": bad})
    assert rows(spark.table(f"{db}.t1")) == [(2, "b"), (3, "c")]
    assert tables_of(spark, db) == ["swap_log", "t1", "t2"]


def test_unknown_columns_are_refused(spark, db):
    tables.append_rows(spark.createDataFrame([(1,)], "k int"), f"{db}.t")
    with pytest.raises(ValueError):
        tables.append_rows(spark.createDataFrame([(1, 2)], "k int, other int"), f"{db}.t")


def one_row(spark, value):
    return spark.createDataFrame([(value,)], "v string")


@pytest.mark.parametrize("gap", range(7))
def test_a_swap_that_breaks_off_is_mended_at_the_next_start(spark, db, gap, monkeypatch):
    """The process ends after any number of renames, drops and log rows; before the log row all is old, after it all new."""
    names = [f"{db}.a", f"{db}.b"]
    tables.publish(spark, {n: one_row(spark, "old") for n in names})
    steps = []

    def ending(step):
        def run(*args, **kinds):
            if len(steps) == gap:
                raise SystemExit
            steps.append(step)
            return step(*args, **kinds)
        return run

    monkeypatch.setattr(tables, "_rename", ending(tables._rename))
    monkeypatch.setattr(tables, "_log_swap", ending(tables._log_swap))
    if gap < 6:
        with pytest.raises(SystemExit):
            tables.publish(spark, {n: one_row(spark, "new") for n in names})
    else:
        tables.publish(spark, {n: one_row(spark, "new") for n in names})
    monkeypatch.undo()
    tables.recover(spark, db)
    assert {spark.table(n).first().v for n in names} == {"old" if gap == 0 else "new"}
    assert tables_of(spark, db) == ["a", "b", "swap_log"]
    tables.recover(spark, db)
    assert tables.replace_rows(one_row(spark, "next"), names[0]) == 1


def test_publications_change_all_tables_at_once(spark, db, monkeypatch):
    frames = {"t1": one_row(spark, "1"), "t2": one_row(spark, "1")}
    assert publication.publish(spark, db, frames) == {"t1": 1, "t2": 1}
    assert rows(spark.table(f"{db}.t1")) == [("1",)]
    two = {"t1": one_row(spark, "2").union(one_row(spark, "2")), "t2": one_row(spark, "2")}
    # The process ends when the first table is loaded, and when all are.
    for step, n_calls in (("insert_by_name", 2), ("_point_to", 1)):
        calls = []
        real = getattr(publication, step)

        def ending(*args, **kinds):
            calls.append(1)
            if len(calls) == n_calls:
                raise SystemExit
            return real(*args, **kinds)

        monkeypatch.setattr(publication, step, ending)
        with pytest.raises(SystemExit):
            publication.publish(spark, db, two)
        monkeypatch.undo()
        assert rows(spark.table(f"{db}.t1")) == rows(spark.table(f"{db}.t2")) == [("1",)]
        assert spark.sql(f"SHOW PARTITIONS {db}.t1__rows").count() == 2
    publication.publish(spark, db, two)
    assert rows(spark.table(f"{db}.t1")) == [("2",), ("2",)] and rows(spark.table(f"{db}.t2")) == [("2",)]
    # Leftovers are gone, the publication before stays.
    assert spark.sql(f"SHOW PARTITIONS {db}.t1__rows").count() == 2
    publication.publish(spark, db, {"t1": one_row(spark, "3")})
    assert rows(spark.table(f"{db}.t1")) == [("3",)] and rows(spark.table(f"{db}.t2")) == []
    with pytest.raises(ValueError):
        publication.publish(spark, db, {"t1": spark.range(1).withColumnRenamed("id", "Publication")})


def test_readers_of_a_published_table_scan_one_publication(spark, db):
    for value in "12":
        publication.publish(spark, db, {"t": one_row(spark, value)})
    plan = spark.table(f"{db}.t")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"t__rows.*PartitionFilters: \[.*publication#[0-9]+ = ", plan), plan


def test_load_mart_stops_before_any_write_if_a_file_is_missing(spark, db, tmp_path):
    old = spark.createDataFrame([(1, "old")], "tag_key long, tag_name string")
    publication.publish(spark, db, {"DimTag": old, "DimSource": old})
    csv_files.write_with_header(spark.createDataFrame([(2, "new")], old.schema), str(tmp_path / "tag.csv"))
    paths = {"DimTag": str(tmp_path / "tag.csv"), "DimSource": str(tmp_path / "missing.csv")}
    with pytest.raises(Exception):
        mart.load_mart(spark, paths, db)
    assert rows(spark.table(f"{db}.DimTag")) == [(1, "old")]
    assert spark.sql(f"SHOW PARTITIONS {db}.DimTag__rows").count() == 1


def files_of(spark, table):
    import glob
    location = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first().data_type.split(":", 1)[1]
    return {f[len(location):] for f in glob.glob(f"{location}/**/*.parquet", recursive=True)}


def test_merge_rewrites_touched_buckets_only(spark, db):
    table, schema = f"{db}.facts", "k long, v string, m int, bucket int"
    old = spark.range(200).selectExpr("id AS k", "'old' AS v", "cast(id % 3 AS int) AS m", "cast(id % 8 AS int) AS bucket")
    tables.create_table(spark, table, old.schema, ["m", "bucket"])
    tables.append_rows(old, table)
    before = files_of(spark, table)
    assert len(before) == 24
    # Key 0 lies in month 0, bucket 0; key 9 moves from month 0 to month 2, both in bucket 1; key 208 is new.
    tables.merge_rows(spark, table, spark.createDataFrame([(0, "new", 0, 0), (9, "new", 2, 1), (208, "new", 1, 0)], schema), ["k"],
                      ["m", "bucket"])
    written = {f.rsplit("/", 1)[0] for f in files_of(spark, table) - before}
    assert written == {"/m=0/bucket=0", "/m=0/bucket=1", "/m=2/bucket=1", "/m=1/bucket=0"}
    assert {f.rsplit("/", 1)[0] for f in before - files_of(spark, table)} == written
    assert rows(spark.table(table).select("k", "m").filter("v = 'new'")) == [(0, 0), (9, 2), (208, 1)]
    assert spark.table(table).count() == 201


def test_the_overwrite_mode_of_the_session_stays(spark, db):
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    tables.create_table(spark, f"{db}.t", spark.createDataFrame([], "k int, m int").schema, ["m"])
    assert tables.append_rows(spark.createDataFrame([(1, 1)], "k int, m int"), f"{db}.t") == 1
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def moved_columns(df):
    """Columns that exchanges and sorts of the plan pass on; broadcasts apart."""
    def nodes(plan):
        if plan.nodeName() == "AdaptiveSparkPlan":
            plan = plan.initialPlan()
        yield plan
        children = plan.children()
        for i in range(children.size()):
            yield from nodes(children.apply(i))

    moving = [n for n in nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName() in ("Exchange", "Sort")]
    return {n.output().apply(i).name() for n in moving for i in range(n.output().size())}


def test_ids_follow_the_files_and_move_nothing(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).selectExpr("id AS k", "repeat('x', 50) AS content").repartition(7).write.parquet(path)
    table = spark.read.parquet(path)
    numbered = arrival_ids(table, "no")
    assert sorted(r.no for r in numbered.collect()) == list(range(1, 1001))
    again = {r.no: r.k for r in arrival_ids(table.filter("k % 2 = 0"), "no").collect()}
    assert {n: k for n, k in ((r.no, r.k) for r in numbered.collect()) if n in again}.keys() == again.keys()
    assert sorted(r.no for r in arrival_ids(table.limit(0), "no", 5).collect()) == []
    assert moved_columns(numbered.select("no", "content")) == {"_file", "count", "_rows"}


def test_clean_ids_and_deltas_do_not_move_texts(spark):
    from newsloom.plans import queries
    assert moved_columns(queries.clean_ids(spark, "/root/testdata/sf0.001")) == {"_file", "count", "_rows"}
    assert moved_columns(queries.staging_delta(spark, "/root/testdata/sf0.001")) <= {"_file", "count", "_rows"}


def test_merge_rewrites_touched_partitions_only(spark, db):
    import glob
    table = f"{db}.facts"
    tables.create_table(spark, table, spark.createDataFrame([], "k int, v string, m int").schema, ["m"])
    tables.append_rows(spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 3), (5, "e", None)], "k int, v string, m int"), table)
    location = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first().data_type.split(":", 1)[1]
    untouched = glob.glob(f"{location}/m=2/*.parquet")
    incoming = spark.createDataFrame([(1, "A", 1), (4, "D", 1), (6, "f", 4)], "k int, v string, m int")
    removed = spark.createDataFrame([(5,)], "k int")
    tables.merge_rows(spark, table, incoming, ["k"], ["m"], removed=removed)
    assert rows(spark.table(table)) == [(1, "A", 1), (2, "b", 1), (3, "c", 2), (4, "D", 1), (6, "f", 4)]
    assert glob.glob(f"{location}/m=2/*.parquet") == untouched
    tables.merge_rows(spark, table, incoming.limit(0), ["k"], ["m"])
    assert spark.table(table).count() == 5


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_lookup_with_hot_keys_gives_the_plain_join(spark, how):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).when(F.col("id") % 7 == 0, "gone")
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 400).cast("string"))).alias("name"), "id")
    dim = spark.range(400).select(F.concat(F.lit("k"), "id").alias("name"), F.col("id").alias("key")).unionByName(
        spark.createDataFrame([("hot", -1)], "name string, key long"))
    plain = facts.join(dim, "name", how)
    for size in (0, 1 << 20):
        got = lookup(facts, dim, "name", how, max_bytes=size)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))
    assert measured_bytes(dim) > 400 * 8


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left_semi", "left_anti", "left"])
def test_many_keys_are_not_broadcast(spark, how):
    # Written, as merges do: the file is small, the hash table in the driver would not be.
    keys = materialize(spark.range(1_500_000).withColumnRenamed("id", "k"), "test-keys")
    assert measured_bytes(keys) > 32 * 1024 * 1024
    table = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("v"))
    assert "BroadcastExchange" not in _plan(with_keys(table, keys, ["k"], how))
    assert with_keys(table, keys, ["k"], how).count() == (0 if how == "left_anti" else 10)
    assert "BroadcastExchange" in _plan(with_keys(table, keys.filter("k < 1000000"), ["k"], how))


def test_a_dimension_measured_too_large_is_not_broadcast(spark):
    dim = materialize(spark.range(1000).select(F.col("id").alias("k"), F.lit("name").alias("name")), "test-dim")
    facts = spark.range(5000).select((F.col("id") % 1000).alias("k"))
    assert "BroadcastExchange" not in _plan(lookup(facts, dim, "k", max_bytes=1))
    assert lookup(facts, dim, "k", max_bytes=1).filter("name = 'name'").count() == 5000


def test_numbers_and_totals_over_partitions(spark):
    df = spark.range(1000).select(((F.col("id") * 37) % 1000).alias("k"), (F.col("id") % 5).alias("n")).repartition(7)
    numbered = number_rows(df, ["k"], "no", first=11).orderBy("k").collect()
    assert [r.no for r in numbered] == list(range(11, 1011))
    total = 0
    for row in running_total(df, ["k"], "n", "so_far").orderBy("k").collect():
        total += row.n
        assert row.so_far == total


def test_numbers_of_few_or_no_rows(spark):
    one = spark.createDataFrame([("x",)], "k string")
    assert [r.no for r in number_rows(one, ["k"], "no").collect()] == [1]
    assert number_rows(one.limit(0), ["k"], "no").collect() == []
    assert running_total(one.limit(0).withColumn("n", F.lit(1)), ["k"], "n", "s").collect() == []


def test_new_members(spark):
    dim = spark.createDataFrame([(7, "b")], dimension("tag"))
    names = spark.createDataFrame([("c",), ("b",), ("a",), ("c",), (None,)], "tag_name string")
    assert rows(dimensions.new_members(dim, names, "tag_key", "tag_name")) == [(8, "a"), (9, "c")]
    assert rows(dimensions.extended(dim.limit(0), names, "tag_key", "tag_name")) == [(1, "a"), (2, "b"), (3, "c")]


def test_changes(spark):
    old = spark.createDataFrame([("same", "1"), ("was", "1"), ("none", None)], "k string, mark string")
    new = spark.createDataFrame([("same", "1"), ("was", "2"), ("new", "1"), ("none", None)], "k string, mark string")
    assert rows(delta.find_changes(new, old, ["k"], "mark")) == [("new", "1", "insert"), ("was", "2", "update")]


def test_latest_per_key_cuts_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", 1, "x")], "k string, t int, v string")
    latest = delta.latest_per_key(df, ["k"], [F.col("t").desc_nulls_last(), F.col("v")])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the exchange
    assert rows(latest) == [("a", 3, "y"), ("b", 1, "x")]


def test_top_trends_and_monthly_counts(spark):
    # Articles 1 and 2 have one CRC.
    fact = spark.createDataFrame([(7, 1, 2024, 1, 1, 1), (7, 2, 2024, 1, 1, 1), (3, 3, 2024, 2, 1, 2), (4, 4, 2024, 2, 2, 2)],
                                 "article_key long, address_mark long, article_year int, article_month int, category_key long, source_key long")
    bridge = spark.createDataFrame([(7, 1, 10), (7, 1, 10), (7, 1, 11), (7, 2, 10), (3, 3, 10), (9, 9, 10), (7, 9, 12)],
                                   "article_key long, address_mark long, tag_key long")
    counts = mart.monthly_counts(fact, bridge)
    assert rows(counts) == [(2024, 1, 1, 10, 1, 2), (2024, 1, 1, 11, 1, 1), (2024, 2, 1, 10, 2, 1)]
    assert rows(mart.top_trends(counts, 1)) == [(2024, 1, 10, 2, 1), (2024, 2, 10, 1, 1)]
