import pytest
from pyspark.sql import functions as F

from newsloom.operators import runlog
from newsloom.plans.daily_run import DailyRun, Layers
from newsloom.schemas import ARTICLE_CSV, ARTICLE_ID
from newsloom.sources import csv_files, tables
from test_extraction import tables as crawl_tables


def article(url, title, tags, scraped="2024-01-01 06:00:00", published="2024-01-01 05:00:00", content="<p>Xin chào: -</p>"):
    return (url, "VnExpress", "Xe", "N/A", published, title, "N/A", content, tags, scraped, "c1")


def make(spark, tmp_path, prefix):
    return DailyRun(spark, Layers(*[f"{prefix}_{x}" for x in ("control", "staging", "warehouse", "mart")]), str(tmp_path))


def write(spark, tmp_path, rows, name):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ARTICLE_CSV))
    csv_files.write_with_header(df, str(tmp_path / name))


def state(spark, at):
    facts = {r.article_url: (r.title, r.article_year, r.article_month) for r in spark.table(at.fact).collect()}
    tags = spark.table(at.bridge).join(spark.table(at.dim("tag")), "tag_key").join(
        spark.table(at.fact).select(*ARTICLE_ID, "article_url"), ARTICLE_ID)
    mart = {tuple(r) for r in spark.table(f"{at.mart}.Agg_Mart_Top_Trends").collect()}
    return facts, {(r.article_url, r.tag_name) for r in tags.collect()}, mart


def ends(run):
    started = {r.run_id: r.job_name for r in run.log.rows().filter("event = 'START'").collect()}
    return [(started[r.run_id], r.status, r.extracted, r.loaded)
            for r in run.log.rows().filter("event = 'END'").orderBy("logged_at").collect()]


def test_days(spark, tmp_path):
    run = make(spark, tmp_path, "days")
    ok = ["SUCCESS"] * 7
    write(spark, tmp_path, [
        article("http://a/1", "t1", "a, b"), article("http://a/2", "t2", "b, c", published="10/12/2023 08:00"),
        article("http://a/3", "t3", "N/A"), article("http://a/1", "t1 new", "a, b", scraped="2024-01-01 07:00:00")],
        "article_010124.csv")
    assert run.run_day("20240101") == ok
    facts, tags, mart = state(spark, run.layers)
    assert facts == {"http://a/1": ("t1 new", 2024, 1), "http://a/2": ("t2", 2023, 12), "http://a/3": ("t3", 2024, 1)}
    assert tags == {("http://a/1", "a"), ("http://a/1", "b"), ("http://a/2", "b"), ("http://a/2", "c")}
    assert len(mart) == 4 and {m[5] for m in mart} == {1}
    content = spark.table(run.layers.fact).first().content
    assert content == "Xin chào ."

    # The same file again: an empty delta, and nothing moves.
    assert run.run_day("20240102") == ok
    assert state(spark, run.layers) == (facts, tags, mart)
    assert ends(run)[4:6] == [("sync_tags", "SUCCESS", 2, 2), ("load_warehouse", "SUCCESS", 3, 3)]
    assert ends(run)[10:14] == [("load_delta", "SUCCESS", 0, 0), ("export_staging_file", "SUCCESS", 0, 0),
                                ("sync_tags", "SUCCESS", 0, 0), ("load_warehouse", "SUCCESS", 0, 0)]

    write(spark, tmp_path, [
        article("http://a/2", "t2 newer", "d", scraped="2024-02-03 07:00:00", published="2024-02-01 05:00:00"),
        article("http://a/4", "t4", "d")], "article_030224.csv")
    assert run.run_day("20240203") == ok
    facts, tags, _ = state(spark, run.layers)
    assert facts["http://a/2"] == ("t2 newer", 2024, 2) and len(facts) == 4
    assert {t for t in tags if t[0] == "http://a/2"} == {("http://a/2", "d")}
    assert spark.table(run.layers.fact).filter("article_year = 2023").isEmpty()


def test_failures_are_logged_and_leave_the_tables(spark, tmp_path):
    run = make(spark, tmp_path, "fails")
    assert run.load_staging() == "FAILED"
    write(spark, tmp_path, [article("http://a/1", "t1", "a")], "article_010124.csv")
    assert run.run_day("20240101") == ["SUCCESS"] * 7
    before = state(spark, run.layers)
    assert run.load_mart("20991231") == "FAILED"
    assert state(spark, run.layers) == before
    assert runlog.open_runs(run.log.rows()).isEmpty()
    assert [e[1] for e in ends(run)].count("FAILED") == 2


def test_busy_while_a_run_is_open(spark, tmp_path):
    run = make(spark, tmp_path, "busy")
    open_id = run.log.start("other")
    assert run.log.start("next") is None
    assert run.load_delta() == "BUSY"
    run.log.end(open_id, runlog.ROWS, 0, 0)
    assert run.load_delta() == "SUCCESS"
    last = {r.run_id: r for r in runlog.run_state(run.log.rows()).collect()}
    assert last[open_id].event == "END" and last[open_id].status == "SUCCESS"


def test_crawl(spark, tmp_path):
    run = make(spark, tmp_path, "crawl")
    config, categories, pages = crawl_tables(spark)
    tables.append_rows(config.limit(0), "crawl_control.config_table")
    tables.append_rows(categories, "crawl_control.crawl_categories")
    assert run.crawl_articles(pages) == "FAILED"
    assert run.log.rows().filter("error LIKE 'There are no jobs%' AND status = 'FAILED'").count() == 1
    tables.append_rows(config, "crawl_control.config_table")
    assert run.crawl_articles(pages, F.lit("010124")) == "SUCCESS"
    assert run.load_staging_day("010124") == "SUCCESS"
    assert run.transform_staging() == "SUCCESS"
    clean = spark.table("crawl_staging.staging_clean_table").orderBy("id").collect()
    assert [(r.id, r.article_url) for r in clean] == [(1, "https://vn/a1"), (2, "https://vn/a1"), (3, "https://vn/a2")]
    jobs = run.log.rows().filter("event = 'END' AND run_id LIKE '%/%'").orderBy("run_id").collect()
    assert [(r.run_id.split("/")[-1], r.config_id, r.status, r.extracted, r.loaded, r.error) for r in jobs] == [
        ("Gone", 1, "FAILED", 0, 0, "Start page not found"), ("Xe", 1, "SUCCESS", 3, 3, "Pages failed: 1"),
        ("Zero", 1, "SUCCESS", 0, 0, "No article found")]


def test_crawl_to_mart(spark, tmp_path):
    """The chain of the README: pages to mart, with a stale file in the folder, an undated article and a config loaded twice."""
    run = make(spark, tmp_path, "chain")
    config, categories, pages = crawl_tables(spark)
    for _ in range(2):
        tables.append_rows(config, "chain_control.config_table")
        tables.append_rows(categories, "chain_control.crawl_categories")
    write(spark, tmp_path, [article("http://stale/1", "old", "a")], "article_300124.csv")
    assert run.crawl_articles(pages, F.lit("310124")) == "SUCCESS"
    assert run.run_day("20240131", crawled=True) == ["SUCCESS"] * 7
    facts, tags, counts = state(spark, run.layers)
    assert facts == {"https://vn/a1": ("First", None, None), "https://vn/a2": (None, None, None)}
    assert tags == {("https://vn/a1", "xe"), ("https://vn/a1", "nhà")} and {m[:2] for m in counts} == {(None, None)}
    # A day without crawled articles takes in nothing.
    assert run.run_day("20240201", crawled=True) == ["SUCCESS"] * 7
    assert state(spark, run.layers) == (facts, tags, counts)


def test_config_and_dates(spark, tmp_path):
    run = make(spark, tmp_path, "setup")
    (tmp_path / "config.csv").write_text("config_id,source_name,base_url,active\n1,VnExpress,https://vn,TRUE\n")
    run.load_config(str(tmp_path / "config.csv"))
    run.load_config(str(tmp_path / "config.csv"))
    assert run.table("setup_control.config_table").count() == 2
    line = "1,2005-01-01,,,Saturday,January,2005,,1" + "," * 10 + "Non-Holiday,Weekend\n"
    (tmp_path / "dates.csv").write_text(line.replace(",,,,,,,,,,Non", ",,,,,,,,,,Non"))
    assert run.import_dates(str(tmp_path / "dates.csv")) == 1
    assert run.table("setup_warehouse.DimDate").first().day_type == "Weekend"


@pytest.mark.parametrize("kind,status,note", [
    ("rows", "SUCCESS", None), ("error", "FAILED", "SQL Error: e"), (None, "FAILED", "Procedure returned None")])
def test_outcome(spark, kind, status, note):
    s, n = runlog.outcome(F.lit(kind).cast("string"), F.lit("e"))
    assert tuple(spark.range(1).select(s, n).first()) == (status, note)
