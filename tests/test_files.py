import datetime
import os
import time

import pytest
from pyspark.sql import functions as F

from newsloom.operators import date_dim, staging
from newsloom.schemas import ARTICLE_CSV, DELTA_COLUMNS
from newsloom.sources import csv_files, newest
from newsloom.streaming import article_files


def write(path, content, bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as f:
        f.write(content)
    return str(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_article_file(spark, tmp_path, end):
    path = write(tmp_path / "article_010124.csv", end.join([
        "article_url,title_raw,content_raw,source_name_raw,run_id",
        'u1,"a ""q"", b","l1\nl2",N/A,old', "u2,,x,s,old", ""]), bom=True)
    rows = staging.stage_rows(csv_files.read_articles(spark, path), "new").orderBy("article_url").collect()
    assert [(r.article_url, r.title, r.content, r.source_name, r.run_id, r.tags) for r in rows] == [
        ("u1", 'a "q", b', "l1\nl2", "N/A", "new", ""), ("u2", "", "x", "s", "new", "")]


def test_empty_article_file(spark, tmp_path):
    path = write(tmp_path / "empty.csv", ",".join(ARTICLE_CSV) + "\n")
    assert csv_files.read_articles(spark, path).isEmpty()


def test_delta_round_trip(spark, tmp_path):
    cells = ["first\r\ncell\r", "N/A", "", None, 'l1\nl2 "q", x', " spaced ", "\\", '"', "null", "#x", "a,b", "'"]
    rows = [tuple([f"u{i}", c] + ["x"] * 9) for i, c in enumerate(cells)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in DELTA_COLUMNS))
    path = str(tmp_path / "delta")
    csv_files.write_delta(df.select(*reversed(DELTA_COLUMNS)), path)
    back = csv_files.read_delta(spark, path)
    assert back.columns == DELTA_COLUMNS
    got = {r.article_url: r.source_name for r in back.collect()}
    assert got == {f"u{i}": None if c in ("N/A", "", "null", None) else c for i, c in enumerate(cells)}


def test_delta_bytes(spark, tmp_path):
    row = ["u1", 'l1\nl2 "q", x', None, "N/A"] + [""] * 7
    df = spark.createDataFrame([tuple(row)], ", ".join(f"{c} string" for c in DELTA_COLUMNS)).coalesce(1)
    csv_files.write_delta(df, str(tmp_path / "delta"))
    part = next(p for p in (tmp_path / "delta").iterdir() if p.name.startswith("part"))
    assert part.read_text() == 'u1,"l1\nl2 ""q"", x",,N/A' + "," * 7 + "\n"


def test_mart_file_keeps_tokens_and_drops_nameless_columns(spark, tmp_path):
    path = write(tmp_path / "dim.csv", "Unnamed: 0, tag_key ,tag_name,NaN\n0,1,N/A,x\n1,2,,y\n")
    got = csv_files.read_mart_file(spark, path)
    assert got.columns == ["tag_key", "tag_name"]
    assert sorted(map(tuple, got.collect())) == [("1", "N/A"), ("2", "")]


def test_config_file(spark, tmp_path):
    path = write(tmp_path / "config.csv", "config_id,source_name,active\n1,A,TRUE\n2,N/A,FALSE\n")
    day = datetime.date(2024, 1, 2)
    got = csv_files.read_config(spark, path, F.lit("2024-01-02")).orderBy("config_id").collect()
    assert [tuple(r) for r in got] == [(1, "A", True, day), (2, None, False, day)]
    dated = write(tmp_path / "dated.csv", "config_id,date_dim\n1,2023-05-06\n")
    assert csv_files.read_config(spark, dated).first().date_dim == datetime.date(2023, 5, 6)


def test_date_file(spark, tmp_path):
    wide = ["1", "2005-01-01", "x", "x", "Saturday", "January", "2005", "x", "1"] + ["x"] * 9 + ["Non-Holiday", "Weekend", "more"]
    path = write(tmp_path / "dates.csv", ",".join(wide) + "\n")
    from_file = date_dim.from_wide_rows(csv_files.read_wide_dates(spark, path)).collect()
    bounds = spark.sql("SELECT date'2005-01-01' AS first_day, date'2005-01-03' AS last_day")
    made = date_dim.calendar(bounds).orderBy("date_key")
    assert tuple(made.first()) == tuple(from_file[0]) == (
        1, datetime.date(2005, 1, 1), "Saturday", "January", 2005, 1, "Non-Holiday", "Weekend")
    assert [r.day_type for r in made.collect()] == ["Weekend", "Weekend", "Weekday"]
    holidays = spark.sql("SELECT date'2005-01-03' AS full_date, 'Tết' AS holiday")
    assert [r.holiday for r in date_dim.calendar(bounds, holidays).orderBy("date_key").collect()] == [
        "Non-Holiday", "Non-Holiday", "Tết"]
    with pytest.raises(ValueError):
        csv_files.read_wide_dates(spark, write(tmp_path / "narrow.csv", "1,2\n"))


def test_newest_file(spark, tmp_path):
    now = time.time()
    for name, age in [("article_1.csv", 30), ("article_2.csv", 10), ("other.csv", 0), ("article_3.csv", 20)]:
        write(tmp_path / name, "a\n")
        os.utime(tmp_path / name, (now - age, now - age))
    assert newest.newest_path(spark, str(tmp_path), "article_*.csv") == f"{tmp_path}/article_2.csv"
    folder = tmp_path / "article_4.csv"
    spark.range(10).write.csv(str(folder))
    assert newest.newest_path(spark, str(tmp_path), "article_*.csv") == str(folder)
    assert newest.newest_path(spark, f"file://{tmp_path}/", "article_*.csv") == f"file://{folder}"


def test_stream_takes_each_file_once(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS stream_test")
    def articles(name, *urls):
        write(tmp_path / name, ",".join(ARTICLE_CSV) + "\n" + "".join(f"{u}{',x' * 9},r\n" for u in urls))
    def run(run_id):
        article_files.stage_new_files(spark, str(tmp_path), "article_*.csv", "stream_test.staged",
                                      str(tmp_path / "progress"), run_id)
    articles("article_1.csv", "a", "b")
    run("r1")
    run("r2")
    articles("article_2.csv", "c")
    run("r3")
    got = sorted((r.article_url, r.run_id) for r in spark.table("stream_test.staged").collect())
    assert got == [("a", "r1"), ("b", "r1"), ("c", "r3")]
