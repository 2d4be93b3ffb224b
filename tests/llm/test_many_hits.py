"""Texts with very many secrets or backslashes, and columns named like inner ones."""

import re
import time

import pytest

from newsloom.llm import chat_format, license_scan, secret_scan, url_filter
from newsloom.llm.queries import URL_RULES

HEX = re.compile("[0-9a-f]{24,}")


def hits(n, gap="é text "):
    return "".join(f"{gap}{i:024x}" for i in range(n)) + " end"


@pytest.mark.parametrize("n", [1, 255, 256, 257, 700])
def test_spans_across_stretches(spark, n):
    text = hits(n)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = secret_scan.findings(df, secret_scan.scan(df)).collect()[0]["spans"]
    assert [(s["kind"], s["start"], s["end"]) for s in spans] == [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    assert secret_scan.redact(df).collect()[0]["text"] == HEX.sub("[hex]", text)


def test_overlaps_across_stretches(spark):
    # An assignment's value is a hex run, too: spans overlap, and the two kinds end at different places.
    text = "".join(f"token={i:024x}/tail{i} " for i in range(400))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    want = re.sub(r"token=[^ ]+", "[assign]", text)
    assert secret_scan.redact(df).collect()[0]["text"] == want


def test_many_hits_take_no_square_of_time(spark):
    def seconds(n):
        df = spark.createDataFrame([(1, hits(n))], "doc_id long, text string")
        began = time.time()
        assert secret_scan.redact(df).collect()[0]["text"].count("[hex]") == n
        return time.time() - began

    seconds(100)
    few, many = seconds(4_000), seconds(32_000)
    assert many < 24 * max(few, 0.5)


def test_findings_replace_columns_of_their_names(spark):
    df = spark.createDataFrame([(1, "token=abcdefgh", "b", "s")], "doc_id long, text string, Blob string, spans string")
    got = secret_scan.findings(df, secret_scan.scan(df))
    assert got.columns == ["blob", "doc_id", "spans"]
    assert got.collect()[0]["spans"][0]["kind"] == "assign"


def test_long_runs_of_backslashes():
    text = "\\" * 300_000 + "x" + "\\" * 200_000 + "</turn>" + "\\" * 5
    began = time.time()
    told = chat_format.escape(text)
    assert chat_format.unescape(told) == text
    assert told == "\\" * 300_000 + "x" + "\\" * 400_001 + "</turn>" + "\\" * 5
    assert time.time() - began < 5


@pytest.mark.parametrize("max_rules", [100, 0])
def test_url_columns_of_inner_names_stay(spark, max_rules):
    schema = "url string, _match int, _labels int, _parts int, _row int, kept_row int, found int, rule string"
    df = spark.createDataFrame([("http://a.example.net/en/", 1, 2, 3, 4, 5, 6, "old")], schema)
    row = url_filter.judge(df, URL_RULES, max_rules=max_rules).collect()[0]
    assert [row[c] for c in ("_match", "_labels", "_parts", "_row", "kept_row", "found")] == [1, 2, 3, 4, 5, 6]
    assert (row["rule"], row["verdict"]) == ("example.net/en/", "allow")


def test_license_columns_of_inner_names_stay(spark):
    schema = "path string, text string, key int, row int, dir int, n_terms int, lines int, license string"
    df = spark.createDataFrame([("a/b", "Released under the MIT License.", 1, 2, 3, 4, 5, "old"),
                                ("a/c", None, 1, 2, 3, 4, 5, None)], schema)
    for row in license_scan.scan(df).collect():
        assert [row[c] for c in ("key", "row", "dir", "n_terms", "lines")] == [1, 2, 3, 4, 5]
        assert row["license"] == "MIT"


def test_texts_without_findings_are_not_moved(spark):
    texts = ["nothing here", "token=abcdef12", None, "token=abcdef12", "AKIA" + "A" * 20 + " and more"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    done = secret_scan.redact(docs)
    assert "LeftAnti, BuildRight" in done._jdf.queryExecution().executedPlan().toString()
    assert {r["doc_id"]: r["text"] for r in done.collect()} == {
        0: "nothing here", 1: "[assign]", 2: None, 3: "[assign]", 4: "[access] and more"}
