import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from newsloom.functions import dates, html, nulls, tags, text, urls

SAMPLES = [
    "", " ", "a", "Hi?", "Hi!", "...", "a: -", " .:;,- x -,;:. ", "aBcD đĐ", "íA", "được Anh",
    "a b\x1c c", "　lead ", "tail \x85", "x\ty\nz", "no stop", "has stop.", "ends ,",
    "Giá 1.000,5 đồng", "xem http://a.vn/b?c=1, nhé", "me@mail.example.com ok", "a_b__c", "wait...what?",
    "(một) “hai”", "é́a", "-", ".", "?",
]


TIDY = [
    "", "", "a.", "Hi?", "Hi!", "", "a.", "x.", "aBcD đĐ.", "íA.", "được Anh.",
    "a b c.", "lead.", "tail.", "x y z.", "no stop.", "has stop.", "ends.",
    "Giá 1.000,5 đồng.", "xem http://a.vn/b?c=1, nhé.", "me@mail.example.com ok.", "a_b__c.", "wait...what?",
    "(một) “hai”.", "é́a.", "", "", "?",
]


def test_tidy_sentence(column_of):
    assert column_of(text.tidy_sentence, SAMPLES) == TIDY


def test_trim_and_collapse_like_python(column_of):
    assert column_of(text.trim_spaces, SAMPLES) == [s.strip() for s in SAMPLES]
    assert column_of(text.normalize_spaces, SAMPLES) == [re.sub(r"\s+", " ", s).strip() for s in SAMPLES]


def test_every_unicode_space_is_known(column_of):
    spaces = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    assert column_of(text.trim_spaces, [f"{s}x{s}" for s in spaces]) == ["x"] * len(spaces)
    assert column_of(text.trim_spaces, ["​x", "﻿x"]) == ["​x", "﻿x"]


def test_tidy_sentence_properties(column_of):
    """No edge marks, no double space, a final mark, and the letters in their order."""
    rng = random.Random(7)
    letters = "ab Đđ.:;,-?!\n\t  é"
    samples = ["".join(rng.choice(letters) for _ in range(rng.randrange(12))) for _ in range(500)]
    for raw, tidy in zip(samples, column_of(text.tidy_sentence, samples), strict=True):
        assert [c for c in tidy if c.isalpha()] == [c for c in raw if c.isalpha()]
        if tidy:
            assert tidy[-1] in ".?!" and tidy[0] not in ".:;,-" and not tidy[0].isspace()
            assert not any(x.isspace() and y.isspace() for x, y in zip(tidy, tidy[1:]))
            assert len(tidy) < 2 or tidy[-1] != "." or tidy[-2] not in ".:;,- "


def test_case_boundary(column_of):
    got = column_of(text.split_case_boundary, ["aBcD đĐ", "íA", "ABc", "éÉé", None])
    assert got == ["a Bc D đ Đ", "íA", "ABc", "é Éé", None]


def test_token_spacing(column_of):
    got = column_of(text.space_tokens, [
        "Xin chào, bạn!", "1.000,5 đồng", "xem http://a.vn/b,c nhé.", "a_b", "wait...what?", "ab(c)d",
        "me@mail.example.com.", "", " ", "1.2.3,4", "a1.5", ".5 5. 5.a", "é+x@b.c", "ftp://x y@", "1.5http://x.y"])
    assert got == [
        "Xin chào , bạn !", "1.000,5 đồng", "xem http://a.vn/b,c nhé .", "a b", "wait ... what ?", "ab ( c ) d",
        "me@mail.example.com .", "", "", "1.2.3,4", "a1.5", ". 5 5 . 5 . a", "é + x@b.c", "ftp://x y @",
        "1.5http : / / x . y"]


def test_quotes(column_of):
    assert column_of(text.straighten_quotes, ["“a” ‘b’", "a"]) == ["\"a\" 'b'", "a"]


def test_article_key_is_crc32(column_of):
    samples = ["", "http://a/1", "https://vnexpress.example/đường-phố"]
    assert column_of(urls.article_key, samples) == [zlib.crc32(s.encode()) & 0xFFFFFFFF for s in samples]


@pytest.mark.parametrize("url,want", [
    ("http://x/p", "http://x/p"), ("https://x", "https://x"), ("//h/p", "https://h/p"),
    ("/p", "https://base/p"), ("p", "https://base/p"), ("httpx", "httpx"), ("", "https://base/"),
])
def test_normalize_url(column_of, url, want):
    assert column_of(lambda c: urls.normalize_url(c, F.lit("https://base")), [url]) == [want]


def test_row_mark_tells_nulls_apart(spark):
    rows = spark.createDataFrame([(1, None, "a"), (2, "a", None), (3, "a", ""), (4, "a", None)], "i int, x string, y string")
    marks = [r.m for r in rows.orderBy("i").select(urls.row_mark("x", "y").alias("m")).collect()]
    assert len(set(marks)) == 3 and marks[1] == marks[3]


def test_null_tokens(spark):
    rows = spark.createDataFrame(
        [("N/A", 1.0), ("null", float("nan")), ("", None), ("x", 2.0), ("n/A", 0.0)], "s string, d double")
    assert [tuple(r) for r in nulls.tokens_to_null(rows).collect()] == [
        (None, 1.0), (None, None), (None, None), ("x", 2.0), ("n/A", 0.0)]
    assert [r.s for r in nulls.blank_for_null(nulls.tokens_to_null(rows)).collect()] == ["", "", "", "x", "n/A"]


def test_split_tags(column_of):
    assert column_of(tags.split_tags, ["a,b", " a , b,", "", "one"]) == [["a", "b"], ["a", "b", ""], [""], ["one"]]


def test_parse_time(column_of):
    got = column_of(lambda c: dates.time_text(dates.parse_time(c)), [
        "2024-01-31 05:06:07", "31/01/2024 05:06", "31/01/2024", "2024-01-31", "N/A", None, "2024-13-01 00:00:00",
        "2024-01-31 05:06:07.123456"])
    assert got == ["2024-01-31 05:06:07", "2024-01-31 05:06:00", "2024-01-31 00:00:00", "2024-01-31 00:00:00",
                   None, None, None, "2024-01-31 05:06:07"]


def test_published_dates_of_news_pages(column_of):
    got = column_of(lambda c: dates.time_text(dates.parse_published(c)), [
        "Thứ hai, 1/1/2024, 10:00 (GMT+7)", "01/01/2024 10:00 GMT+7", "1/1/2024 10:00", "Thứ 2, 01/01/2024",
        "2024-01-01T10:00:00+07:00", "2024-01-01T10:00:00Z", "2024-01-31", "31-1-2024", "bad date", None,
        "1/1/2024 10:00 GMT-3:30"])
    assert got == ["2024-01-01 03:00:00", "2024-01-01 03:00:00", "2024-01-01 10:00:00", "2024-01-01 00:00:00",
                   "2024-01-01 03:00:00", "2024-01-01 10:00:00", "2024-01-31 00:00:00", "2024-01-31 00:00:00", None, None,
                   "2024-01-01 13:30:00"]


def test_numeric_references_of_any_length(column_of):
    got = column_of(html.decode_entities, [
        "&#00000065;x", "&#x0000041;", "&#99999999;", "&#x110000;y", "&#0;", "&#000000000000000000000066", "&#65x", "&#;"])
    assert got == ["Ax", "A", "\ufffd", "\ufffdy", "\ufffd", "B", "Ax", "&#;"]


def test_clean_content_cases(column_of):
    got = column_of(html.clean_content, [
        None, "", "   ", "<p>...</p>", "<p>Hi?</p>", "<p>a: -</p>",
        "x Video Player ..\n.. End of dialog window y",
        "a<script>var x='<p>no</p>'</script>b<style>c{}</style><!-- d --> e",
        "<button>Play</button><iframe src='x'>in</iframe>text<link rel='x'><meta charset=u>",
        "<p title='a > b'>chữ</p>", "Việt NamĐất nước", "a &lt;b&gt; &amp;amp; c", "unclosed <script>var a = 1",
    ])
    assert got == [
        "", "", "", "", "Hi ?", "a .", "x y .", "a b e .", "text .", "chữ .", "Việt Nam Đất nước .", "a < b > & amp ; c .", "unclosed ."]
