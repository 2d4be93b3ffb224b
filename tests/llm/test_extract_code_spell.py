"""HTML extraction, vector codes and spelling variants against written-out and brute-force results."""

import hashlib
import html as html_std
import os
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import ball_codes, html_extraction, spelling
from newsloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

# --- HTML extraction ----------------------------------------------------------------------------

LONG = "A sentence of the article that is long enough to be told from a menu or a notice. " * 2
PAGES = {
    "null": (None, ""),
    "empty": ("", ""),
    "no text": ("<html><head><title>t</title></head><body><script>x</script></body></html>", ""),
    "bare text": ("one  two\n three", "one two three"),
    "short article": ("<nav>Menu</nav><article><p>Yes.</p></article><footer>Foot</footer>", "Yes."),
    "unclosed": ("<article><h1>T &amp; U</h1><p><b>one<br>two<p>three<ul><li>a<li>b</ul></article><footer>f",
                 "T & U\none two\nthree\na\nb"),
    "inline": ("<article><p>a<b>b</b>c <a href='x'>d</a> &lt;e&gt; &#233;&nbsp;f &amp g</p></article>", "abc d <e> é f & g"),
    "beside": ("<header><h1>Site</h1></header><main><nav>Path</nav><h1>Head</h1><article><p>Text</p><div class='ad'>Buy</div>"
               "<aside>Side</aside><form>Mail<input></form><p>More</p></article><div>Other</div></main>", "Head\nText\nMore"),
    "own header": ("<article><header><h1>Head</h1><p>By me</p></header><p>Text</p><footer>Tags</footer></article>",
                   "Head\nBy me\nText"),
    "comments": ("<article><p>Text</p><section id='comments'><article><p>Nice one</p></article></section></article>"
                 "<article class='comment'><p>First</p></article>", "Text"),
    "commented out": ("<article><!-- <p>no</p> --><p>yes</p><script>var s = '</article>';</script><p>also</p></article>", "yes\nalso"),
    "around all": ("<form id='aspnet'><div class='menu'>M</div><div class='ad-free'><article><p>In</p></article></div></form>", "In"),
    "hidden": ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", "yes"),
    "no marks": (f"<body class='has-sidebar'><div><a href=a>Home</a> <a href=b>News</a></div><div><h2>Title</h2><p>{LONG}</p><p>Short.</p>"
                 f"<p>{LONG}</p></div><div class='cookie-banner'>{LONG}</div><hr><hr><hr><p>(c) 2020</p></body>",
                 f"Title\n{LONG.strip()}\nShort.\n{LONG.strip()}"),
    "quoted": ("<article><p title='a > b' data-x=\"</article>\">one</p><p x='y>two</p></article>", "one\ntwo"),
    "cut off": ("<article><p>one</p><p cla", "one"),
    "cells": ("<main><table><tr><td>a<td>b<tr><th>c</table></main>", "a\nb\nc"),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text_of_odd_pages(name):
    page, expected = PAGES[name]
    assert html_extraction.main_text(page) == expected


def test_kept_lines_begin_at_surges_and_end_at_dives():
    assert list(html_extraction.kept_lines([])) == []
    assert list(html_extraction.kept_lines([0, 0, 0])) == []
    assert list(html_extraction.kept_lines([0, 5, 0, 0, 0, 0, 90, 0, 3, 0, 0, 0, 4])) == [(6, 9)]
    assert list(html_extraction.kept_lines([3, 0, 0, 0, 4], surge=1)) == [(0, 1), (4, 5)]
    assert list(html_extraction.kept_lines([2, 0, 0, 0, 4])) == [(4, 5)]


def test_reading_time_is_linear():
    began = time.time()
    for bomb in ("<a ", '<a x="', "<div>", "<b>", "<p><i>", "</i>", "<!--", "<script>", "<b><p>", "<div><b></i>"):
        html_extraction.main_text(bomb * 20_000 + "<hr>" * 20_000)
    assert time.time() - began < 20


def test_extract_keeps_rows_and_columns(spark):
    rows = [(i, page, "old", 5, "u") for i, (page, _) in enumerate(PAGES.values())] + [(None, "<p>x", None, None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, N_chars int, url string")
    done = html_extraction.extract(pages)
    assert done.columns == ["page_id", "html", "url", "text", "n_chars"]
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in done.collect()), key=repr)
    texts = [t for _, t in PAGES.values()]
    assert got == sorted([*((i, t, len(t)) for i, t in enumerate(texts)), (None, "x", 1), (None, "x", 1)], key=repr)
    assert html_extraction.extract(pages.limit(0)).count() == 0


@needs_tables
def test_extraction_query(spark):
    def article(page):
        blocks = re.split("</?(?:h1|p)>", re.search("<article>(.*?)</article>", page, re.S)[1])
        texts = [" ".join(html_std.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
        return "\n".join(t for t in texts if t)

    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in QUERIES["op11_html_extraction"](spark, SF_DIR).collect()}
    assert got == {r["page_id"]: (r["url"], article(r["html"]), len(article(r["html"]))) for r in pages}


# --- vector codes -------------------------------------------------------------------------------

def brute_codes(rows, parts, entries, rounds, scale=256):
    """Rows of (id, vector, label) by the definition."""
    import math

    def fine(v):
        return v and all(x is not None and math.isfinite(x) for x in v)

    kept = sorted(((i is None, i or 0, [math.floor(scale * x) for x in v], i, label) for i, v, label in rows if fine(v)),
                  key=lambda r: r[:3])
    width = len(kept[0][2]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, _, v, _, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = [[] for _ in books[p]]
            for c in cut:
                groups[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(x) // len(g) for x in zip(*g)] if g else e for g, e in zip(groups, books[p])]
    result = []
    for c, (_, _, _, i, label) in zip(cut, kept):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        result.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
    errors = Counter()
    for _, _, error, label in result:
        errors[label] += error
    flat = ",".join(str(x) for book in books for e in book for x in e)
    return sorted([(i, code, error, errors[label]) for i, code, error, label in result], key=repr), hashlib.sha256(
        flat.encode()).hexdigest()


def coded(spark, rows, schema="vec_id long, embedding array<float>, label int", **kinds):
    vectors = spark.createDataFrame(rows, schema).repartition(3)
    done, books = ball_codes.encode(vectors, "vec_id", "embedding", "label", **kinds)
    found = ball_codes.with_label_errors(done).select("id", ball_codes.code_text().alias("code"), "error", "label_error").collect()
    return sorted((tuple(r) for r in found), key=repr), ball_codes.books_sha256(books)


def odd_vectors(n=300, width=8, seed=5):
    rng = random.Random(seed)
    centers = [[rng.uniform(-2, 2) for _ in range(width)] for _ in range(6)]
    rows = []
    for i in range(n):
        near = rng.choice(centers)
        rows.append((i * 7 % 311, [float(np.float32(x + rng.gauss(0, 0.2))) for x in near], rng.choice([0, 1, 2, None])))
    rows += [rows[0], rows[0], (5, [0.0] * width, 1), (5, [0.0] * width, 1), (None, [-0.001] * width, None), (None, [0.5] * width, 9)]
    rows += [(1, None, 1), (2, [], 1), (3, [1.0] * (width - 1) + [None], 1), (4, [float("nan")] * width, 1),
             (6, [float("inf")] + [0.0] * (width - 1), 1), (7, [float("-inf")] * width, None)]
    return rows


@pytest.mark.parametrize("kinds", [dict(parts=4, entries=16, rounds=2), dict(parts=8, entries=5, rounds=3), dict(parts=2, entries=256, rounds=1)])
def test_codes_equal_brute_force(spark, kinds):
    rows = odd_vectors()
    assert coded(spark, rows, **kinds) == brute_codes(rows, **kinds)


def test_codes_of_few_equal_and_no_vectors(spark):
    equal = [(i, [0.25, -0.25, 1.0, -7.5], i % 2) for i in range(20)]
    assert coded(spark, equal, parts=2, entries=8) == brute_codes(equal, 2, 8, 2)
    one = [(3, [1.5, -2.25], None)]
    assert coded(spark, one, parts=2) == brute_codes(one, 2, 64, 2)
    assert coded(spark, [(1, None, 1)])[0] == []
    assert coded(spark, [])[0] == []


def test_codes_with_clashing_columns_and_doubles(spark):
    rows = [(float(i), "c", 1, 2, [i / 3, -i / 7], "x") for i in range(30)]
    schema = "error double, code string, part int, n int, vector array<double>, label string"
    vectors = spark.createDataFrame(rows, schema)
    done, _ = ball_codes.encode(vectors, "error", "vector", "label", parts=1, entries=4)
    expected, _ = brute_codes([(r[0], r[4], r[5]) for r in rows], 1, 4, 2)
    assert sorted((r["id"], r["code"].hex(), r["error"]) for r in done.collect()) == [r[:3] for r in sorted(expected)]


def test_codes_refuse_what_they_cannot_hold(spark):
    with pytest.raises(Exception, match="2 components expected|one length"):
        coded(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0, 3.0, 4.0], 1)], parts=2, entries=1)
    with pytest.raises(Exception, match="must be below"):
        coded(spark, [(1, [1.0, 2.0], 1), (2, [1e30, 0.0], 1)], parts=2, entries=1)


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_balls_find_the_nearest_entry(data):
    width = data.draw(st.integers(1, 3))
    point = st.lists(st.integers(-6, 6), min_size=width, max_size=width)
    entries = data.draw(st.lists(point, min_size=1, max_size=12))
    points = data.draw(st.lists(point, min_size=1, max_size=30))
    prior = data.draw(st.lists(st.integers(0, len(entries) - 1), min_size=len(points), max_size=len(points)))
    nearest, distance = ball_codes.nearest_in_balls(np.array(points), np.array(prior), np.array(entries))
    expected = [min((sum((a - b) ** 2 for a, b in zip(p, e)), i) for i, e in enumerate(entries)) for p in points]
    assert list(zip(distance.tolist(), nearest.tolist())) == expected


# --- spelling variants --------------------------------------------------------------------------

def brute_spelling(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    form, n_near = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        n_near[w] = len(others)
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    result = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        result.append((w, form[w], root, n, n_near[w], words.get(form[w])))
    return sorted(result, key=repr)


def grouped(spark, rows, **kinds):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted((tuple(r) for r in spelling.group_variants(docs, **kinds).collect()), key=repr)


def variant_rows(seed=3):
    rng = random.Random(seed)
    bases = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(5, 9))) for _ in range(25)]
    rows = []
    for i in range(400):
        said = []
        for base in rng.choices(bases, k=6):
            word = list(base)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                kind, at = rng.randrange(3), rng.randrange(len(word))
                if kind == 0:
                    del word[at]
                else:
                    word[at:at + (kind == 1)] = rng.choice("abÀ")
            said.append("".join(word).upper() if rng.random() < 0.1 else "".join(word))
        rows.append((i, " ".join(said)))
    rows += [(12, "qqqqq " * 3 + "qqqqw " * 7 + "qqqqwe " * 20), (None, "hello hello Hello jello jello jello jello jello jello"), (7, None), (8, ""), (9, "a bb ccc 12345 ×÷×÷×"),
             (9, "×÷×÷× ×÷×÷×"), rows[0], rows[0], (10, "z" * 3000 + " " + "z" * 3000), (11, "z" * 3000 + " " + "z" * 2999)]
    return rows


def test_spelling_equals_brute_force(spark):
    rows = variant_rows()
    expected = brute_spelling(rows)
    assert any(r[2] not in (r[0], r[1]) for r in expected), "no form of a form in the data"
    assert grouped(spark, rows) == expected
    assert grouped(spark, rows, symbols=2) == expected


def test_spelling_of_runs_without_words(spark):
    assert grouped(spark, []) == []
    assert grouped(spark, [(1, None), (2, ""), (None, "abcde abcde")]) == []


def test_slips_take_the_letter_that_the_hash_names(spark):
    rows = [(i, f"word{chr(97 + i % 26)}ing") for i in range(3000)] * 3
    assert grouped(spark, rows) == brute_spelling(rows)


def test_spelling_takes_any_other_columns(spark):
    docs = spark.createDataFrame([(1, "abcde abcde abcde", 5, "x", "y")] * 2, "doc_id int, text string, n int, word string, run string")
    assert [tuple(r) for r in spelling.group_variants(docs).collect()] == [("abcde", None, "abcde", 6, 0, None)]


@settings(max_examples=60, deadline=None)
@given(st.text("abc", min_size=1, max_size=5))
def test_neighbourhood_is_whole(word):
    """The strings that the operator generates are those at one edit or none."""
    letters = "abc"
    by_hand = {word} | {word[:i] + word[i + 1:] for i in range(len(word))}
    by_hand |= {word[:i] + s + word[i + 1:] for i in range(len(word)) for s in letters}
    by_hand |= {word[:i] + s + word[i:] for i in range(len(word) + 1) for s in letters}
    WORDS[word] = by_hand


WORDS: dict[str, set[str]] = {}


def test_neighbourhood_column(spark):
    from pyspark.sql import functions as F
    test_neighbourhood_is_whole()
    rows = spark.createDataFrame([(w,) for w in WORDS], "word string").select("word", spelling.neighbourhood(F.col("word"), 3).alias("n"))
    for r in rows.collect():
        assert len(r["n"]) == len(set(r["n"])) and set(r["n"]) == WORDS[r["word"]]
