"""Decontamination, licences and the pipeline against brute force."""

import math
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsloom.llm import decontamination, license_scan
from newsloom.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.test_operators import SF_DIR, frame, needs_tables, odd_documents, prose


def brute_leaks(docs, items, similarity=0.8):
    found = set()
    for item_id, text in items:
        sought = brute.WORD.findall((text or "").lower())
        size = min(5, len(sought))
        if not size:
            continue
        want = Counter(tuple(sought[i:i + size]) for i in range(len(sought) - size + 1))
        for d in docs:
            words = brute.WORD.findall((d["text"] or "").lower())
            if not want.keys() & {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}:
                continue
            n = min(len(words), len(sought))
            for s in range(len(words) - n + 1):
                own = words[s:s + n]
                has = Counter(tuple(own[i:i + size]) for i in range(len(own) - size + 1))
                both = (want & has).total()
                if both and both >= similarity * (want | has).total():
                    found.add((d["doc_id"], item_id))
    return found


def test_leaks(spark):
    text = prose(90, 40)
    changed = list(text)
    changed[38] = "other"
    items = [(1, " ".join(text)), (2, "Three little words"), (3, None), (4, ""), (5, " ".join(prose(91, 30))), (1, " ".join(text))]
    docs = odd_documents()[:20] + [
        {"doc_id": 900, "text": " ".join(prose(92, 60) + text + prose(93, 50)), "source": "s"},
        {"doc_id": 901, "text": " ".join(prose(94, 10) + changed), "source": "s"},
        {"doc_id": 902, "text": " ".join(text).upper(), "source": "s"},
        {"doc_id": 903, "text": " ".join(text[:20]), "source": "s"},
        {"doc_id": 904, "text": "has three little words in it", "source": "s"},
        {"doc_id": 905, "text": None, "source": None}, {"doc_id": 906, "text": "", "source": "s"}]
    table = spark.createDataFrame(items, "item_id long, text string")
    df = frame(spark, docs + docs[-7:])
    got = decontamination.leaks(df, table)
    assert {(r["id"], r["item_id"]) for r in got.collect()} == brute_leaks(docs, items)
    clean = decontamination.without_leaks(df, table)
    assert clean.columns == df.columns
    leaked = {i for i, _ in brute_leaks(docs, items)}
    assert {r["doc_id"] for r in clean.collect()} == {d["doc_id"] for d in docs} - leaked
    assert decontamination.leaks(frame(spark, []), table).count() == 0


def test_items_with_null_and_shared_ids_are_found(spark):
    """24 texts under six ids, one of them null, and a verbatim copy of each."""
    texts = [" ".join(prose(200 + i, 40)) for i in range(24)]
    items = [(None if i % 6 == 5 else i % 6, t) for i, t in enumerate(texts)]
    docs = [{"doc_id": i, "text": " ".join(prose(300 + i, 30)) + " " + t + " " + " ".join(prose(400 + i, 30)), "source": "s"}
            for i, t in enumerate(texts)] + [{"doc_id": 99, "text": " ".join(prose(500, 90)), "source": "s"}]
    table = spark.createDataFrame(items + items[:3], "item_id long, text string")
    got = decontamination.leaks(frame(spark, docs), table).collect()
    assert {(r["id"], r["item_id"]) for r in got} == {(i, item_id) for i, (item_id, _) in enumerate(items)}
    assert all(r["similarity"] == 1.0 and r["distance"] == 0 and r["start"] == 30 for r in got)
    assert [r["doc_id"] for r in decontamination.without_leaks(frame(spark, docs), table).collect()] == [99]


def test_hamming_join_finds_all_pairs_within_the_radius(spark):
    import random
    rng = random.Random(4)
    items = [(i, rng.getrandbits(64)) for i in range(20)]
    windows = [(100 + i, items[i % 20][1] ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 40)))) for i in range(300)]

    def signed(rows):
        return [(i, f - 2**64 if f >= 2**63 else f, 1) for i, f in rows]

    got = decontamination.hamming_join(spark.createDataFrame(signed(windows), "w long, fingerprint long, k int"),
                                       spark.createDataFrame(signed(items), "i long, fingerprint long, k int"), ["k"])
    pairs = sorted((r["w"], r["i"], r["distance"]) for r in got.collect())
    assert pairs == sorted((w, i, (f ^ g).bit_count()) for w, f in windows for i, g in items
                           if (f ^ g).bit_count() <= decontamination.RADIUS)


@needs_tables
def test_leaks_query(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = QUERIES["op2_decontamination"](spark, SF_DIR)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == brute_leaks(docs, items)


@needs_tables
def test_leaks_of_tables(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    got = decontamination.leaks(spark.read.parquet(f"{SF_DIR}/documents.parquet"), bench)
    assert {(r["id"], r["item_id"]) for r in got.collect()} == brute_leaks(docs, [(r["item_id"], r["text"]) for r in bench.collect()])


def test_licenses(spark):
    texts = {"a/LICENSE": "Released under the MIT License.", "a/b/x.txt": "no licence here", "a/b/c/y.txt": None,
             "a/b/z.txt": "code\nlicensed under the Apache License, version 2.0\nmore code " + "w " * 50, "top.txt": "nothing",
             "q/r.txt": "", None: "All rights reserved."}
    rows = [(i, p, t, "k") for i, (p, t) in enumerate(texts.items())]
    df = spark.createDataFrame(rows * 2, "doc_id long, path string, text string, key string")
    got = {r["path"]: (r["license"], r["origin"], r["from_dir"]) for r in license_scan.scan(df).collect()}
    # The file at the top speaks for all that have no nearer one.
    assert got == {
        "a/LICENSE": ("MIT", "file", None), "a/b/x.txt": ("MIT", "inherited", "a"), "a/b/c/y.txt": ("MIT", "inherited", "a"),
        "a/b/z.txt": ("Apache-2.0", "header", None), "top.txt": ("all-rights-reserved", "inherited", ""),
        "q/r.txt": ("all-rights-reserved", "inherited", ""), None: ("all-rights-reserved", "file", None)}
    assert license_scan.scan(df.limit(0)).count() == 0


@needs_tables
def test_license_scores_of_tables(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    words = {d["doc_id"]: set(re.findall("[a-z0-9]+", (d["text"] or "").lower())) for d in docs}
    vocabulary = {t for text in license_scan.TEMPLATES.values() for t in license_scan.terms(text)}
    weight = license_scan.weights(len(docs), {t: sum(t in w for w in words.values()) for t in vocabulary}, sorted(vocabulary))
    vectors = license_scan.vectors(license_scan.TEMPLATES, weight)
    want = set()
    for d in docs:
        for line in (d["text"] or "").split("\n"):
            own = {t: n * weight.get(t, weight[""]) for t, n in Counter(license_scan.terms(line)).items()}
            length = math.sqrt(sum(x * x for x in own.values()))
            if length and any(sum(own.get(t, 0) * x for t, x in v.items()) / length >= 0.8 for v in vectors.values()):
                want.add(d["doc_id"])
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("path", F.concat(F.lit("d/"), "doc_id"))
    got = license_scan.scan(df).filter("score IS NOT NULL").collect()
    assert want and {r["doc_id"] for r in got} == want


@needs_tables
def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, ids = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = [r.asDict() for r in docs.collect()]
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        ids.append({r["doc_id"] for r in docs.collect()})
        if i < 4:
            assert docs.columns == columns
        if i == 0:
            assert ids[0] <= {d["doc_id"] for d in before if not brute.quality(d)[-1]}
        if i == 1:
            assert ids[1] == {r[0] for r in brute.near(before, corpus_pipeline.NEAR_PERCENT) if r[3]}
        if i == 3:
            assert not any(brute.secrets(r.asDict())[1:4] != (0, 0, 0) for r in docs.collect())
    assert os.path.isdir(f"{tmp_path}/4") and ids[3] == ids[2] and ids[4] <= ids[3]
