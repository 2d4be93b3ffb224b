"""Components of links against union-find, and how much the driver is asked to do for few links."""

import random
import uuid

import pytest

from newsloom.llm import components as c
from newsloom.llm import minhash_dedup


def _brute(links):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a != b:
            low, high = sorted((root(a), root(b)))
            up[high] = low
    return {x: root(x) for x in up}


def _some_links():
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(1000, 1040)]
    star = [(2000, i) for i in range(2001, 2040)]
    return chain + star + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7), (3000, 3000)] + chain[:3]


@pytest.mark.parametrize("few", [0, c.FEW_LINKS])
def test_components_on_both_ways(spark, monkeypatch, few):
    monkeypatch.setattr(c, "FEW_LINKS", few)
    links = _some_links()
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    found = [tuple(row) for row in c.components(spark.createDataFrame(links, "a long, b long")).collect()]
    assert len(found) == len(set(found)) and dict(found) == _brute(links)
    assert (spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")) == before
    assert c.components(spark.createDataFrame([], "a long, b long")).collect() == []


def _jobs(spark, work):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        work()
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_few_links_take_few_jobs(spark):
    links = spark.createDataFrame([(1, i) for i in range(2, 50)], "a long, b long")
    assert _jobs(spark, lambda: c.components(links)) <= 12  # one for each turn and each look at it; one for each exchange before


def test_near_duplicates_take_few_jobs(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(120)) for _ in range(30)]
    near = [text.rsplit(" ", 1)[0] + " other" for text in texts[:12]]
    # Of like size and many words in common, yet apart.
    far = [" ".join(texts[0].split()[:90] + [f"x{i}y{j}" for j in range(30)]) for i in range(8)]
    rows = list(enumerate(texts + near + far))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {}
    jobs = _jobs(spark, lambda: out.update((r.id, r.component_id) for r in minhash_dedup.near_duplicates(docs).collect()))
    assert all(out[30 + i] == i for i in range(12))
    assert all(out[i] == i for i in range(30)) and all(out[42 + i] == 42 + i for i in range(8))
    assert jobs <= 150
