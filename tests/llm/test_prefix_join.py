"""The prefix filter against all pairs."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.llm import prefix_join
from newsloom.session import setting


def jaccard(a, b):
    return len(a & b) / len(a | b)


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_alike_sets_share_a_key(data):
    """Whatever the order: every pair at or above the similarity has a common key on opposite sides."""
    percent = data.draw(st.sampled_from([50, 80, 85, 100]))
    base = data.draw(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=60, unique=True))
    gone = data.draw(st.sets(st.sampled_from(base), max_size=len(base) // 4))
    more = data.draw(st.lists(st.integers(0, 2**64 - 1), max_size=15, unique=True))
    a, b = set(base), (set(base) - gone) | set(more)
    shared = data.draw(st.permutations(sorted(a & b)))
    own = data.draw(st.booleans())  # whether hashes of one set alone are known to be
    if b and 100 * len(a & b) >= percent * len(a | b):
        found = []
        for one in (a, b):
            order = shared if own else sorted(one - (a & b)) + shared
            keys, sides, rooms = prefix_join.entries(np.array(order, dtype=np.uint64), len(one), percent)
            found.append({(int(k), int(s)): int(r) for k, s, r in zip(keys, sides, rooms)})
        assert any((100 + percent) * min(room, found[1].get((k, 1 - s), 0)) >= percent * (len(a) + len(b))
                   for (k, s), room in found[0].items())


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400), st.sets(st.integers(0, 2**64 - 1), max_size=400), st.integers(0, 400))
def test_parities_never_differ_in_more_places_than_sets_have_hashes_apart(a, b, shared):
    b = b | set(sorted(a)[:shared])
    one, other = (prefix_join.marks(np.array(sorted(x), dtype=np.uint64)) for x in (a, b))
    differ = sum(int(x).bit_count() for x in (one ^ other).view(np.uint64))
    assert len(one) == prefix_join.MARKS and differ <= len(a ^ b) and (differ - len(a ^ b)) % 2 == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_candidates_hold_all_pairs_of_other_labels(spark, percent):
    rng = random.Random(percent)
    family = [rng.randrange(2**64) for _ in range(150)]
    sets = []
    for i in range(120):  # each a changed copy of an earlier one
        own = list(rng.choice(sets)[0] if sets and rng.random() < 0.8 else family)
        for _ in range(rng.randrange(1, 30)):
            own[rng.randrange(len(own))] = rng.randrange(2**64)
        sets.append((own[:rng.randrange(len(own) * 9 // 10, len(own) + 1)], i % 3))
    rows = [(i, label, np.unique(np.array(s, dtype=np.uint64)).tobytes()) for i, (s, label) in enumerate(sets)]
    frame = spark.createDataFrame(rows, "node long, label long, shingles binary").repartition(4)
    labels = frame.select("node", "label")
    got = {(r["a"], r["b"]) for r in prefix_join.candidates(frame, labels, percent).collect()}
    rows = prefix_join.still_open(prefix_join.entered(frame, percent), labels)
    led = [(r["a"], r["b"]) for r in prefix_join.leading_pairs(rows, 2, percent).collect()]
    assert {tuple(sorted(p)) for p in led} <= got and max(sum(a == i for a, _ in led) for i in range(len(sets))) <= 2
    alike = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
             if 100 * jaccard(set(sets[i][0]), set(sets[j][0])) >= percent and sets[i][1] != sets[j][1]}
    assert alike and alike <= got
    others = len(sets) * (len(sets) - 1) // 3
    assert len(got) < others / 2 and all(sets[a][1] != sets[b][1] and a < b for a, b in got)


def test_no_sets_no_candidates(spark):
    frame = spark.createDataFrame([], "node long, label long, shingles binary")
    assert prefix_join.candidates(frame, frame.select("node", "label"), 85).count() == 0


def test_hashes_are_dealt_once_and_entries_stay_where_they_are(spark, monkeypatch):
    plans, real = {}, prefix_join.materialize

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, label)

    rows = [(i, np.unique(np.arange(i, i + 40, dtype=np.uint64)).tobytes()) for i in range(1, 30)]
    frame = real(spark.createDataFrame(rows, "node long, shingles binary"), "test-sets")
    labels = real(frame.select("node", F.col("node").alias("label")), "test-labels")
    monkeypatch.setattr(prefix_join, "materialize", seen)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        found = prefix_join.entered(frame, 85)
        assert "prefix-counts" not in plans and plans["prefix-order"].count("Exchange hashpartitioning(hash") == 1
        assert prefix_join.still_open(found, labels).count() > 0
    assert "SortMergeJoin" not in plans["prefix-open"]
