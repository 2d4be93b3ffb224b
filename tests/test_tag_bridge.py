import hashlib
import random
import zlib

import pytest

from newsloom.operators import tag_bridge

DIM = {"a": 1, "b": 2, "c": 3, "A": 4}


def key(url):
    return zlib.crc32(url.encode()), int(hashlib.md5(url.encode()).hexdigest()[:15], 16)


def sync(spark, delta, bridge, dim=DIM):
    dim_tag = spark.createDataFrame([(v, k) for k, v in dim.items()], "tag_key long, tag_name string")
    rows = spark.createDataFrame(delta, "article_url string, tags string")
    old = spark.createDataFrame([(*k, t) for k, t in bridge], "article_key long, address_mark long, tag_key long")
    compared = tag_bridge.compare_with_bridge(tag_bridge.new_tag_sets(rows, dim_tag), old).cache()
    counts = tag_bridge.sync_counts(compared).first()
    pairs = [((r.article_key, r.address_mark), r.tag_key) for r in tag_bridge.synced_bridge(old, compared).collect()]
    assert len(pairs) == len(set(pairs))
    return set(pairs), (counts.updated, counts.skipped)


@pytest.mark.parametrize("delta,bridge,after,counts", [
    ([("u", "b, a")], [("u", 1), ("u", 2)], [("u", 1), ("u", 2)], (0, 1)),
    ([("u", "zzz")], [("u", 1)], [], (1, 0)),
    ([("u", None), ("v", "")], [("u", 1), ("v", 2)], [("u", 1), ("v", 2)], (0, 0)),
    ([("u", "a,b"), ("u", "c")], [("u", 1), ("u", 2)], [("u", 3)], (1, 1)),
    ([("u", "a, a ,a")], [], [("u", 1)], (1, 0)),
    ([("u", "zzz")], [], [], (0, 1)),
    ([("u", ",")], [("u", 1)], [], (1, 0)),
    ([("u", "A")], [("u", 1)], [("u", 4)], (1, 0)),
    ([("u", "a"), ("u", "a"), ("u", "b")], [], [("u", 1), ("u", 2)], (3, 0)),
    ([], [("u", 1)], [("u", 1)], (0, 0)),
])
def test_cases(spark, delta, bridge, after, counts):
    pairs = [(key(u), t) for u, t in bridge]
    assert sync(spark, delta, pairs) == ({(key(u), t) for u, t in after}, counts)


def test_random_deltas(spark):
    """Articles without tags in the delta keep theirs, the others get known tags only, and every row is counted once."""
    rng = random.Random(5)
    urls = [f"u{i}" for i in range(30)]
    for _ in range(2):
        delta = [(u, rng.choice([None, "", ",".join(rng.choices(["a", " b", "c ", "A", "zz", ""], k=rng.randrange(1, 4)))]))
                 for u in rng.sample(urls, 20)]
        bridge = list({(key(u), rng.randrange(1, 5)) for u in rng.choices(urls, k=40)})
        after, (updated, skipped) = sync(spark, delta, bridge)
        given = {key(u) for u, tags in delta if tags}
        assert {p for p in after if p[0] not in given} == {p for p in bridge if p[0] not in given}
        assert {t for k, t in after if k in given} <= set(DIM.values())
        assert updated + skipped == len(given)
        assert sync(spark, delta, sorted(after)) == (after, (0, len(given)))


def test_second_run_changes_nothing(spark):
    delta = [("u", "a,b"), ("v", "c"), ("w", "zz")]
    once, _ = sync(spark, delta, [])
    again, counts = sync(spark, delta, sorted(once))
    assert again == once and counts == (0, 3)


def test_addresses_of_one_crc_keep_their_own_tags(spark):
    """Two addresses that CRC-32 does not tell apart."""
    one, other = "plumless", "buckeroo"
    assert key(one)[0] == key(other)[0] and key(one) != key(other)
    bridge = [(key(one), 1), (key(other), 2)]
    after, counts = sync(spark, [(one, "c")], bridge)
    assert after == {(key(one), 3), (key(other), 2)} and counts == (1, 0)
    assert sync(spark, [(one, "a"), (other, "b")], bridge) == (set(bridge), (0, 2))


def test_insert_if_absent(spark):
    schema = "article_key long, address_mark long, tag_key long"
    old = spark.createDataFrame([(1, 5, 1), (1, 5, 2)], schema)
    new = spark.createDataFrame([(1, 5, 2), (1, 5, 3), (1, 5, 3), (1, 6, 2)], schema)
    assert sorted(map(tuple, tag_bridge.insert_if_absent(old, new).collect())) == [(1, 5, 1), (1, 5, 2), (1, 5, 3), (1, 6, 2)]
