import math
import zlib
from collections import Counter
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from seisflow.llm import sharding
from seisflow.llm.sharding import Shard


def descend(key, tree):
    """The plain version: (region, rack, shard) by the smallest draw at each level."""
    def draw(name, weight):
        return -math.log((int(md5(f"{key}:{name}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52) / weight

    def pick(groups):
        return min(groups, key=lambda g: (draw(g, sum(t.weight for t in groups[g])), g))

    by = lambda f, rows: {f(t): [u for u in rows if f(u) == f(t)] for t in rows}
    live = [t for t in tree if t.weight > 0]
    region = pick(by(lambda t: t.region, live))
    live = [t for t in live if t.region == region]
    rack = pick(by(lambda t: f"{region}/{t.rack}", live))
    live = [t for t in live if f"{region}/{t.rack}" == rack]
    shard = pick(by(lambda t: f"shard{t.shard}", live))
    return region, rack.split("/")[-1], int(shard[5:])


TREE = [Shard(0, "a", "x", 2.0), Shard(1, "a", "x", 1.0), Shard(2, "a", "y", 3.0), Shard(3, "b", "x", 4.0), Shard(4, "b", "z", 0.0), Shard(5, "c", "w", 0.5)]


def placed(spark, tree, n=4000):
    df = spark.range(n).select(F.col("id").alias("doc_id"))
    return {r.doc_id: (r.region, r.rack, r.shard) for r in sharding.place(df, sharding.id_key(), tree, "region", "rack", "shard").collect()}


def test_descent_equals_plain_version(spark):
    got = placed(spark, TREE)
    assert got == {i: descend(str(i), TREE) for i in got}


def test_shares_follow_weights(spark):
    counts = Counter(s for _, _, s in placed(spark, TREE, 20000).values())
    assert 4 not in counts
    for t in TREE:
        if t.weight:
            assert abs(counts[t.shard] / 20000 - t.weight / 10.5) < 0.015


@pytest.mark.parametrize("weight", [5.0, 0.2, 0.0])
def test_a_changed_weight_moves_rows_only_into_or_out_of_its_subtree(spark, weight):
    before, after = placed(spark, TREE), placed(spark, [Shard(2, "a", "y", weight) if t.shard == 2 else t for t in TREE])
    more = weight > 3.0
    for i, (old, new) in enumerate(zip(before.values(), after.values())):
        if old != new:
            # It moves at the first level where the paths part: towards the changed node if that grew, away from it otherwise.
            gained, lost = (new, old) if more else (old, new)
            assert gained[0] == "a" and (lost[0] != "a" or (gained[1] == "y" and lost[1] != "y")), i


def test_one_more_shard_takes_rows_only_into_itself(spark):
    for n in (8, 9, 12):
        small, large = placed(spark, sharding.tree_of(n)), placed(spark, sharding.tree_of(n + 1))
        moved = {large[i][2] for i in small if small[i] != large[i]}
        assert moved == {n}
        assert abs(sum(small[i] != large[i] for i in small) / len(small) - 1 / (n + 1)) < 0.03


def test_rows_without_gaps_and_repeats(frame, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 4)
    rows = [(i, "t" * (i % 7)) for i in range(300)] + [(5, "same")] * 30 + [(None, None)] * 9 + [(None, "é")] + [(7, None), (7, "")]
    out = sharding.shard_digests(frame([(*r, 1, "x") for r in rows], "doc_id long, text string, shard int, size string")).collect()
    assert out[0].asDict().keys() == {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "region", "rack"}
    want = Counter()
    for i, t in rows:
        key, raw = "" if i is None else str(i), (t or "").encode()
        want[i, len(raw) + 1, zlib.crc32(raw), descend(key, sharding.tree_of(8))[2], descend(key, sharding.tree_of(9))[2]] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in out) == want
    for s in {r.shard for r in out}:
        own = sorted((r for r in out if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        order = [(r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in own]
        assert order == sorted(order)


def test_odd_and_empty(odd, frame):
    assert sharding.shard_digests(odd).count() == odd.count()
    assert sharding.shard_digests(frame([])).count() == 0
    with pytest.raises(ValueError):
        sharding.place(odd, sharding.id_key(), [], "a", "b", "c")


def test_main_path_is_native(docs):
    plan = sharding.shard_digests(docs)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "MapPartitions", "CartesianProduct"))
