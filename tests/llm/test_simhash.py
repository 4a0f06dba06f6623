import numpy as np
import pytest
from pyspark.sql import functions as F

from seisflow.llm import simhash
from seisflow.operators.components import components


def classes(fps, ids, bits=3):
    """Smallest id reachable over links of at most ``bits`` bits, all pairs compared."""
    x = np.array(fps, np.uint64)
    todo, root = set(range(len(x))), {}
    while todo:
        part, front = set(), [todo.pop()]
        while front:
            i = front.pop()
            part.add(i)
            near = [j for j in todo if np.bitwise_count(x[i] ^ x[j]) <= bits]
            todo -= set(near)
            front += near
        least = min(ids[i] for i in part)
        root |= {i: least for i in part}
    return [root[i] for i in range(len(x))]


def clusters(seed):
    rng = np.random.default_rng(seed)
    fps = []
    for _ in range(12):
        pool = [int(rng.integers(0, 2**63))]
        for _ in range(int(rng.integers(1, 60))):
            y = pool[int(rng.integers(len(pool)))]
            for b in rng.choice(64, int(rng.integers(0, 5)), replace=False):
                y ^= 1 << int(b)
            pool.append(y)
        fps += pool
    return fps


@pytest.mark.parametrize("bulk", [4096, 4])
def test_components_equal_all_pairs(spark, monkeypatch, bulk):
    monkeypatch.setattr(simhash, "BULK", bulk)
    fps = clusters(bulk)
    ids = [int(i) for i in np.random.default_rng(0).permutation(len(fps))]
    df = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in zip(ids, fps)], "doc_id long, fp long").repartition(4)
    got = {r.fp: r.component_id for r in simhash.classes(df).collect()}
    assert [got[int(np.uint64(f).view(np.int64))] for f in fps] == classes(fps, ids)


def test_every_pair_within_three_bits_meets_at_an_anchor():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**32, 3000).astype(np.uint64)
    y = x ^ np.where(rng.random(3000) < 0.2, np.uint64(0), np.uint64(1) << rng.integers(0, 32, 3000).astype(np.uint64))
    home, _ = simhash.anchors(x)
    own, others = simhash.anchors(y)
    assert all(h in {o, *row} for h, o, row in zip(home.tolist(), own.tolist(), others.tolist()))
    assert np.bitwise_count(home ^ x).max() <= 1 and np.bitwise_count(others ^ y[:, None]).max() <= 2


def test_fingerprint_bits_are_majorities_of_spark_hashes(docs):
    """The JVM's xxhash64 has seed 42 too."""
    words = F.split(F.trim(F.regexp_replace(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x20\x09-\x0D]+", " ")), " ")
    h = docs.where("doc_id % 20 = 1").select("doc_id", words.alias("w")).where("size(w) >= 3").select(
        "doc_id", F.explode(F.expr("transform(sequence(0, size(w) - 3), i -> xxhash64(concat_ws(' ', w[i], w[i+1], w[i+2])))")).alias("h"))
    bits = h.groupBy("doc_id").agg(*[F.sum(F.shiftrightunsigned("h", k).bitwiseAND(1)).alias(f"b{k}") for k in range(64)], F.count("*").alias("n"))
    got = {r.doc_id: r.fingerprint for r in simhash.near_duplicate_classes(docs).collect()}
    rows = bits.collect()
    assert rows and all(got[r.doc_id] == format(sum((2 * r[f"b{k}"] > r.n) << k for k in range(64)), "016x") for r in rows)


def test_whole_table_equals_all_pairs(docs):
    rows = simhash.near_duplicate_classes(docs).collect()
    assert [r.component_id for r in rows] == classes([int(r.fingerprint, 16) for r in rows], [r.doc_id for r in rows])


def test_odd_rows(frame, odd):
    rows = frame([(None, None), (5, ""), (5, ""), (4, "a b"), (3, "A  b ")])
    got = sorted((r.component_id, r.fingerprint[:4]) for r in simhash.near_duplicate_classes(rows).collect())
    assert [c for c, _ in got] == [3, 3, 5, 5, 5]
    assert sorted((r.doc_id, r.text) for r in simhash.drop_near_duplicates(rows).collect()) == [(3, "A  b "), (5, "")]
    assert simhash.near_duplicate_classes(frame([])).count() == 0 and simhash.drop_near_duplicates(frame([])).count() == 0
    assert simhash.drop_near_duplicates(odd).columns == odd.columns
    assert simhash.near_duplicates(odd).count() == odd.count()


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 200)] + [(500, 499), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in range(100, 200)) and got[500] == got[499] == 499


def test_one_row_stays_per_component_with_null_and_repeated_ids(frame):
    """Null ids, one id on different texts, equal rows: the first of each component by id (nulls last) stays, once."""
    near = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(3, near), (None, near), (None, "quite other words stand in this text here"), (None, "quite other words stand in this text here"),
            (7, "alpha beta gamma delta"), (7, "alpha beta gamma delta"), (7, near), (2, "Alpha BETA gamma delta"), (9, "only this one")]
    got = sorted(((r.doc_id, r.text) for r in simhash.drop_near_duplicates(frame(rows)).collect()), key=str)
    assert got == sorted([(3, near), (None, "quite other words stand in this text here"), (2, "Alpha BETA gamma delta"), (9, "only this one")], key=str)


def test_long_chain_of_fingerprints_is_one_component(frame, spark):
    """600 fingerprints, each one bit from the next, in shuffled order of ids."""
    fp, chain = 0, []
    rng = np.random.default_rng(1)
    while len(chain) < 600:
        fp ^= 1 << int(rng.integers(64))
        if fp not in chain:
            chain.append(fp)
    ids = rng.permutation(600)
    df = spark.createDataFrame([(int(i), int(np.uint64(f).view(np.int64))) for i, f in zip(ids, chain)], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.classes(df).collect()}
    assert [got[int(np.uint64(f).view(np.int64))] for f in chain] == classes(chain, [int(i) for i in ids])
