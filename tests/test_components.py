"""Components by contraction: right on any graph, in rounds that follow the logarithm of its size."""

import math

import numpy as np
import pytest

from seisflow.operators.components import components


def plain(edges):
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    root = {}
    for start in sorted(near):
        front = [start] if start not in root else []
        while front:
            v = front.pop()
            if v not in root:
                root[v] = start
                front += near[v]
    return root


def run(spark, edges, kind="long", **options):
    df = spark.createDataFrame(edges, f"a {kind}, b {kind}").repartition(3)
    return {r.node: r.root for r in components(df, **options).collect()}


@pytest.mark.parametrize("finish", [0, 40, 1 << 16])
def test_random_graphs(spark, finish):
    rng = np.random.default_rng(finish)
    edges = [(int(a), int(b)) for a, b in rng.integers(-300, 300, (260, 2))] + [(7, 7), (None, 3), (4, None), (9, 8), (8, 9), (8, 9)]
    assert run(spark, edges, finish=finish) == plain(edges)
    words = [(f"n{a}", f"n{b}") for a, b in edges if a is not None and b is not None]
    assert run(spark, words, "string", finish=finish) == plain(words)


def test_no_edges(spark):
    assert run(spark, []) == {} and run(spark, [(1, 1), (None, None)]) == {}


def shuffled(edges, n, seed=1):
    ids = np.random.default_rng(seed).permutation(n)
    return [(int(ids[a]), int(ids[b])) for a, b in edges]


SHAPES = {
    "chain": (2000, [(i, i + 1) for i in range(1999)]),
    "star": (2000, [(0, i) for i in range(1, 2000)]),
    "grid": (1600, [(i, i + 1) for i in range(1600) if i % 40 < 39] + [(i, i + 40) for i in range(1560)]),
    "comb": (2000, [(i, i + 1) for i in range(999)] + [(i, i + 1000) for i in range(1000)]),
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_rounds_follow_the_logarithm(spark, shape):
    n, edges = SHAPES[shape]
    rounds = []
    got = run(spark, shuffled(edges, n), finish=0, rounds=rounds)
    assert got == dict.fromkeys(range(n), 0)
    assert len(rounds) <= 2 * math.log2(n) + 5


def test_rounds_of_a_long_shuffled_chain(spark):
    n, rounds = 100_000, []
    df = spark.createDataFrame(shuffled([(i, i + 1) for i in range(n - 1)], n), "a long, b long").repartition(8)
    got = components(df, finish=0, rounds=rounds)
    assert got.count() == n and got.where("root <> 0").count() == 0
    assert len(rounds) <= 2 * math.log2(n) + 5
