"""Trees grown to the end against a plain recursive tree, and independence of placement and of who finishes a node."""

import hashlib

import numpy as np
import pytest

from seisflow.operators import forest

COLS = ["a", "b", "c"]


def plain_tree(rows, asked):
    """Predictions for ``asked`` of a recursive tree on ``rows`` ((features…), weight, label); every split tried in turn."""
    total, sums = sum(w for _, w, _ in rows), sum(w * y for _, w, y in rows)
    best, cut = None, None
    if len({y for _, _, y in rows}) > 1:
        for f in range(len(rows[0][0])):
            values = sorted({x[f] for x, _, _ in rows})
            for lo, hi in zip(values, values[1:]):
                n = sum(w for x, w, _ in rows if x[f] <= lo)
                s = sum(w * y for x, w, y in rows if x[f] <= lo)
                gain = s * s / n + (sums - s) * (sums - s) / (total - n)
                if best is None or gain > best:
                    best, cut = gain, (f, (lo + hi) / 2)
    if cut is None:
        return {p: sums / total for p in asked}
    f, at = cut
    out = {}
    for side in (True, False):
        part = [p for p in asked if (p[f] <= at) == side]
        if part:
            out |= plain_tree([r for r in rows if (r[0][f] <= at) == side], part)
    return out


def sample(n=500, seed=1):
    """Whole labels, so that sums are exact; a third of the rows at one place, some places with different labels."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.uniform(-2, 2, (n, 3)), 1)
    x[: n // 3] = x[0]
    x[n // 3: n // 2] = np.round(x[n // 3: n // 2])
    y = np.round(4 * x[:, 0] - 3 * np.abs(x[:, 1]) + rng.normal(0, 2, n)).astype(int)
    return [(f"r{i}", *map(float, v), int(k)) for i, (v, k) in enumerate(zip(x, y))]


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, "id string, a double, b double, c double, y int").repartition(parts)


def weight(i, tree, seed=42):
    u = int(hashlib.md5(f"{i}:{tree}:{seed}".encode()).hexdigest()[:13], 16) / 2**52
    return sum(u >= p for p in forest._POISSON)


def test_one_tree_equals_the_plain_tree(spark):
    rows, asked = sample(), [(0.05, 0.05, 0.05), (-9.0, 9.0, 0.0), (0.35, -1.2, 1.9), (2.0, 2.0, -2.0)]
    train = frame(spark, rows)
    want = plain_tree([(r[1:4], 1, r[4]) for r in rows], [r[1:4] for r in rows] + asked)
    got = forest.forest_predictions(train, COLS, "y", trees=1, bootstrap=False).collect()
    assert all(r.prediction == pytest.approx(want[r.a, r.b, r.c], abs=1e-9) for r in got) and len(got) == len(rows)
    new = spark.createDataFrame(asked, "a double, b double, c double")
    assert all(r.prediction == pytest.approx(want[r.a, r.b, r.c], abs=1e-9) for r in forest.forest_predictions(train, COLS, "y", trees=1, bootstrap=False, queries=new).collect())


@pytest.mark.parametrize("finish", [20, 150])
def test_levels_over_tasks_equal_one_task(spark, finish):
    """Nodes split by jobs give what the plain tree gives: the split, its ties and its thresholds are the same."""
    rows = sample(240, seed=finish)
    want = plain_tree([(r[1:4], 1, r[4]) for r in rows], [r[1:4] for r in rows])
    got = forest.forest_predictions(frame(spark, rows, 7), COLS, "y", trees=1, bootstrap=False, finish=finish).collect()
    assert all(r.prediction == pytest.approx(want[r.a, r.b, r.c], abs=1e-9) for r in got)


def test_forest_is_the_mean_of_trees_on_drawn_rows(spark):
    rows, trees = sample(120, seed=5), 3
    want = {}
    for t in range(trees):
        drawn = [(r[1:4], weight(r[0], t), r[4]) for r in rows if weight(r[0], t)]
        for p, v in plain_tree(drawn, [r[1:4] for r in rows]).items():
            want.setdefault(p, []).append(v)
    for parts in (1, 6):
        got = forest.forest_predictions(frame(spark, rows, parts), COLS, "y", trees=trees).collect()
        assert all(r.prediction == pytest.approx(np.mean(want[r.a, r.b, r.c]), abs=1e-9) for r in got)


def test_training_error_of_one_tree_is_zero_on_distinct_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(f"r{i}", *map(float, v), int(k)) for i, (v, k) in enumerate(zip(rng.permutation(300)[:, None] * [1, 2, -1], rng.integers(0, 1000, 300)))]
    assert all(r.prediction == pytest.approx(r.y, abs=1e-9) for r in forest.forest_predictions(frame(spark, rows), COLS, "y", trees=1, bootstrap=False, finish=40).collect())


def test_odd_inputs(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0, None, 3), ("b", -0.0, 1.0, 2.0, 4), ("c", 0.0, 1.0, 2.0, 6), ("d", 1.0, 1.0, 2.0, None)], "id string, a double, b double, c double, y int")
    got = {r.id: r.prediction for r in forest.forest_predictions(df, COLS, "y", trees=1, bootstrap=False).collect()}
    assert got == {"a": None, "b": 5.0, "c": 5.0, "d": 5.0}
    assert forest.forest_predictions(df.limit(0), COLS, "y", trees=2).count() == 0
    assert {r.prediction for r in forest.forest_predictions(df.where("false"), COLS, "y", trees=2, queries=df).collect()} == {None}


def test_a_level_of_all_nodes_is_split_at_once(monkeypatch):
    """The work of a task is a number of calls for each level, not for each node; the tree is the plain one."""
    rng = np.random.default_rng(3)
    x = np.round(rng.uniform(-2, 2, (400, 3)), 1)
    x = np.unique(x, axis=0)
    n, y = rng.poisson(1, len(x)), rng.integers(0, 9, len(x))
    calls, whole = [], forest.best_splits
    monkeypatch.setattr(forest, "best_splits", lambda *a: calls.append(1) or whole(*a))
    got = forest.grow(x, n.astype(float), (n * y).astype(float))
    want = plain_tree([(tuple(p), w, k) for p, w, k in zip(x, n, y) if w], [tuple(p) for p in x])
    assert [want[tuple(p)] for p in x] == pytest.approx(got.tolist(), abs=1e-9)
    assert len(calls) < 60 < (n > 0).sum() / 3
    monkeypatch.setattr(forest, "BLOCK", 8)
    assert np.array_equal(forest.grow(x, n.astype(float), (n * y).astype(float)), got)


def test_neighbouring_numbers_are_split():
    x = np.array([[1.0], [np.nextafter(1.0, 2.0)], [np.nextafter(np.nextafter(1.0, 2.0), 2.0)]])
    assert forest.grow(x, np.ones(3), np.array([1.0, 2.0, 4.0])).tolist() == [1.0, 2.0, 4.0]
    assert np.isnan(forest.grow(x, np.zeros(3), np.zeros(3))).all()
