"""Linear models from moments and k-means by Lloyd steps against Spark ML, numpy and plain loops."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seisflow.operators import lloyd, moments


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, [1.0, 5.0, 0.2], (600, 3))
    x[:, 1] += 2 * x[:, 0]
    y = 3 + x @ [1.5, -0.2, 4.0] + rng.normal(0, 0.5, 600)
    rows = [(f"r{i}", *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id string, a double, b double, c double, y double").repartition(5).persist()


@pytest.mark.parametrize("reg,elastic", [(0.0, 0.0), (0.1, 0.8), (0.3, 1.0), (0.5, 0.0), (50.0, 0.8)])
def test_elastic_net_is_the_minimum_spark_ml_finds(table, reg, elastic):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    mine = moments.fit_elastic_net(table, "y", ["a", "b", "c"], reg, elastic)
    ml = LinearRegression(featuresCol="f", labelCol="y", regParam=reg, elasticNetParam=elastic, maxIter=500, tol=1e-12).fit(
        VectorAssembler(inputCols=["a", "b", "c"], outputCol="f").transform(table))
    assert np.allclose(mine.coefficients, ml.coefficients.toArray(), atol=2e-5)
    assert mine.intercept == pytest.approx(ml.intercept, abs=2e-5)


def test_elastic_net_odd_inputs(spark, table, tmp_dir):
    flat = table.withColumn("k", F.lit(2.0))
    got = moments.fit_elastic_net(flat, "y", ["k", "a"], 0.01, 0.5)
    assert got.coefficients[0] == 0.0 and got.coefficients[1] != 0.0
    assert moments.fit_elastic_net(flat, "k", ["a"]).coefficients == (0.0,)
    assert moments.fit_elastic_net(table.limit(0), "y", ["a"]) == moments.LinearModel(("a",), (0.0,), 0.0, 0)
    gaps = table.unionByName(spark.createDataFrame([("n", None, 1.0, 1.0, 1.0), ("m", float("nan"), 1.0, 1.0, 1.0)], table.schema))
    assert np.allclose(moments.fit_elastic_net(gaps, "y", ["a", "b"]).coefficients, moments.fit_elastic_net(table, "y", ["a", "b"]).coefficients)
    got.save(spark, tmp_dir + "/linear")
    assert moments.LinearModel.load(spark, tmp_dir + "/linear") == got


def test_moments_take_one_pass(table):
    """One aggregate over the columns, no sort and no join."""
    m = moments.moments(table, ["a", "b", "c", "y"])
    x = np.array([[r[c] for c in m.columns] for r in table.collect()])
    assert m.n == 600 and np.allclose(m.means, x.mean(axis=0)) and np.allclose(m.cov, np.cov(x.T, ddof=0))


def test_components_are_eigenvectors(table):
    fit = moments.fit_components(table, ["a", "b", "c", "y"], 3)
    x = np.array([[r[c] for c in fit.columns] for r in table.collect()])
    values, vectors = np.linalg.eigh(np.cov(x.T, ddof=0))
    assert np.allclose(fit.ratios, values[::-1][:3] / values.sum())
    assert np.allclose(np.abs(fit.vectors.T @ vectors[:, ::-1][:, :3]), np.eye(3), atol=1e-6)
    assert all(fit.vectors[np.abs(fit.vectors[:, j]).argmax(), j] > 0 for j in range(3))
    score = {r.id: r.pca1 for r in fit.transform(table).collect()}
    assert score["r7"] == pytest.approx(sum(fit.vectors[j, 0] * next(r for r in table.collect() if r.id == "r7")[c] for j, c in enumerate(fit.columns)))


def plain_lloyd(points, ids, k, seed, steps):
    places = {}
    for p, i in zip(points, ids):
        h = hashlib.md5(f"{i}:{seed}".encode()).hexdigest()
        n, old = places.get(p, (0, h))
        places[p] = (n + 1, min(old, h))
    centres = [p for p, _ in sorted(places.items(), key=lambda x: x[1][1])[:k]]
    label = lambda p: min(range(len(centres)), key=lambda c: (sum((a - b) * (a - b) for a, b in zip(p, centres[c])), c))
    for _ in range(steps):
        own = {}
        for p, (n, _) in places.items():
            own.setdefault(label(p), []).append((p, n))
        centres = [tuple(sum(p[d] * n for p, n in own[c]) / sum(n for _, n in own[c]) for d in range(len(centres[0]))) if c in own else centres[c] for c in range(len(centres))]
    return centres, [label(p) for p in points]


@pytest.mark.parametrize("k,steps", [(1, 3), (4, 2), (7, 50)])
def test_lloyd_equals_plain_steps(spark, k, steps):
    rng = np.random.default_rng(k)
    points = [tuple(map(float, p)) for p in np.round(rng.normal(rng.integers(0, 4, 300)[:, None], 0.4, (300, 2)), 1)] + [(9.0, 9.0)] * 150
    ids = [f"e{i}" for i in range(len(points))]
    df = spark.createDataFrame([(i, *p) for i, p in zip(ids, points)], "id string, x double, y double").repartition(6)
    fit = lloyd.fit_lloyd(df, ["x", "y"], "id", k, 7, steps)
    centres, labels = plain_lloyd(points, ids, k, 7, steps)
    assert np.allclose(fit.centres, centres)
    assert {r.id: r.prediction for r in fit.transform(df).collect()} == dict(zip(ids, labels))


def test_lloyd_with_few_places_and_none(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0), ("d", None)], "id string, x double")
    fit = lloyd.fit_lloyd(df, ["x"], k=5)
    assert sorted(fit.centres) == [(1.0,), (2.0,)] and fit.settled
    assert lloyd.fit_lloyd(df.limit(0), ["x"]).centres == ()


def test_silhouette_equals_all_pairs(spark):
    rng = np.random.default_rng(2)
    x, c = rng.normal(0, 1, (90, 2)), np.append(rng.integers(0, 3, 89), 9)
    d2 = ((x[:, None] - x[None]) ** 2).sum(-1)
    scores = []
    for i in range(90):
        own = (c == c[i]) & (np.arange(90) != i)
        if not own.any():
            scores.append(0.0)
            continue
        a, b = d2[i, own].mean(), min(d2[i, c == o].mean() for o in set(c.tolist()) - {c[i]})
        scores.append((b - a) / max(a, b))
    df = spark.createDataFrame([(float(p[0]), float(p[1]), int(k)) for p, k in zip(x, c)], "x double, y double, prediction int")
    assert lloyd.silhouette(df, ["x", "y"]) == pytest.approx(np.mean(scores))
    assert lloyd.silhouette(df.where("prediction = 1"), ["x", "y"]) is None
