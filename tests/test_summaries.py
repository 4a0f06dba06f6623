import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seisflow.functions.display import CHART_BANDS, MAP_BANDS, forecast_bucket, severity_band
from seisflow.functions.scalars import clamp_points, linspace, trunc_int
from seisflow.operators import grids, summaries
from seisflow.operators.filters import drop_incomplete, lookback, place_search, range_query


def test_truncating_class_and_nan(spark):
    df = spark.createDataFrame([(-0.5,), (0.9,), (-1.2,), (3.99,), (float("nan"),), (None,)], "m double")
    assert [r[0] for r in df.select(trunc_int("m")).collect()] == [0, 0, -1, 3, None, None]


def test_class_counts_keep_null_group(spark):
    df = spark.createDataFrame([(-0.5,), (0.5,), (None,), (2.2,)], "magnitude double")
    got = {r["magnitude_range"]: r["count"] for r in summaries.class_counts(df).collect()}
    assert got == {None: 1, 0: 2, 2: 1}


def test_group_stats_half_even_and_null_keys(spark):
    df = spark.createDataFrame([("a", 0.125), ("a", 0.125), ("b", 0.375), (None, 1.0)], "k string, v double")
    out = {r["k"]: r for r in summaries.group_stats(df, "k", {"v": ["mean", "count"]}).collect()}
    assert set(out) == {"a", "b"}
    assert out["a"]["v_mean"] == 0.12 and out["b"]["v_mean"] == 0.38 and out["a"]["v_count"] == 2


def test_filters(spark):
    rows = [("x1", "2024-01-01 00:00:00", 3.0, "10 km N of Foo"), ("x2", "2024-01-02 00:00:00", 1.0, None),
            ("x3", "2024-01-03 00:00:00", 5.0, "near foo bar")]
    df = spark.createDataFrame(rows, "id string, t string, magnitude double, place string") \
        .withColumn("time", F.col("t").cast("timestamp"))
    assert [r.id for r in range_query(df, "2024-01-01 00:00:00", "2024-01-02 00:00:00", 2.0).collect()] == ["x1"]
    assert sorted(r.id for r in lookback(df, "2024-01-03 00:00:00", hours=24).collect()) == ["x2", "x3"]
    assert sorted(r.id for r in place_search(df, "FOO").collect()) == ["x1", "x3"]
    assert [r.id for r in place_search(df, "^near").collect()] == ["x3"]
    assert [r.id for r in place_search(df, "foo b", literal=True).collect()] == ["x3"]


def test_drop_incomplete_drops_nan(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 1.0), (None, 1.0)], "magnitude double, depth double")
    assert drop_incomplete(df, ["magnitude", "depth"]).count() == 1


def test_severity_bands_and_buckets(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (2.0,), (3.9,), (4.0,), (5.5,), (6.0,), (None,)], "magnitude double")
    got = df.select(severity_band("magnitude", MAP_BANDS).alias("a"), severity_band("magnitude", CHART_BANDS).alias("b"),
                    forecast_bucket("magnitude").alias("c")).collect()
    assert [r.a for r in got] == ["green", "green", "blue", "blue", "orange", "orange", "red", None]
    assert [r.b for r in got] == ["green", "blue", "blue", "orange", "orange", "red", "red", None]
    assert [r.c for r in got] == [None, None, None, None, None, "5.0-5.9", "5.0-5.9", None]


def test_linspace_and_clamp(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5, 3), (0.0, 1.0, 7, 40)], "lo double, hi double, n int, cnt long")
    out = df.select(linspace("lo", "hi", "n").alias("xs"), clamp_points("cnt").alias("k")).collect()
    for r, (lo, hi, n) in zip(out, [(1.0, 2.0, 5), (0.0, 1.0, 7)]):
        assert r.xs == list(np.linspace(lo, hi, n))
    assert [r.k for r in out] == [5, 15]


def test_histogram_last_bin_closed_and_empty_bins(spark):
    vals = [0.0, 0.1, 1.0, 1.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "magnitude double")
    h = grids.magnitude_histogram(df, bins=4).collect()
    assert [r["count"] for r in h] == [2, 0, 0, 2]
    assert h[0]["bin_start"] == 0.0 and h[-1]["bin_end"] == 1.0


def test_kde_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(3, 1, 500), 1)
    df = spark.createDataFrame([(float(v),) for v in x], "magnitude double")
    out = grids.magnitude_kde(df, gridsize=50).toPandas()
    bw = x.std(ddof=1) * len(x) ** (-0.2)
    g = np.linspace(x.min(), x.max(), 50)
    ref = np.exp(-0.5 * ((g[:, None] - x[None, :]) / bw) ** 2).sum(1) / (len(x) * bw * math.sqrt(2 * math.pi))
    assert np.allclose(out.sort_values("grid_index").density.to_numpy(), ref, rtol=1e-9)


def test_density_grid_edges(spark):
    df = spark.createDataFrame([(180.0, 90.0), (-180.0, -90.0), (181.0, 0.0), (None, 0.0), (0.0, 0.0)],
                               "longitude double, latitude double")
    got = {(r.x_bin, r.y_bin): r["count"] for r in grids.density_grid(df).collect()}
    assert got == {(49, 49): 1, (0, 0): 1, (25, 25): 1}


def test_marker_tiles_zoom0_single_tile(spark):
    df = spark.createDataFrame([(10.0, 50.0, 3.0), (-10.0, -50.0, 5.0)], "longitude double, latitude double, magnitude double")
    out = grids.marker_tiles(df, zooms=(0, 1)).collect()
    z0 = [r for r in out if r.zoom == 0]
    assert len(z0) == 1 and z0[0]["count"] == 2 and z0[0].max_magnitude == 5.0
    z1 = sorted((r.tile_x, r.tile_y) for r in out if r.zoom == 1)
    assert z1 == [(0, 1), (1, 0)]


def test_dense_index(spark):
    from seisflow.operators.common import dense_index
    df = spark.createDataFrame([(v,) for v in [50, 7, 7, 300, -2, 50, 1000]], "v long").repartition(3)
    got = {r["v"]: r["index"] for r in dense_index(df, "v").collect()}
    assert got == {-2: 0, 7: 1, 50: 2, 300: 3, 1000: 4}
