"""Marker clusters, radius join, heat raster and bounded point sets against plain versions."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from seisflow.operators import grids, markers, radius

EVENT = "id string, latitude double, longitude double, magnitude double"


def unit(lat, lon):
    la = math.radians(min(max(lat, -grids.WEB_MERCATOR_MAX_LAT), grids.WEB_MERCATOR_MAX_LAT))
    return (lon + 180) / 360, (1 - math.log(math.tan(la) + 1 / math.cos(la)) / math.pi) / 2


def crowd(seed=3, n=500):
    """Two crowded spots, one of them across a border of cells, and a scattered rest."""
    rng = np.random.default_rng(seed)
    lat = np.where(rng.random(n) < 0.4, 0.0, np.where(rng.random(n) < 0.5, 45 + rng.normal(0, 0.3, n), rng.uniform(-85, 85, n)))
    lon = np.where(lat == 0.0, 0.0 + rng.normal(0, 0.05, n), rng.uniform(-180, 180, n))
    return [(f"e{i}", float(a), float(o), float(m)) for i, (a, o, m) in enumerate(zip(lat, lon, rng.uniform(0, 8, n)))]


def plain_clusters(rows, zooms):
    """Markers one by one into base cells, then items one by one in order into centres."""
    levels = markers.ladder(zooms)
    side, cells, out = levels[0][1] / 4, defaultdict(list), {}
    for i, lat, lon, mag in rows:
        x, y = unit(lat, lon)
        cells[math.floor(x / side), math.floor(y / side)].append((hashlib.md5(i.encode()).hexdigest(), x, y, lat, lon, i))
    items = []
    for (cx, cy), own in cells.items():
        first = min(own)
        items.append((f"{first[0]}/{cx}/{cy}", first[1], first[2], side * math.sqrt(2), [m[5] for m in own]))
    for zoom, r in levels:
        centres = []
        for p, x, y, reach, own in sorted(items):
            for c in centres:
                far = math.hypot(c[1] - x, c[2] - y) + reach
                if far <= r:
                    c[3], c[4] = max(c[3], far), c[4] + own
                    break
            else:
                centres.append([p, x, y, reach, own])
        items = centres
        if zoom is not None:
            out[zoom] = items
    return out


@pytest.mark.parametrize("finish", [0, 1 << 16])
@pytest.mark.parametrize("parts", [1, 6])
def test_marker_clusters_equal_one_by_one(spark, finish, parts):
    rows = crowd()
    got = markers.marker_clusters(spark.createDataFrame(rows, EVENT).repartition(parts), (1, 4, 9), finish=finish).collect()
    where = {i: unit(lat, lon) for i, lat, lon, _ in rows}
    for zoom, items in plain_clusters(rows, (1, 4, 9)).items():
        mine = sorted((r["count"], round(r.center_latitude, 6), round(r.center_longitude, 6), round(r.reach_px, 4)) for r in got if r.zoom == zoom)
        lat = {p: next((a, o) for i, a, o, _ in rows if unit(a, o) == (x, y)) for p, x, y, _, _ in items}
        assert mine == sorted((len(own), round(lat[p][0], 6), round(lat[p][1], 6), round(reach * 256 * 2**zoom, 4)) for p, _, _, reach, own in items)
        assert sum(n for n, *_ in mine) == len(rows)
        for _, x, y, reach, own in items:
            assert reach * 256 * 2**zoom <= markers.RADIUS * (1 + 1e-9)
            assert all(math.hypot(where[i][0] - x, where[i][1] - y) <= reach * (1 + 1e-9) for i in own)


def test_markers_on_both_sides_of_a_tile_edge_merge(spark):
    rows = [("a", 0.001, -0.001, 1.0), ("b", -0.001, 0.001, 2.0), ("c", 0.001, 0.001, 3.0), ("n", None, 0.0, 1.0), ("m", 0.0, 0.0, None)]
    got = markers.marker_clusters(spark.createDataFrame(rows, EVENT), (2, 8)).collect()
    assert sorted((r.zoom, r["count"], r.max_magnitude) for r in got) == [(2, 3, 3.0), (8, 3, 3.0)]
    assert markers.marker_clusters(spark.createDataFrame([], EVENT)).count() == 0


def test_equal_ids_keep_their_markers(spark):
    rows = [("same", float(i % 5), 0.0, 1.0) for i in range(40)] + [(None, 50.0, 50.0, 1.0)]
    got = markers.marker_clusters(spark.createDataFrame(rows, EVENT), (0, 10)).groupBy("zoom").agg(F.sum("count").alias("n")).collect()
    assert {r.zoom: r.n for r in got} in ({0: 41, 10: 41}, {0: 40, 10: 40})


def plain_neighbours(points, eps):
    out = []
    for i, (x, y) in enumerate(points):
        d = [(x - a) * (x - a) + (y - b) * (y - b) for j, (a, b) in enumerate(points) if j != i]
        near = [v for v in d if v <= eps * eps]
        out.append((len(near), math.sqrt(min(near)) if near else None))
    return out


@pytest.mark.parametrize("leaf,eps", [(32, 0.3), (1, 0.3), (3, 0.02), (4, 50.0)])
def test_radius_neighbours_equal_all_pairs(spark, leaf, eps):
    rng = np.random.default_rng(leaf)
    spots = [tuple(map(float, p)) for p in np.concatenate([rng.normal(0, 0.1, (250, 2)), rng.uniform(-3, 3, (150, 2)), np.round(rng.uniform(-1, 1, (100, 2)), 1)])]
    spots += [(0.5, 0.5)] * 160 + [(-0.0, 0.0), (0.0, -0.0)]
    df = spark.createDataFrame([(i, x, y, "c") for i, (x, y) in enumerate(spots)], "id int, x double, y double, nearest string").repartition(5)
    got = {r.id: (r.neighbours, r.nearest) for r in radius.radius_neighbours(df, "x", "y", eps, leaf).collect()}
    assert [got[i] for i in range(len(spots))] == plain_neighbours(spots, eps)


def test_radius_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, 0.0, 0.0), (3, 3.0, 4.0)], "id int, x double, y double")
    got = {r.id: (r.neighbours, r.nearest) for r in radius.radius_neighbours(df, "x", "y", 5.0).collect()}
    assert got == {1: (None, None), 2: (1, 5.0), 3: (1, 5.0)}
    assert radius.radius_neighbours(df.limit(0), "x", "y", 5.0).count() == 0
    with pytest.raises(ValueError):
        radius.radius_neighbours(df, "x", "y", 0.0)


def test_heat_keeps_its_mass_and_shape(spark):
    rows = [("a", 0.0, 179.99, 4.0), ("b", 0.0, 10.0, 2.0), ("c", 89.9, 0.0, 1.0), ("d", 0.0, 10.0, 2.0)]
    got = grids.heat_raster(spark.createDataFrame(rows, EVENT), 1).collect()
    assert abs(sum(r.weight for r in got) - 9.0) < 1e-9
    at = {(r.px, r.py): r.weight for r in got}
    x, y = (math.floor(v * 512) for v in unit(0.0, 10.0))
    for dx, dy in ((0, 0), (15, 0), (-7, 3)):
        assert abs(at[x + dx, y + dy] - 4.0 * (16 - abs(dx)) * (16 - abs(dy)) / 65536) < 1e-12
    assert (x + 16, y) not in at and any(px < 15 and py == y for px, py in at)
    assert all((r.tile_x, r.tile_y) == (r.px // 256, r.py // 256) for r in got)


@pytest.mark.parametrize("points", [3, 20, 1000])
def test_series_keeps_ends_and_extremes(spark, points):
    rng = np.random.default_rng(points)
    rows = [(f"e{i}", int(t), float(np.round(m, 1))) for i, (t, m) in enumerate(zip(rng.integers(0, 5000, 400), rng.normal(2, 1, 400)))] + [("spike", 2500, 50.0), ("none", None, 1.0)]
    df = spark.createDataFrame(rows, "id string, s int, magnitude double").withColumn("time", F.timestamp_seconds("s"))
    got = [tuple(r) for r in grids.series_points(df, points).collect()]
    assert got == [tuple(r) for r in grids.series_points(df.repartition(7), points).collect()]
    assert len(got) <= points and got == sorted(got, key=lambda r: (r[0], r[2]))
    live = sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[0]))
    assert got[0][2] == live[0][0] and got[-1][2] == live[-1][0] and "spike" in {r[2] for r in got}
    assert grids.series_points(df.limit(0)).count() == 0
    assert grids.series_points(df.where("id = 'e1'"), points).count() == 1


def test_scatter_is_a_fixed_sample(spark):
    rows = [(f"e{i}", float(i), float(i % 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, depth double, magnitude double")
    got = {r.id for r in grids.scatter_points(df, 50).collect()}
    assert got == {r.id for r in grids.scatter_points(df.repartition(9), 50).collect()} and len(got) == 50
    assert got == set(sorted((r[0] for r in rows), key=lambda i: hashlib.md5(i.encode()).hexdigest())[:50])
    assert grids.scatter_points(df, 1000).count() == 300
