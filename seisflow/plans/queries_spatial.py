"""Registered queries: merging markers, neighbours within a radius, the heat raster, bounded point sets."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from seisflow.operators import grids, markers, radius
from seisflow.plans.oracle import q
from seisflow.plans.registry import catalogue, fitted, register, round_cols

_PLACED = "latitude IS NOT NULL AND longitude IS NOT NULL"
_FULL = f"{_PLACED} AND magnitude IS NOT NULL"
_LAT = f"(least(greatest(latitude, {-grids.WEB_MERCATOR_MAX_LAT}::DOUBLE), {grids.WEB_MERCATOR_MAX_LAT}::DOUBLE) * {grids.DEG2RAD}::DOUBLE)"
_X = "((longitude + 18e1) / 36e1)"
_Y = f"((1e0 - ln(tan({_LAT}) + 1e0 / cos({_LAT})) / {math.pi}::DOUBLE) / 2e0)"

# ---------------------------------------------------------------- marker clusters

ZOOMS = (2, 4, 6)


def _marker_sql() -> str:
    """Greedy level by level: a list of centres grows in the order of the items."""
    levels = markers.ladder(ZOOMS)
    side = repr(levels[0][1] / 4)
    ctes = [f"""i0 AS MATERIALIZED (SELECT arg_min(struct_pack(p := p || '/' || cx || '/' || cy, x := x, y := y, lat := latitude, lon := longitude), p) AS f,
 {side}::DOUBLE * sqrt(2e0) AS reach, count(*) AS n, sum(latitude) AS slat, sum(longitude) AS slon, max(magnitude) AS top FROM
 (SELECT md5(id) AS p, {_X} AS x, {_Y} AS y, CAST(floor({_X} / {side}::DOUBLE) AS BIGINT) AS cx, CAST(floor({_Y} / {side}::DOUBLE) AS BIGINT) AS cy, latitude, longitude, magnitude
  FROM quakes WHERE {_FULL}) GROUP BY cx, cy)"""]
    rows = []
    for k, (zoom, r) in enumerate(levels):
        far = "sqrt((c.x - {0}.x) * (c.x - {0}.x) + (c.y - {0}.y) * (c.y - {0}.y)) + {1}"
        ctes.append(f"""c{k} AS MATERIALIZED (SELECT unnest(list_reduce(list([struct_pack(p := f.p, x := f.x, y := f.y, lat := f.lat, lon := f.lon, reach := reach)] ORDER BY f.p),
 lambda a, b: CASE WHEN len(list_filter(a, lambda c: {far.format('b[1]', 'b[1].reach')} <= {r!r}::DOUBLE)) > 0 THEN a ELSE list_concat(a, b) END)) AS c FROM i{k}),
a{k} AS (SELECT i.f.p AS p, min(c.p) AS v, arg_min({far.format('i.f', 'i.reach')}, c.p) AS far
 FROM i{k} i JOIN c{k} ON c.p < i.f.p AND {far.format('i.f', 'i.reach')} <= {r!r}::DOUBLE GROUP BY i.f.p),
i{k + 1} AS MATERIALIZED (SELECT any_value(struct_pack(p := c.p, x := c.x, y := c.y, lat := c.lat, lon := c.lon)) AS f, max(coalesce(far, i.reach)) AS reach, sum(n)::BIGINT AS n,
 sum(slat) AS slat, sum(slon) AS slon, max(top) AS top FROM i{k} i LEFT JOIN a{k} ON a{k}.p = i.f.p JOIN c{k} ON c.p = coalesce(v, i.f.p) GROUP BY c.p)""")
        if zoom is not None:
            rows.append(f"SELECT {zoom} AS zoom, n AS count, round(f.lat, 6) AS center_latitude, round(f.lon, 6) AS center_longitude, round(slat / n, 6) AS mean_latitude, "
                        f"round(slon / n, 6) AS mean_longitude, round(reach * {markers.TILE * 2.0 ** zoom!r}::DOUBLE, 4) AS reach_px, top AS max_magnitude FROM i{k + 1}")
    return q(" UNION ALL ".join(rows), ", ".join(ctes))


@register("marker_clusters", _marker_sql())
def marker_clusters(spark, sf_dir):
    got = fitted(spark, sf_dir, "markers", lambda: markers.marker_clusters(catalogue(spark, sf_dir), ZOOMS))
    return round_cols(got, ["center_latitude", "center_longitude", "mean_latitude", "mean_longitude"]).withColumn("reach_px", F.round("reach_px", 4))


# ---------------------------------------------------------------- neighbours within a radius

EPS = 0.5
_NEAR = f"""pl AS MATERIALIZED (SELECT longitude AS x, latitude AS y, count(*) AS n, CAST(floor(longitude / {EPS}) AS BIGINT) AS gx, CAST(floor(latitude / {EPS}) AS BIGINT) AS gy
 FROM quakes WHERE {_PLACED} GROUP BY longitude, latitude),
nb AS (SELECT a.x, a.y, any_value(a.n) AS n, sum(b.n)::BIGINT - 1 AS neighbours,
 min((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) FILTER (a.x <> b.x OR a.y <> b.y) AS d2
 FROM (SELECT pl.*, gx + dx AS hx, gy + dy AS hy FROM pl, (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy)) a JOIN pl b ON a.hx = b.gx AND a.hy = b.gy
 WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {EPS}::DOUBLE * {EPS}::DOUBLE GROUP BY a.x, a.y)"""


@register("radius_neighbours", q(
    "SELECT id, neighbours, round(CASE WHEN n > 1 THEN 0e0 ELSE sqrt(d2) END, 9) AS nearest FROM quakes LEFT JOIN nb ON x = longitude AND y = latitude", _NEAR))
def radius_neighbours(spark, sf_dir):
    got = radius.radius_neighbours(catalogue(spark, sf_dir).select("id", "longitude", "latitude"), "longitude", "latitude", EPS)
    return got.select("id", "neighbours", F.round("nearest", 9).alias("nearest"))


# A third of all events lies at one place, and the rest crowds into one degree around it.
_CROWD = ("crowd AS (SELECT id, CASE WHEN event_id % 3 = 0 THEN 1e1 ELSE 1e1 + ((event_id * 37) % 1000) / 1e3 END AS longitude, "
          "CASE WHEN event_id % 3 = 0 THEN 2e1 ELSE 2e1 + ((event_id * 53) % 997) / 1e3 END AS latitude FROM quakes)")


@register("radius_neighbours_crowded", q("SELECT id, neighbours, round(CASE WHEN n > 1 THEN 0e0 ELSE sqrt(d2) END, 9) AS nearest FROM crowd JOIN nb ON x = longitude AND y = latitude",
                                         _CROWD + ", " + _NEAR.replace("quakes", "crowd").replace(str(EPS), "0.05")))
def radius_neighbours_crowded(spark, sf_dir):
    rows, third = catalogue(spark, sf_dir), F.col("event_id") % 3 == 0
    rows = rows.select("id", F.when(third, 10.0).otherwise(F.lit(10.0) + ((F.col("event_id") * 37) % 1000) / 1000.0).alias("longitude"),
                       F.when(third, 20.0).otherwise(F.lit(20.0) + ((F.col("event_id") * 53) % 997) / 1000.0).alias("latitude"))
    got = radius.radius_neighbours(rows, "longitude", "latitude", 0.05)
    return got.select("id", "neighbours", F.round("nearest", 9).alias("nearest"))


# ---------------------------------------------------------------- heat raster

HEAT_ZOOM, _R = 1, 15
_SIZE = 256 * 2 ** HEAT_ZOOM
_EDGE = f"least(greatest({{0}}, 0), {_SIZE - 1})"
_HEAT = f"""px AS (SELECT ((CAST(floor({_X} * {float(_SIZE)!r}::DOUBLE) AS BIGINT) % {_SIZE}) + {_SIZE}) % {_SIZE} AS px, {_EDGE.format(f'CAST(floor({_Y} * {float(_SIZE)!r}::DOUBLE) AS BIGINT)')} AS py,
 sum(magnitude) AS weight FROM quakes WHERE {_FULL} GROUP BY 1, 2),
k AS (SELECT d, ({_R + 1} - abs(d)) / {float((_R + 1) ** 2)!r}::DOUBLE AS share FROM range({-_R}, {_R + 1}) r(d)),
full_raster AS (SELECT (px + k.d + {_SIZE}) % {_SIZE} AS px, {_EDGE.format('py + j.d')} AS py, sum(weight * k.share * j.share) AS weight FROM px, k, k j GROUP BY 1, 2)"""


# Magnitudes have one decimal and both kernels are in 256ths, so 65536 times a weight has one decimal too: rounding is exact.
@register("heat_raster", q("SELECT CAST(px // 256 AS INTEGER) AS tile_x, CAST(py // 256 AS INTEGER) AS tile_y, CAST(px AS INTEGER) AS px, CAST(py AS INTEGER) AS py, "
                           "round(weight * 65536, 1) / 65536 AS weight FROM full_raster", _HEAT))
def heat_raster(spark, sf_dir):
    return grids.heat_raster(catalogue(spark, sf_dir), HEAT_ZOOM).withColumn("weight", F.round(F.col("weight") * 65536, 1) / 65536)


# ---------------------------------------------------------------- bounded point sets

POINTS = 200
_SERIES = f"""r AS (SELECT id, time, magnitude, epoch_us(time) AS us FROM quakes WHERE magnitude IS NOT NULL),
lim AS (SELECT min(us) AS t0, (max(us) - min(us)) / 1e6 AS t1, greatest((max(us) - min(us)) / 1e6 / {POINTS - 2}, 1e-6) AS w, (SELECT magnitude FROM r ORDER BY us, id LIMIT 1) AS m0,
 (SELECT magnitude FROM r ORDER BY us DESC, id DESC LIMIT 1) AS m1 FROM r),
s AS (SELECT r.*, (us - t0) / 1e6 AS t, CAST(least(floor((us - t0) / 1e6 / w), {POINTS - 3}) AS INTEGER) AS stretch FROM r, lim),
me AS (SELECT stretch, round(avg(t), 6) AS mt, round(avg(magnitude), 9) AS mm FROM s GROUP BY stretch),
ar AS (SELECT stretch, coalesce(lag(mt) OVER o, 0e0) AS pt, coalesce(lag(mm) OVER o, m0) AS pm, coalesce(lead(mt) OVER o, t1) AS nt, coalesce(lead(mm) OVER o, m1) AS nm
 FROM me, lim WINDOW o AS (ORDER BY stretch)),
pk AS (SELECT *, row_number() OVER (PARTITION BY s.stretch ORDER BY round(abs((pt - nt) * (magnitude - pm) - (pt - t) * (nm - pm)), 6) DESC, us, id) AS n FROM s JOIN ar ON ar.stretch = s.stretch)"""


@register("series_points", q("SELECT id, time, magnitude FROM pk WHERE n = 1 UNION (SELECT id, time, magnitude FROM r ORDER BY us, id LIMIT 1) "
                             "UNION (SELECT id, time, magnitude FROM r ORDER BY us DESC, id DESC LIMIT 1)", _SERIES))
def series_points(spark, sf_dir):
    return grids.series_points(catalogue(spark, sf_dir), POINTS).select("id", "time", "magnitude")


@register("scatter_points", q(
    "SELECT id, depth, magnitude, round(2e1 + (magnitude - lo) / (hi - lo) * 18e1, 6) AS marker_size FROM quakes, "
    "(SELECT min(magnitude) AS lo, max(magnitude) AS hi FROM quakes) WHERE depth IS NOT NULL AND magnitude IS NOT NULL ORDER BY md5(id), id LIMIT 500"))
def scatter_points(spark, sf_dir):
    return round_cols(grids.scatter_points(catalogue(spark, sf_dir), 500), ["marker_size"])
