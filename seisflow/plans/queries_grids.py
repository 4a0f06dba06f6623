"""Registered queries: histograms, density, tiles, scatter data, features (exact oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from seisflow.operators import features, grids, models, regions
from seisflow.operators.filters import drop_incomplete
from seisflow.plans.oracle import REGION_FIRST, q
from seisflow.plans.registry import catalogue, register, round_cols

# ---------------------------------------------------------------- histogram and KDE

_HIST_STATS = "s AS (SELECT min(magnitude) AS lo, max(magnitude) AS hi FROM quakes)"


@register("magnitude_histogram", q(
    "SELECT g.bin, round(s.lo + g.bin * (s.hi - s.lo) / 2e1, 6) AS bin_start, "
    "round(s.lo + (g.bin + 1) * (s.hi - s.lo) / 2e1, 6) AS bin_end, coalesce(c.n, 0) AS \"count\" "
    "FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(20)) g CROSS JOIN s LEFT JOIN "
    "(SELECT CAST(least(floor((magnitude - s.lo) * 2e1 / (s.hi - s.lo)), 19) AS INTEGER) AS bin, count(*) AS n "
    " FROM quakes, s WHERE magnitude IS NOT NULL GROUP BY 1) c ON g.bin = c.bin", _HIST_STATS))
def magnitude_histogram(spark, sf_dir):
    return round_cols(grids.magnitude_histogram(catalogue(spark, sf_dir)), ["bin_start", "bin_end"])


@register("magnitude_kde", q(
    "SELECT grid_index, round(x, 6) AS x, round(sum(k) / (s.n * s.bw * sqrt(2e0 * pi())), 6) AS density, "
    "round(sum(k) / (s.n * s.bw * sqrt(2e0 * pi())) * s.n * ((s.hi - s.lo) / 2e1), 6) AS count_density "
    "FROM (SELECT g.grid_index, s.lo + g.grid_index * ((s.hi - s.lo) / 199e0) AS x, "
    "      v.w * exp(-5e-1 * pow((s.lo + g.grid_index * ((s.hi - s.lo) / 199e0) - v.v) / s.bw, 2)) AS k "
    "      FROM (SELECT magnitude AS v, count(*) AS w FROM quakes WHERE magnitude IS NOT NULL GROUP BY 1) v "
    "      CROSS JOIN (SELECT CAST(range AS INTEGER) AS grid_index FROM range(200)) g CROSS JOIN s) t, s "
    "GROUP BY grid_index, x, s.n, s.bw, s.hi, s.lo",
    "s AS (SELECT min(magnitude) AS lo, max(magnitude) AS hi, count(magnitude) AS n, "
    "stddev_samp(magnitude) * pow(count(magnitude), -2e-1) AS bw FROM quakes)"))
def magnitude_kde(spark, sf_dir):
    return round_cols(grids.magnitude_kde(catalogue(spark, sf_dir)), ["x", "density", "count_density"])


# ---------------------------------------------------------------- spatial grids

@register("density_grid", q(
    "SELECT x_bin, y_bin, round(-18e1 + x_bin * 7.2e0, 6) AS lon_start, round(-9e1 + y_bin * 3.6e0, 6) AS lat_start, "
    "count(*) AS \"count\" FROM (SELECT "
    "CAST(least(floor((longitude - -18e1) * 5e1 / 36e1), 49) AS INTEGER) AS x_bin, "
    "CAST(least(floor((latitude - -9e1) * 5e1 / 18e1), 49) AS INTEGER) AS y_bin FROM quakes "
    "WHERE longitude BETWEEN -18e1 AND 18e1 AND latitude BETWEEN -9e1 AND 9e1) t GROUP BY 1, 2"))
def density_grid(spark, sf_dir):
    return round_cols(grids.density_grid(catalogue(spark, sf_dir)), ["lon_start", "lat_start"])


@register("heat_cells", q(
    "SELECT CAST(floor(latitude / 1e0) AS BIGINT) AS lat_cell, CAST(floor(longitude / 1e0) AS BIGINT) AS lon_cell, "
    "round(sum(magnitude), 6) AS weight, count(*) AS \"count\" FROM quakes "
    "WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND magnitude IS NOT NULL GROUP BY 1, 2"))
def heat_cells(spark, sf_dir):
    return round_cols(grids.heat_cells(catalogue(spark, sf_dir)), ["weight"])


_TILE_PHI = "(least(greatest(latitude, -85.0511287798066e0), 85.0511287798066e0) * 0.017453292519943295e0)"


@register("marker_tiles", q(
    "SELECT zoom, tile_x, tile_y, count(*) AS \"count\", round(avg(latitude), 6) AS center_latitude, "
    "round(avg(longitude), 6) AS center_longitude, max(magnitude) AS max_magnitude FROM ("
    " SELECT zoom, latitude, longitude, magnitude, "
    " CAST(least(greatest(floor((longitude + 18e1) / 36e1 * pow(2e0, zoom)), 0e0), pow(2e0, zoom) - 1) AS INTEGER) AS tile_x, "
    f" CAST(least(greatest(floor((1e0 - ln(tan({_TILE_PHI}) + 1e0 / cos({_TILE_PHI})) / pi()) / 2e0 * pow(2e0, zoom)), 0e0), "
    " pow(2e0, zoom) - 1) AS INTEGER) AS tile_y "
    " FROM quakes CROSS JOIN (SELECT unnest([2, 4, 6]) AS zoom) z "
    " WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND magnitude IS NOT NULL) t GROUP BY 1, 2, 3"))
def marker_tiles(spark, sf_dir):
    return round_cols(grids.marker_tiles(catalogue(spark, sf_dir)), ["center_latitude", "center_longitude"])


# ---------------------------------------------------------------- ordered points

@register("time_ordered_points", q("SELECT time, magnitude, id FROM quakes ORDER BY time, id"))
def time_ordered_points(spark, sf_dir):
    return grids.time_ordered(catalogue(spark, sf_dir))


@register("depth_scatter", q(
    "SELECT id, depth, magnitude, round(2e1 + (magnitude - s.lo) / (s.hi - s.lo) * 18e1, 6) AS marker_size "
    "FROM quakes, s WHERE depth IS NOT NULL AND magnitude IS NOT NULL", _HIST_STATS))
def depth_scatter(spark, sf_dir):
    return round_cols(grids.depth_scatter(catalogue(spark, sf_dir)), ["marker_size"])


# ---------------------------------------------------------------- standardisation and covariance

_Z_STATS = ("s AS (SELECT avg(magnitude) AS mm, stddev_pop(magnitude) AS sm, avg(depth) AS md, stddev_pop(depth) AS sd, "
            "avg(latitude) AS mla, stddev_pop(latitude) AS sla, avg(longitude) AS mlo, stddev_pop(longitude) AS slo "
            "FROM quakes WHERE magnitude IS NOT NULL AND depth IS NOT NULL AND latitude IS NOT NULL "
            "AND longitude IS NOT NULL), "
            "z AS (SELECT id, (magnitude - mm) / sm AS magnitude_z, (depth - md) / sd AS depth_z, "
            "(latitude - mla) / sla AS latitude_z, (longitude - mlo) / slo AS longitude_z FROM quakes, s "
            "WHERE magnitude IS NOT NULL AND depth IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL)")


@register("zscores", q(
    "SELECT id, round(magnitude_z, 6) AS magnitude_z, round(depth_z, 6) AS depth_z, "
    "round(latitude_z, 6) AS latitude_z, round(longitude_z, 6) AS longitude_z FROM z", _Z_STATS))
def zscores(spark, sf_dir):
    z, _ = features.standardize(catalogue(spark, sf_dir), features.PATTERN_FEATURES)
    cols = [f"{c}_z" for c in features.PATTERN_FEATURES]
    return round_cols(z.select("id", *cols), cols)


_ZC = ["magnitude_z", "depth_z", "latitude_z", "longitude_z"]
_COV_PAIRS = [(a, b) for i, a in enumerate(_ZC) for b in _ZC[i:]]


@register("feature_covariance", q(
    "SELECT " + ", ".join(f"round(covar_pop({a}, {b}), 6) AS cov_{a}_{b}" for a, b in _COV_PAIRS) + " FROM z",
    _Z_STATS))
def feature_covariance(spark, sf_dir):
    z, _ = features.standardize(catalogue(spark, sf_dir), features.PATTERN_FEATURES)
    cov = models.covariance_matrix(z, _ZC)
    return round_cols(cov, cov.columns)


# ---------------------------------------------------------------- nearest centre and cluster stats
# Centres are fitted from the data: the mean feature vector of each region (first-match mode), in code order.

_CF = ["magnitude", "longitude", "latitude", "depth"]
_FIRST_SQL = REGION_FIRST
_CENTRES = (
    "clean AS (SELECT * FROM quakes WHERE magnitude IS NOT NULL AND longitude IS NOT NULL "
    "AND latitude IS NOT NULL AND depth IS NOT NULL), "
    f"ctr AS (SELECT row_number() OVER (ORDER BY code) - 1 AS idx, cm, clo, cla, cd FROM ("
    f"SELECT {_FIRST_SQL} AS code, avg(magnitude) AS cm, avg(longitude) AS clo, avg(latitude) AS cla, "
    "avg(depth) AS cd FROM clean GROUP BY 1) g), "
    "dist AS (SELECT c.id, ctr.idx, pow(c.magnitude - ctr.cm, 2) + pow(c.longitude - ctr.clo, 2) "
    "+ pow(c.latitude - ctr.cla, 2) + pow(c.depth - ctr.cd, 2) AS d FROM clean c CROSS JOIN ctr), "
    "lab AS (SELECT id, CAST(idx AS INTEGER) AS prediction FROM (SELECT id, idx, row_number() OVER "
    "(PARTITION BY id ORDER BY d, idx) AS rk FROM dist) r WHERE rk = 1), "
    "pts AS (SELECT clean.*, lab.prediction FROM clean JOIN lab USING (id))")


def _region_centre_labels(spark, sf_dir):
    clean = drop_incomplete(catalogue(spark, sf_dir), _CF)
    coded = clean.withColumn("code", regions.region_code(mode="first"))
    centres = models.group_centers(coded, "code", _CF)
    return models.assign_clusters(clean, _CF, centres)


@register("nearest_center", q("SELECT id, prediction FROM lab", _CENTRES))
def nearest_center(spark, sf_dir):
    return _region_centre_labels(spark, sf_dir).select("id", "prediction")


@register("cluster_sizes", q("SELECT prediction, count(*) AS \"count\" FROM pts GROUP BY 1 ORDER BY 1", _CENTRES))
def cluster_sizes(spark, sf_dir):
    from seisflow.operators.summaries import cluster_sizes as sizes
    return sizes(_region_centre_labels(spark, sf_dir))


@register("fixed_center_cluster_stats", q(
    "SELECT prediction, round(avg(magnitude), 6) AS magnitude_mean, min(magnitude) AS magnitude_min, "
    "max(magnitude) AS magnitude_max, count(magnitude) AS magnitude_count, round(avg(depth), 6) AS depth_mean, "
    "min(depth) AS depth_min, max(depth) AS depth_max FROM pts GROUP BY 1", _CENTRES))
def fixed_center_cluster_stats(spark, sf_dir):
    from seisflow.operators.summaries import cluster_stats
    st = cluster_stats(_region_centre_labels(spark, sf_dir), digits=None)
    return round_cols(st, ["magnitude_mean", "depth_mean"])


@register("pattern_cluster_stats", q(
    "SELECT prediction AS cluster, round_even(round(avg(magnitude), 9), 2) AS magnitude_mean, "
    "round_even(round(min(magnitude), 9), 2) AS magnitude_min, round_even(round(max(magnitude), 9), 2) AS magnitude_max, "
    "count(magnitude) AS magnitude_count, round_even(round(avg(depth), 9), 2) AS depth_mean FROM pts GROUP BY 1", _CENTRES))
def pattern_cluster_stats(spark, sf_dir):
    from seisflow.operators.summaries import group_stats
    labelled = _region_centre_labels(spark, sf_dir).withColumnRenamed("prediction", "cluster")
    return group_stats(labelled, "cluster", {"magnitude": ["mean", "min", "max", "count"], "depth": ["mean"]})


@register("cluster_scatter", q(
    "SELECT id, longitude, latitude, prediction, magnitude * 3e0 AS marker_size FROM pts", _CENTRES))
def cluster_scatter(spark, sf_dir):
    return grids.cluster_points(_region_centre_labels(spark, sf_dir))


# ---------------------------------------------------------------- closed-form regression (H7 unregularised, H9, C24, G14)

_LABEL = "(2e0 + depth * 4e-3 + latitude * 1e-2 + ((event_id * 17) % 10) / 1e2)"


def _with_label(spark, sf_dir):
    cat = catalogue(spark, sf_dir)
    label = (F.lit(2.0) + F.col("depth") * 4e-3 + F.col("latitude") * 1e-2 + ((F.col("event_id") * 17) % 10) / 100.0)
    return cat.withColumn("label_lin", label)


@register("ols_by_depth", q(
    f"SELECT round(regr_slope({_LABEL}, depth), 9) AS slope, round(regr_intercept({_LABEL}, depth), 6) AS intercept, "
    f"round(regr_r2({_LABEL}, depth), 6) AS r2, CAST(regr_count({_LABEL}, depth) AS BIGINT) AS n FROM quakes"))
def ols_by_depth(spark, sf_dir):
    fit = models.linear_fit(_with_label(spark, sf_dir), "label_lin", "depth")
    return fit.select(F.round("slope", 9).alias("slope"), F.round("intercept", 6).alias("intercept"),
                      F.round("r2", 6).alias("r2"), "n")


@register("regression_metrics", q(
    "SELECT round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, "
    "round(1e0 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2, count(*) AS n FROM ("
    f"SELECT {_LABEL} AS y, {_LABEL} - (f.b + f.a * depth) AS e FROM quakes, f "
    f"WHERE {_LABEL} IS NOT NULL AND depth IS NOT NULL) t",
    f"f AS (SELECT regr_slope({_LABEL}, depth) AS a, regr_intercept({_LABEL}, depth) AS b FROM quakes)"))
def regression_metrics(spark, sf_dir):
    df = _with_label(spark, sf_dir)
    fit = models.linear_fit(df, "label_lin", "depth").first()
    scored = (df.where(F.col("label_lin").isNotNull() & F.col("depth").isNotNull())
                .withColumn("pred", F.lit(fit["intercept"]) + F.lit(fit["slope"]) * F.col("depth")))
    m = models.regression_metrics(scored, "label_lin", "pred")
    return round_cols(m, ["rmse", "mae", "r2"])
