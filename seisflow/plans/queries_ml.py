"""Registered queries: zones, forecast, models, anomalies.

Zones, the split, k-means by Lloyd steps, components, the linear model, trees grown to the end, the isolation forest and
the forecast have SQL for their rows.  For Spark ML's k-means and forests, whose rows depend on seeded sampling, a row
of invariants is compared with SQL (rows, nearest centres, centres that are means, errors below the constant
predictor's).
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from seisflow.functions.display import fixed, forecast_colour, forecast_markers
from seisflow.functions.scalars import round2
from seisflow.operators import features, forecast, forest, isolation, lloyd, models, zones
from seisflow.operators.filters import drop_incomplete
from seisflow.operators.summaries import anomaly_count, group_stats, mean_abs_error
from seisflow.plans.oracle import q, zones as zone_ctes
from seisflow.plans.registry import catalogue, fitted, register, round_cols
from seisflow.session import scratch_path

# ---------------------------------------------------------------- zones


ZONE_EPS = 0.05


def _zoned(spark, sf_dir):
    def label():
        path = scratch_path(spark, "zoned")
        labelled = zones.active_zones(catalogue(spark, sf_dir), eps=ZONE_EPS, order_col="event_id")
        labelled.select("id", "magnitude", "latitude", "longitude", "zone").write.parquet(path)
        return spark.read.parquet(path)
    return fitted(spark, sf_dir, "zones", label)


@register("zone_labels", q("SELECT id, zone FROM zoned", zone_ctes(ZONE_EPS)))
def zone_labels(spark, sf_dir):
    return _zoned(spark, sf_dir).select("id", "zone")


@register("zone_stats", q(
    "SELECT zone, count(magnitude) AS magnitude_count, round_even(round(avg(magnitude), 9), 2) AS magnitude_mean, "
    "round_even(round(max(magnitude), 9), 2) AS magnitude_max, round_even(round(avg(latitude), 9), 2) AS latitude_mean, "
    "round_even(round(avg(longitude), 9), 2) AS longitude_mean FROM zoned WHERE zone <> -1 GROUP BY zone "
    "HAVING count(magnitude) >= 3", zone_ctes(ZONE_EPS)))
def zone_stats(spark, sf_dir):
    return zones.zone_stats(_zoned(spark, sf_dir))


# ---------------------------------------------------------------- forecast with SQL-expressible zones
# Zones here are groups of complete rows by the number of binary digits of the event number, so their sizes run from a
# few rows to half the table; the predictor is the least-squares line of a label that depends on latitude.  Both come
# from the data, and together they reach every branch: rows below the threshold, capped rows, both labels, all
# buckets and colours, and grids of 5 to 15 points a side.

_ZONES = (
    "clean AS (SELECT * FROM quakes WHERE magnitude IS NOT NULL AND longitude IS NOT NULL "
    "AND latitude IS NOT NULL AND depth IS NOT NULL), "
    f"zs AS (SELECT length(bin(event_id)) AS zone, count(magnitude) AS magnitude_count, round_even(round(max(magnitude), 9), 2) AS magnitude_max, "
    "round_even(round(avg(latitude), 9), 2) AS latitude_mean, round_even(round(avg(longitude), 9), 2) AS longitude_mean "
    "FROM clean GROUP BY 1 HAVING count(magnitude) >= 3), "
    "g AS (SELECT *, least(15, greatest(5, CAST(trunc(magnitude_count / 2) AS INTEGER))) AS n_points FROM zs), "
    "gi AS (SELECT *, unnest(range(n_points)) AS i FROM g), "
    "gij AS (SELECT *, unnest(range(n_points)) AS j FROM gi), "
    "grid AS (SELECT zone, magnitude_count, magnitude_max, "
    "CASE WHEN i = n_points - 1 THEN latitude_mean + 3e-1 ELSE i * (((latitude_mean + 3e-1) - (latitude_mean - 3e-1)) "
    "/ (n_points - 1)) + (latitude_mean - 3e-1) END AS latitude, "
    "CASE WHEN j = n_points - 1 THEN longitude_mean + 3e-1 ELSE j * (((longitude_mean + 3e-1) - (longitude_mean - 3e-1)) "
    "/ (n_points - 1)) + (longitude_mean - 3e-1) END AS longitude FROM gij), "
    "fit AS (SELECT regr_slope(v, latitude) AS a, regr_intercept(v, latitude) AS b FROM "
    "(SELECT latitude, 5e0 + latitude * 3e-1 + ((event_id * 17) % 10) / 1e2 AS v FROM clean)), "
    "scored AS (SELECT grid.*, least(fit.b + fit.a * latitude, magnitude_max * 1.2e0) AS predicted_magnitude "
    "FROM grid, fit), "
    "fc AS (SELECT latitude, longitude, predicted_magnitude, CASE WHEN magnitude_count > 10 AND "
    "predicted_magnitude <= magnitude_max THEN 'High' ELSE 'Medium' END AS confidence, CAST(zone AS INTEGER) AS zone "
    "FROM scored WHERE predicted_magnitude >= 4e0)")


def _digit_zones(spark, sf_dir):
    clean = drop_incomplete(catalogue(spark, sf_dir), ["magnitude", "longitude", "latitude", "depth"])
    zs = (clean.withColumn("zone", F.length(F.bin("event_id"))).groupBy("zone")
          .agg(F.count("magnitude").alias("magnitude_count"), round2(F.max("magnitude")).alias("magnitude_max"),
               round2(F.avg("latitude")).alias("latitude_mean"), round2(F.avg("longitude")).alias("longitude_mean"))
          .where(F.col("magnitude_count") >= 3))
    return clean, zs


def _stand_in_forecast(spark, sf_dir):
    clean, zs = _digit_zones(spark, sf_dir)
    label = F.lit(5.0) + F.col("latitude") * 0.3 + ((F.col("event_id") * 17) % 10) / 100.0
    fit = models.linear_fit(clean.withColumn("v", label), "v", "latitude").first()
    grid = forecast.forecast_grid(zs)
    scored = grid.withColumn("prediction", F.lit(fit["intercept"]) + F.lit(fit["slope"]) * F.col("latitude"))
    return forecast.forecast_table(scored)


@register("forecast_grid", q(
    "SELECT zone, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude FROM grid", _ZONES))
def forecast_grid(spark, sf_dir):
    _, zs = _digit_zones(spark, sf_dir)
    g = forecast.forecast_grid(zs).select("zone", "latitude", "longitude")
    return g.select("zone", F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"))


@register("forecast_table", q(
    "SELECT round(latitude, 9) AS latitude, round(longitude, 9) AS longitude, "
    "round(predicted_magnitude, 6) AS predicted_magnitude, confidence, zone FROM fc", _ZONES))
def forecast_table(spark, sf_dir):
    t = _stand_in_forecast(spark, sf_dir)
    return t.select(F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"),
                    F.round("predicted_magnitude", 6).alias("predicted_magnitude"), "confidence", "zone")


@register("forecast_buckets", q(
    "SELECT b.bucket, coalesce(c.n, 0) AS \"count\" FROM (VALUES ('4.0-4.9'), ('5.0-5.9'), ('6.0+')) b(bucket) "
    "LEFT JOIN (SELECT CASE WHEN predicted_magnitude > 4e0 AND predicted_magnitude <= 5e0 THEN '4.0-4.9' "
    "WHEN predicted_magnitude > 5e0 AND predicted_magnitude <= 6e0 THEN '5.0-5.9' "
    "WHEN predicted_magnitude > 6e0 THEN '6.0+' END AS bucket, count(*) AS n FROM fc GROUP BY 1) c "
    "ON b.bucket = c.bucket", _ZONES))
def forecast_buckets(spark, sf_dir):
    return forecast.bucket_counts(_stand_in_forecast(spark, sf_dir))


@register("forecast_confidence", q(
    "SELECT confidence, count(*) AS \"count\" FROM fc GROUP BY 1 ORDER BY 2 DESC, 1", _ZONES))
def forecast_confidence(spark, sf_dir):
    return forecast.confidence_counts(_stand_in_forecast(spark, sf_dir))


_COLOUR = ("CASE WHEN confidence = 'High' THEN "
    "(CASE WHEN predicted_magnitude >= 6e0 THEN 'red' WHEN predicted_magnitude >= 5e0 THEN 'orange' ELSE 'yellow' END) "
    "ELSE (CASE WHEN predicted_magnitude >= 6e0 THEN 'lightred' WHEN predicted_magnitude >= 5e0 THEN 'lightorange' "
    "ELSE 'lightyellow' END) END")


@register("forecast_colours", q(
    f"SELECT round(latitude, 9) AS latitude, round(longitude, 9) AS longitude, {_COLOUR} AS colour, "
    "printf('%.1f', predicted_magnitude) AS magnitude_text, zone FROM fc", _ZONES))
def forecast_colours(spark, sf_dir):
    t = _stand_in_forecast(spark, sf_dir)
    return t.select(F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"),
                    forecast_colour().alias("colour"), fixed("predicted_magnitude", 1).alias("magnitude_text"), "zone")


@register("forecast_markers", q(
    f"SELECT round(latitude, 9) AS latitude, round(longitude, 9) AS longitude, 8 AS radius, {_COLOUR} AS color, "
    "'<strong>Predicted Magnitude:</strong> ' || printf('%.1f', predicted_magnitude) || '<br><strong>Confidence:</strong> ' || confidence "
    "|| '<br><strong>Zone:</strong> ' || CAST(zone AS VARCHAR) AS popup FROM fc", _ZONES))
def forecast_markers_q(spark, sf_dir):
    t = forecast_markers(_stand_in_forecast(spark, sf_dir))
    return t.select(F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"), "radius", "color", "popup")


@register("forecast_full")
def forecast_full(spark, sf_dir):
    return forecast.predict_future(catalogue(spark, sf_dir), order_col="event_id", trees=100, max_depth=10)


# ---------------------------------------------------------------- Spark ML models


def _kmeans(spark, sf_dir):
    return fitted(spark, sf_dir, "kmeans", lambda: models.kmeans_raw(catalogue(spark, sf_dir), k=5, seed=42))


_COMPLETE = ("complete AS (SELECT * FROM quakes WHERE magnitude IS NOT NULL AND longitude IS NOT NULL "
             "AND latitude IS NOT NULL AND depth IS NOT NULL)")




def _lloyd_sql(source: str, cols, steps: int, k: int = 5) -> str:
    """CTEs ``lc`` (centres) and ``la`` (rows of ``source`` with c): Lloyd steps one after the other."""
    keys = ", ".join(cols)
    far = " + ".join(f"({{0}}.{c} - k.{c}) ** 2" for c in cols)
    ctes = [f"pl AS MATERIALIZED (SELECT {keys}, count(*) AS n, min(md5(id || ':42')) AS h FROM {source} GROUP BY {keys})",
            f"k0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, {keys} FROM (FROM pl ORDER BY h LIMIT {k}))"]
    for i in range(steps):
        mean = ", ".join(f"coalesce(any_value(m{c}), any_value(k.{c})) AS {c}" for c in cols)
        ctes.append(f"""k{i + 1} AS MATERIALIZED (SELECT k.c, {mean} FROM k{i} k LEFT JOIN (SELECT c, {', '.join(f'sum({c} * n) / sum(n) AS m{c}' for c in cols)} FROM
 (SELECT any_value(p.n) AS n, {', '.join(f'any_value(p.{c}) AS {c}' for c in cols)}, min(struct_pack(d := {far.format('p')}, c := k.c)).c AS c FROM pl p, k{i} k GROUP BY h) GROUP BY c) a ON a.c = k.c GROUP BY k.c)""")
    ctes.append(f"lc AS (SELECT CAST(c AS INTEGER) AS c, {keys} FROM k{steps})")
    ctes.append(f"la AS MATERIALIZED (SELECT s.id, min(struct_pack(d := {far.format('s')}, c := k.c)).c AS c, {', '.join(f'any_value(s.{c}) AS {c}' for c in cols)} FROM {source} s, lc k GROUP BY s.id)")
    return ", ".join(ctes)


_RAW, RAW_STEPS, SCALED_STEPS = features.CLUSTER_FEATURES, 20, 60


def _lloyd(spark, sf_dir):
    def fit():
        rows = drop_incomplete(catalogue(spark, sf_dir), _RAW)
        model = lloyd.fit_lloyd(rows, _RAW, "id", 5, 42, RAW_STEPS)
        return model, lloyd.silhouette(model.transform(rows), _RAW)
    return fitted(spark, sf_dir, "lloyd", fit)


@register("kmeans_raw", q("SELECT id, magnitude, longitude, latitude, depth, c AS prediction FROM la", _COMPLETE + ", " + _lloyd_sql("complete", _RAW, RAW_STEPS)))
def kmeans_raw(spark, sf_dir):
    model, _ = _lloyd(spark, sf_dir)
    return models.clustered_table(model.transform(drop_incomplete(catalogue(spark, sf_dir), _RAW)))


_X2 = " + ".join(f"{c} * {c}" for c in _RAW)
_SILHOUETTE = (", ss AS (SELECT c, count(*) AS n, sum(" + _X2 + ") AS q, " + ", ".join(f"sum({c}) AS s_{c}" for c in _RAW) + " FROM la GROUP BY c), "
               "si AS (SELECT la.id, la.c, ss.c AS o, (" + "(" + " + ".join(f"la.{c} * la.{c}" for c in _RAW) + ") * ss.n + q - 2 * (" + " + ".join(f"la.{c} * s_{c}" for c in _RAW) + ")) "
               "/ CASE WHEN la.c = ss.c THEN greatest(n - 1, 1) ELSE n END AS d, n FROM la, ss), "
               "sr AS (SELECT id, any_value(n) FILTER (o = c) AS own, min(d) FILTER (o = c) AS a, min(d) FILTER (o <> c) AS b FROM si GROUP BY id), "
               "sv AS (SELECT avg(CASE WHEN own = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) AS silhouette FROM sr)")


@register("kmeans_summary", q("SELECT lc.c AS prediction, round(magnitude, 6) AS magnitude, round(longitude, 6) AS longitude, round(latitude, 6) AS latitude, round(depth, 6) AS depth, "
                              "ss.n AS \"count\", round(silhouette, 6) AS silhouette FROM lc LEFT JOIN ss ON ss.c = lc.c, sv", _COMPLETE + ", " + _lloyd_sql("complete", _RAW, RAW_STEPS) + _SILHOUETTE))
def kmeans_summary(spark, sf_dir):
    model, silhouette = _lloyd(spark, sf_dir)
    sizes = model.transform(drop_incomplete(catalogue(spark, sf_dir), _RAW)).groupBy("prediction").agg(F.count(F.lit(1)).alias("count"))
    return round_cols(model.table(spark).join(sizes, "prediction", "left").withColumn("silhouette", F.lit(float(silhouette))), [*_RAW, "silhouette"])


_PATTERN = features.PATTERN_FEATURES
_Z = ("zs AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in _PATTERN) + " FROM complete), "
      "zc AS MATERIALIZED (SELECT id, " + ", ".join(f"({c} - m_{c}) / d_{c} AS {c}_z" for c in _PATTERN) + ", " + ", ".join(_PATTERN) + " FROM complete, zs)")


@register("kmeans_scaled", q(
    "SELECT c AS cluster, round_even(round(avg(zc.magnitude), 9), 2) AS magnitude_mean, min(zc.magnitude) AS magnitude_min, max(zc.magnitude) AS magnitude_max, "
    "count(zc.magnitude) AS magnitude_count, round_even(round(avg(zc.depth), 9), 2) AS depth_mean FROM la JOIN zc ON zc.id = la.id GROUP BY c",
    _COMPLETE + ", " + _Z + ", " + _lloyd_sql("zc", [f"{c}_z" for c in _PATTERN], SCALED_STEPS)))
def kmeans_scaled(spark, sf_dir):
    z, _ = features.standardize(catalogue(spark, sf_dir), _PATTERN)
    model = lloyd.fit_lloyd(z, [f"{c}_z" for c in _PATTERN], "id", 5, 42, SCALED_STEPS)
    return group_stats(model.transform(z, "cluster"), "cluster", {"magnitude": ["mean", "min", "max", "count"], "depth": ["mean"]})


@register("kmeans_invariants", q(
    "SELECT count(*) AS \"rows\", count(*) AS at_nearest, 5 AS clusters, TRUE AS centres_are_means, TRUE AS silhouette_in_range "
    "FROM complete", _COMPLETE))
def kmeans_invariants(spark, sf_dir):
    """H2-H6: every complete row has the cluster of its nearest centre, and centres settle near their rows' means."""
    _, pred, silhouette, centers = _kmeans(spark, sf_dir)
    cols = ["magnitude", "longitude", "latitude", "depth"]
    fixed_centers = [[r[c] for c in cols] for r in centers.orderBy("prediction").collect()]
    rows = models.clustered_table(pred)
    rows = rows.withColumn("near", models.nearest_center(cols, fixed_centers))
    means = rows.groupBy("prediction").agg(*[F.avg(c).alias(f"m_{c}") for c in cols])
    off = means.join(centers, "prediction").agg(F.max(F.greatest(*[F.abs(F.col(f"m_{c}") - F.col(c)) for c in cols])).alias("off"),
                                                F.count(F.lit(1)).alias("clusters"))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("near") == F.col("prediction")).alias("at_nearest")).join(
        off.select(F.col("clusters").cast("int").alias("clusters"), (F.col("off") < 5.0).alias("centres_are_means"))).withColumn(
        "silhouette_in_range", F.lit(-1.0 <= silhouette <= 1.0))


def _pca(spark, sf_dir):
    return fitted(spark, sf_dir, "pca", lambda: models.pca_components(catalogue(spark, sf_dir), k=2))


def _jacobi_sql(sweeps: int = 8) -> str:
    """CTEs ``jv``: eigenvalues and vectors of the features' correlations, largest first, by rotations one after the other."""
    d = len(_PATTERN)
    at = lambda i, j: f"a{min(i, j)}{max(i, j)}"
    first = ", ".join(f"covar_pop({_PATTERN[i]}_z, {_PATTERN[j]}_z) AS {at(i, j)}" for i in range(d) for j in range(i, d))
    unit = ", ".join(f"CAST({int(i == j)} AS DOUBLE) AS v{i}{j}" for i in range(d) for j in range(d))
    ctes, n = [f"j0 AS MATERIALIZED (SELECT {first}, {unit} FROM zc)"], 0
    for p, r in [(p, r) for _ in range(sweeps) for p in range(d) for r in range(p + 1, d)]:
        new = {at(p, p): f"{at(p, p)} - t * {at(p, r)}", at(r, r): f"{at(r, r)} + t * {at(p, r)}", at(p, r): "0e0"}
        for i in range(d):
            if i not in (p, r):
                new[at(i, p)], new[at(i, r)] = f"co * {at(i, p)} - si * {at(i, r)}", f"si * {at(i, p)} + co * {at(i, r)}"
        for i in range(d):
            new[f"v{i}{p}"], new[f"v{i}{r}"] = f"co * v{i}{p} - si * v{i}{r}", f"si * v{i}{p} + co * v{i}{r}"
        names = [at(i, j) for i in range(d) for j in range(i, d)] + [f"v{i}{j}" for i in range(d) for j in range(d)]
        theta = f"(({at(r, r)} - {at(p, p)}) / (2 * {at(p, r)}))"
        tan = f"CASE WHEN {at(p, r)} = 0 THEN 0e0 ELSE (CASE WHEN {theta} < 0 THEN -1e0 ELSE 1e0 END) / (abs({theta}) + sqrt({theta} ** 2 + 1)) END"
        ctes.append(f"j{n + 1} AS MATERIALIZED (SELECT {', '.join(f'{new.get(c, c)} AS {c}' for c in names)} FROM (SELECT *, 1 / sqrt(t ** 2 + 1) AS co, t / sqrt(t ** 2 + 1) AS si FROM (SELECT *, {tan} AS t FROM j{n})))")
        n += 1
    rows = " UNION ALL ".join(f"SELECT {at(i, i)} AS ev, " + ", ".join(f"v{j}{i} AS w{j}" for j in range(d)) + f" FROM j{n}" for i in range(d))
    big = "greatest(" + ", ".join(f"abs(w{j})" for j in range(d)) + ")"
    sign = "CASE " + " ".join(f"WHEN abs(w{j}) = {big} THEN sign(w{j})" for j in range(d)) + " END"
    ctes.append(f"jv AS MATERIALIZED (SELECT row_number() OVER (ORDER BY ev DESC) AS component, ev / sum(ev) OVER () AS ratio, {', '.join(f'w{j} * {sign} AS w{j}' for j in range(d))} FROM ({rows}))")
    return ", ".join(ctes)


_EIGEN = _COMPLETE + ", " + _Z + ", " + _jacobi_sql()
_SCORE = " + ".join(f"{c}_z * {{0}}.w{j}" for j, c in enumerate(_PATTERN))


@register("pca_components", q(f"SELECT id, round({_SCORE.format('x')}, 6) AS pca1, round({_SCORE.format('y')}, 6) AS pca2 FROM zc, jv x, jv y WHERE x.component = 1 AND y.component = 2", _EIGEN))
def pca_components(spark, sf_dir):
    out, _ = _pca(spark, sf_dir)
    return round_cols(out.select("id", "pca1", "pca2"), ["pca1", "pca2"])


@register("pca_variance", q("SELECT CAST(component AS INTEGER) AS component, round(ratio, 9) AS explained_variance_ratio FROM jv WHERE component <= 2", _EIGEN))
def pca_variance(spark, sf_dir):
    _, ratio = _pca(spark, sf_dir)
    return spark.createDataFrame([(i + 1, round(float(r), 9)) for i, r in enumerate(ratio)],
                                 "component int, explained_variance_ratio double")


# The label depends on depth (R² about 0.8), so the fit is one that the penalty does not empty.
def _label():
    return F.lit(2.0) + F.col("depth") * 4e-3 + F.col("latitude") * 1e-2 + ((F.col("event_id") * 17) % 10) / 100.0


_SPLIT = ("complete AS (SELECT *, 2e0 + depth * 4e-3 + latitude * 1e-2 + ((event_id * 17) % 10) / 1e2 AS label_lin, "
          "CASE WHEN CAST('0x' || substr(md5(id || ':42'), 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS split "
          "FROM quakes WHERE latitude IS NOT NULL AND depth IS NOT NULL)")
# The penalty (reg 0.1, l1 share 0.8) in units of the deviations, and sweeps over the three coefficients.
_GRAM = ", ".join(f"covar_pop({a}, {b}) / any_value(s_{a} * s_{b}) AS g{i}{j}" for i, a in enumerate(["latitude", "longitude", "depth"], 1) for j, b in enumerate(["latitude", "longitude", "depth"], 1) if i < j)
_STEP = "sign({0}) * greatest(abs({0}) - l1, 0) / (g + l2)"
_ENET = (_SPLIT.replace("AND depth IS NOT NULL", "AND longitude IS NOT NULL AND depth IS NOT NULL") + ", sd AS (SELECT "
         + ", ".join(f"stddev_pop({c}) AS s_{c}" for c in ("latitude", "longitude", "depth", "label_lin")) + " FROM complete WHERE split = 'train'), "
         "mo AS MATERIALIZED (SELECT 1e0 AS g, " + _GRAM + ", " + ", ".join(f"covar_pop({c}, label_lin) / any_value(s_{c} * s_label_lin) AS r{i}" for i, c in enumerate(("latitude", "longitude", "depth"), 1))
         + ", " + ", ".join(f"any_value(s_{c}) AS s{i}, avg({c}) AS m{i}" for i, c in enumerate(("latitude", "longitude", "depth", "label_lin"), 1))
         + ", 8e-2 / any_value(s_label_lin) AS l1, 2e-2 / any_value(s_label_lin) AS l2 FROM complete, sd WHERE split = 'train'), "
         "be AS MATERIALIZED (WITH RECURSIVE cd AS (SELECT 0 AS k, 0e0 AS b1, 0e0 AS b2, 0e0 AS b3 UNION ALL "
         "SELECT k + 1, n1, n2, " + _STEP.format("(r3 - g13 * n1 - g23 * n2)") + " FROM (SELECT *, " + _STEP.format("(r2 - g12 * n1 - g23 * b3)") + " AS n2 FROM (SELECT *, "
         + _STEP.format("(r1 - g12 * b2 - g13 * b3)") + " AS n1 FROM cd, mo)) WHERE k < 200) SELECT b1, b2, b3 FROM cd WHERE k = 200), "
         "en AS (SELECT b1 * s4 / s1 AS c1, b2 * s4 / s2 AS c2, b3 * s4 / s3 AS c3, m4 - m1 * b1 * s4 / s1 - m2 * b2 * s4 / s2 - m3 * b3 * s4 / s3 AS c0 FROM be, mo)")


def _enet(spark, sf_dir):
    df = catalogue(spark, sf_dir).withColumn("label_lin", _label())
    return fitted(spark, sf_dir, "enet", lambda: models.elastic_net(df, label="label_lin"))


@register("elastic_net", q("SELECT id, round(label_lin, 6) AS label_lin, round(c0 + c1 * latitude + c2 * longitude + c3 * depth, 6) AS prediction FROM complete, en WHERE split = 'test'", _ENET))
def elastic_net(spark, sf_dir):
    _, test, _ = _enet(spark, sf_dir)
    return round_cols(test.select("id", "label_lin", "prediction"), ["label_lin", "prediction"])


@register("elastic_net_coefficients", q("SELECT round(c1, 9) AS c_latitude, round(c2, 9) AS c_longitude, round(c3, 9) AS c_depth, round(c0, 6) AS intercept FROM en", _ENET))
def elastic_net_coefficients(spark, sf_dir):
    model, _, _ = _enet(spark, sf_dir)
    return catalogue(spark, sf_dir).limit(1).select(*[F.round(F.lit(b), 9).alias(f"c_{c}") for c, b in zip(model.features, model.coefficients)],
                                                    F.round(F.lit(model.intercept), 6).alias("intercept"))


@register("elastic_net_metrics", q(
    "SELECT split, count(*) AS n, round(sqrt(avg((label_lin - p) ** 2)), 6) AS rmse, round(avg(abs(label_lin - p)), 6) AS mae, "
    "round(1 - sum((label_lin - p) ** 2) / (var_pop(label_lin) * count(*)), 6) AS r2 "
    "FROM (SELECT complete.*, c0 + c1 * latitude + c2 * longitude + c3 * depth AS p FROM complete, en) GROUP BY split", _ENET))
def elastic_net_metrics(spark, sf_dir):
    _, _, metrics = _enet(spark, sf_dir)
    return metrics.select("split", "n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


def _forest(spark, sf_dir):
    return fitted(spark, sf_dir, "forest", lambda: models.forest_magnitude(
        catalogue(spark, sf_dir), trees=100, max_depth=10)[1])


@register("forest_magnitude")
def forest_magnitude(spark, sf_dir):
    """H14 by Spark ML, with trees of bounded depth; ``tree_to_the_end`` and ``forest_in_bag`` grow to the end."""
    return _forest(spark, sf_dir).select("id", "magnitude", "predicted_magnitude", "magnitude_error")


@register("forest_error")
def forest_error(spark, sf_dir):
    return mean_abs_error(_forest(spark, sf_dir))


# A single tree on all rows, grown to the end, gives every row the mean label of the rows at its place.
@register("tree_to_the_end", q("SELECT id, round(avg(magnitude) OVER (PARTITION BY latitude, longitude, depth), 6) AS prediction FROM complete", _COMPLETE))
def tree_to_the_end(spark, sf_dir):
    rows = drop_incomplete(catalogue(spark, sf_dir), _RAW).select("id", *_RAW)
    got = forest.forest_predictions(rows, features.LOCATION_FEATURES, "magnitude", trees=1, bootstrap=False, finish=5000)
    return got.select("id", F.round("prediction", 6).alias("prediction"))


# In a tree that drew it, a row has the weighted mean of the rows at its place: the draws are a hash, so SQL knows them.
_DRAWS, _TREES = "least(" + " + ".join(f"CAST(u >= {p!r} AS INTEGER)" for p in forest._POISSON) + ", 99)", 8


@register("forest_in_bag", q(
    f"SELECT tree, id, round(sum(w * magnitude) OVER p / sum(w) OVER p, 6) AS prediction FROM (SELECT *, {_DRAWS} AS w FROM (SELECT complete.*, tree, "
    f"('0x' || md5(id || ':' || tree || ':42')[1:13])::BIGINT / {float(1 << 52)!r}::DOUBLE AS u FROM complete, range({_TREES}) r(tree))) "
    "WINDOW p AS (PARTITION BY tree, latitude, longitude, depth) QUALIFY w > 0", _COMPLETE))
def forest_in_bag(spark, sf_dir):
    rows = drop_incomplete(catalogue(spark, sf_dir), _RAW).select("id", *_RAW)
    drawn = forest.drawn_places(rows, features.LOCATION_FEATURES, "magnitude", "id", _TREES, 42)
    per_tree = forest.tree_predictions(drawn, features.LOCATION_FEATURES)
    own = forest.drawn_rows(rows, features.LOCATION_FEATURES, "magnitude", "id", _TREES, 42).where("w > 0").select(F.col("tree").cast("long").alias("tree"), F.col("__key").alias("id"), "place")
    return own.join(per_tree.withColumn("tree", F.col("tree").cast("long")), ["tree", "place"]).select("tree", "id", F.round("prediction", 6).alias("prediction"))


@register("forest_invariants", q(
    "SELECT count(*) AS \"rows\", TRUE AS below_constant FROM complete", _SPLIT + ", z AS (SELECT 1)"))
def forest_invariants(spark, sf_dir):
    """On a label that depends on the features the forest beats the constant predictor by far."""
    df = catalogue(spark, sf_dir).where("latitude IS NOT NULL").withColumn("label_lin", _label()).withColumn("longitude", F.coalesce("longitude", F.lit(0.0)))
    _, out = models.forest_magnitude(df, trees=20, max_depth=8, label="label_lin")
    got = out.agg(F.count(F.lit(1)).alias("rows"), F.avg("magnitude_error").alias("mae"), F.stddev_pop("label_lin").alias("sd"))
    return got.select("rows", (F.col("mae") < 0.3 * F.col("sd")).alias("below_constant"))


@register("hash_split", q(
    "SELECT id, CASE WHEN CAST('0x' || substr(md5(id || ':42'), 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM quakes"))
def hash_split(spark, sf_dir):
    return features.hash_split(catalogue(spark, sf_dir), "id", 80, 42).select("id", "split")


# ---------------------------------------------------------------- anomalies


def _anomalies(spark, sf_dir):
    return fitted(spark, sf_dir, "anomalies", lambda: isolation.detect_anomalies(
        catalogue(spark, sf_dir), contamination=0.1, key="id"))


def _isolation_sql(trees: int = 100, psi: int = 256, seed: int = 42, contamination: float = 0.1) -> str:
    """CTEs that end in ``an`` (id, score, label): each tree's sample by hash rank, splits by hashes of the node, a level after the other."""
    zs = [f"{c}_z" for c in _PATTERN]
    unit = lambda text: f"(('0x' || md5({text})[1:13])::BIGINT / {float(1 << 52)!r}::DOUBLE)"
    in_pool, in_tree = unit(f"id || ':{seed}'"), unit(f"id || ':{seed}:' || tree")
    ctes = [f"pn AS (SELECT least({psi}, count(*)) AS psi, CAST(ceil(log2(greatest(least({psi}, count(*)), 2))) AS INTEGER) AS deep, "
            f"least(1e0, {2 * trees}::DOUBLE * least({psi}, count(*)) / greatest(count(*), 1)) AS rate FROM zc)",
            f"sm0 AS MATERIALIZED (SELECT tree, 1::BIGINT AS node, {', '.join(zs)} FROM (SELECT zc.*, tree, row_number() OVER (PARTITION BY tree ORDER BY {in_tree}, id) AS rk "
            f"FROM zc, pn, range({trees}) r(tree) WHERE {in_pool} < rate), pn WHERE rk <= psi)",
            f"rt0 AS MATERIALIZED (SELECT id, tree, 1::BIGINT AS node, 0::BIGINT AS size, 0 AS depth, {', '.join(zs)} FROM zc, range({trees}) r(tree))"]
    depth = int(math.ceil(math.log2(psi)))
    cols = lambda a: ", ".join(f"{a}.{z}" for z in zs)
    side = lambda a: f"CASE WHEN [{cols(a)}][s.f + 1] < s.at THEN 0 ELSE 1 END"
    varying = "list_filter([" + ", ".join(f"CASE WHEN max({z}) > min({z}) THEN {i} ELSE -1 END" for i, z in enumerate(zs)) + "], lambda x: x >= 0)"
    lows, highs = "[" + ", ".join(f"min({z})" for z in zs) + "]", "[" + ", ".join(f"max({z})" for z in zs) + "]"
    by_node = lambda what: unit(f"'{seed}:' || tree || ':' || node || ':{what}'")
    for k in range(depth + 1):
        ctes.append(f"sp{k} AS MATERIALIZED (SELECT tree, node, size, f, CASE WHEN f >= 0 THEN lo[f + 1] + {by_node('threshold')} * (hi[f + 1] - lo[f + 1]) END AS at FROM "
                    f"(SELECT *, CASE WHEN len(us) = 0 OR {k} >= deep THEN -1 ELSE us[CAST(floor({by_node('feature')} * len(us)) AS BIGINT) + 1] END AS f FROM "
                    f"(SELECT tree, node, count(*) AS size, {varying} AS us, {lows} AS lo, {highs} AS hi FROM sm{k} GROUP BY tree, node), pn))")
        if k < depth:
            ctes.append(f"sm{k + 1} AS MATERIALIZED (SELECT m.tree, 2 * m.node + {side('m')} AS node, {cols('m')} FROM sm{k} m JOIN sp{k} s ON s.tree = m.tree AND s.node = m.node WHERE s.f >= 0)")
        # A row that reached a leaf keeps the leaf's size and depth; its node is null from then on.
        ctes.append(f"rt{k + 1} AS MATERIALIZED (SELECT r.id, r.tree, CASE WHEN s.f >= 0 THEN 2 * r.node + {side('r')} END AS node, CASE WHEN s.f = -1 THEN s.size ELSE r.size END AS size, "
                    f"CASE WHEN s.f = -1 THEN {k} ELSE r.depth END AS depth, {cols('r')} FROM rt{k} r LEFT JOIN sp{k} s ON s.tree = r.tree AND s.node = r.node)")
    path = lambda n: f"CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + {isolation.EULER_GAMMA}::DOUBLE) - 2 * ({n} - 1) / {n}::DOUBLE WHEN {n} = 2 THEN 1e0 ELSE 0e0 END"
    ctes.append(f"sc AS MATERIALIZED (SELECT id, round(pow(2e0, -avg(depth + {path('size')}) / any_value({path('psi')})), 12) AS score FROM rt{depth + 1}, pn GROUP BY id)")
    ctes.append(f"an AS (SELECT id, score, CASE WHEN -score < (SELECT quantile_cont(-score, {contamination}) FROM sc) THEN -1 ELSE 1 END AS label FROM sc)")
    return ", ".join(ctes)


_ISOLATION = _COMPLETE + ", " + _Z + ", " + _isolation_sql()


@register("anomalies", q("SELECT id, round(score, 8) AS anomaly_score, label AS is_anomaly FROM an", _ISOLATION))
def anomalies(spark, sf_dir):
    return _anomalies(spark, sf_dir).select("id", F.round("anomaly_score", 8).alias("anomaly_score"), "is_anomaly")


@register("anomaly_rows", q("SELECT an.id, magnitude, depth, latitude, longitude FROM an JOIN complete ON complete.id = an.id WHERE label = -1", _ISOLATION))
def anomaly_rows(spark, sf_dir):
    out = _anomalies(spark, sf_dir)
    return out.where(F.col("is_anomaly") == -1).select("id", "magnitude", "depth", "latitude", "longitude")


@register("anomaly_count", q("SELECT count(*) FILTER (label = -1) AS anomalies, count(*) AS \"rows\" FROM an", _ISOLATION))
def anomaly_count_q(spark, sf_dir):
    return anomaly_count(_anomalies(spark, sf_dir))


@register("anomaly_invariants", q(
    "SELECT count(*) AS \"rows\", TRUE AS share_below, TRUE AS scores_separate FROM complete", _COMPLETE))
def anomaly_invariants(spark, sf_dir):
    """Every complete row is labelled; the -1 rows are the highest scores, those below the tenth's order statistic."""
    out = _anomalies(spark, sf_dir).groupBy("is_anomaly").agg(F.count(F.lit(1)).alias("n"), F.min("anomaly_score").alias("lo"), F.max("anomaly_score").alias("hi"))
    low = F.col("is_anomaly") == -1
    got = out.agg(F.sum("n").alias("rows"), F.sum(F.when(low, F.col("n"))).alias("odd"), F.min(F.when(low, F.col("lo"))).alias("lo"), F.max(F.when(~low, F.col("hi"))).alias("hi"))
    return got.select("rows", ((F.col("odd") <= F.floor(0.1 * (F.col("rows") - 1)) + 1) & (F.col("odd") >= 0.08 * F.col("rows"))).alias("share_below"), (F.col("lo") > F.col("hi")).alias("scores_separate"))
