"""Gridded magnitude forecast per active zone.

The zone table is tiny (one row per zone), so the grid is generated on the
executors by exploding two ``linspace`` arrays per zone — a generated product
of at most 15 × 15 points per zone, not a join — and every grid point is
scored in one ``transform`` of the fitted model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from seisflow.functions.scalars import cap, clamp_points, confidence_label, linspace
from seisflow.operators.filters import drop_incomplete
from seisflow.operators.models import _fit_placed, forest_pipeline, save_model
from seisflow.operators.zones import active_zones, zone_stats
from seisflow.session import scratch_path

ZONE_RADIUS = 0.3
FORECAST_MIN_MAGNITUDE = 4.0
CAP_FACTOR = 1.2
FORECAST_FEATURES = ["latitude", "longitude", "depth"]
FORECAST_SCHEMA = "latitude double, longitude double, predicted_magnitude double, confidence string, zone int"


def forecast_grid(zones: DataFrame, radius: float = ZONE_RADIUS, min_points: int = 5, max_points: int = 15,
                  depth=None) -> DataFrame:
    """``n × n`` points within ±radius of each zone centre, ``n`` clamped from the zone count.

    ``zones`` needs zone, magnitude_count, magnitude_max, latitude_mean,
    longitude_mean.  ``depth`` (a number or Column) is attached as the depth
    feature of every point.
    """
    n = clamp_points("magnitude_count", min_points, max_points)
    lat, lon = F.col("latitude_mean"), F.col("longitude_mean")
    g = zones.select("zone", "magnitude_count", "magnitude_max", n.alias("n_points"),
                     linspace(lat - radius, lat + radius, n).alias("lats"),
                     linspace(lon - radius, lon + radius, n).alias("lons"))
    g = (g.select("*", F.posexplode("lats").alias("i", "latitude"))
          .select("*", F.posexplode("lons").alias("j", "longitude"))
          .drop("lats", "lons"))
    if depth is not None:
        g = g.withColumn("depth", depth if not isinstance(depth, (int, float)) else F.lit(float(depth)))
    return g


def forecast_table(scored: DataFrame, pred_col: str = "prediction", threshold: float = FORECAST_MIN_MAGNITUDE,
                   cap_factor: float = CAP_FACTOR) -> DataFrame:
    """Cap at 120 % of the zone maximum, keep ≥ threshold, label confidence."""
    pred = cap(F.col(pred_col), F.col("magnitude_max") * cap_factor)
    out = scored.withColumn("predicted_magnitude", pred).where(F.col("predicted_magnitude") >= threshold)
    return out.select("latitude", "longitude", "predicted_magnitude",
                      confidence_label("magnitude_count", "predicted_magnitude", "magnitude_max").alias("confidence"),
                      F.col("zone").cast("int").alias("zone"))


def fit_forecast_model(df: DataFrame, trees: int = 100, max_depth: int = 10, seed: int = 42, partitions: int | None = None):
    """Forest on (latitude, longitude, depth) → magnitude over complete rows.

    Standardising the features first (as the scaled pipeline does) cannot change
    a tree's splits — it is monotone per feature — so the forest is fitted on
    the raw values.
    """
    clean = drop_incomplete(df, FORECAST_FEATURES + ["magnitude"]).select("id", "magnitude", *FORECAST_FEATURES)
    pipeline = forest_pipeline(FORECAST_FEATURES, trees=trees, max_depth=max_depth, seed=seed)
    model, _ = _fit_placed(pipeline, clean, "id", partitions)
    mean_depth = clean.agg(F.avg("depth").alias("d")).first()["d"]
    return model, mean_depth


def predict_future(df: DataFrame, eps: float = 1.0, min_samples: int = 3, order_col: str = "id",
                   trees: int = 100, max_depth: int = 10, seed: int = 42, depth: str = "global",
                   model_path: str | None = None) -> DataFrame:
    """Zones → forest → grid → one scoring pass → forecast rows (empty when no zone).

    ``depth='global'`` scores every point at the mean depth of all complete
    rows; ``depth='zone'`` uses each zone's own mean depth.  The fitted forest
    is kept under ``model_path`` if one is given (A12).
    """
    spark = df.sparkSession
    zoned = active_zones(df, eps=eps, min_samples=min_samples, order_col=order_col)
    path = scratch_path(spark, "zone-stats")
    zone_stats(zoned).write.parquet(path)
    zs = spark.read.parquet(path)
    if zs.isEmpty():
        return spark.createDataFrame([], FORECAST_SCHEMA)
    model, mean_depth = fit_forecast_model(df, trees, max_depth, seed)
    if model_path:
        save_model(model, model_path)
    if depth == "zone":
        zd = (drop_incomplete(zoned, FORECAST_FEATURES + ["magnitude"]).where(F.col("zone") >= 0)
              .groupBy("zone").agg(F.avg("depth").alias("zone_depth")))
        grid = forecast_grid(zs.join(zd, "zone", "left")).withColumn(
            "depth", F.coalesce(F.col("zone_depth"), F.lit(mean_depth))).drop("zone_depth")
    else:
        grid = forecast_grid(zs, depth=mean_depth)
    return forecast_table(model.transform(grid))


def bucket_counts(forecast: DataFrame) -> DataFrame:
    """Forecast rows per right-closed magnitude bucket; empty buckets show 0."""
    from seisflow.functions.display import FORECAST_BUCKETS, forecast_bucket
    spark = forecast.sparkSession
    labels = spark.createDataFrame([(i, lab) for i, (_, _, lab) in enumerate(FORECAST_BUCKETS)],
                                   "bucket_order int, bucket string")
    counts = (forecast.select(forecast_bucket("predicted_magnitude").alias("bucket"))
              .where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.count(F.lit(1)).alias("count")))
    return (labels.join(counts, "bucket", "left").fillna(0, subset=["count"])
            .orderBy("bucket_order").select("bucket", "count"))


def confidence_counts(forecast: DataFrame) -> DataFrame:
    """C17: forecast rows per confidence label, most first."""
    return forecast.groupBy("confidence").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "confidence")
