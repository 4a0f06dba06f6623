"""Multi-output jobs (A7, A10, H21, H22): each derives its outputs by pruned reads of its base."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from seisflow.functions.display import MAP_BANDS, forecast_markers, marker_radius, popup_text, severity_band
from seisflow.operators import cube, filters, forecast, grids, isolation, models, regions, summaries
from seisflow.schema import schema_report
from seisflow.sources.catalogue import EmptyInputError, read_catalogue_parquet, write_catalogue_csv, write_catalogue_parquet
from seisflow.sources.geojson import read_feed


def collect_and_save(spark: SparkSession, feed_path: str, out_path: str, start, end, min_magnitude: float = 0.0,
                     fmt: str = "parquet") -> int:
    """Landed feed → flat catalogue → range filter → CSV or Parquet; returns rows written.

    The row count is observed during the write (no second scan); nothing is
    written when the range is empty.
    """
    rows = filters.range_query(read_feed(spark, feed_path, line_delimited=True), start, end, min_magnitude)
    if rows.isEmpty():
        raise EmptyInputError("no events in range: nothing written")
    obs = Observation("written")
    rows = rows.observe(obs, F.count(F.lit(1)).alias("n"))
    if fmt == "csv":
        write_catalogue_csv(rows, out_path)
    else:
        write_catalogue_parquet(rows, out_path, partition_by="date")
    return int(obs.get["n"])


def save_processed(df: DataFrame, out: str, region_mode: str = "first") -> dict:
    """A10: events (partitioned by date), events with region, region summary, daily and hourly series."""
    spark = df.sparkSession
    paths = {
        "events": out,
        "regions": f"{out}_regions",
        "region_summary": f"{out}_region_summary",
        "daily": f"{out}_daily",
        "hourly": f"{out}_hourly",
    }
    write_catalogue_parquet(df, paths["events"], partition_by="date")
    # Everything else is derived from the written table: pruned scans instead of a cached copy of the catalogue.
    base = read_catalogue_parquet(spark, paths["events"])
    regions.with_region(base, region_mode).write.mode("overwrite").parquet(paths["regions"])
    regions.region_summary(base, region_mode).write.mode("overwrite").parquet(paths["region_summary"])
    summaries.daily_series(base).write.mode("overwrite").parquet(paths["daily"])
    summaries.hourly_series(base).write.mode("overwrite").parquet(paths["hourly"])
    return paths


def basic_report(df: DataFrame) -> dict:
    """The basic analysis as named frames (C1-C5, B17, B18, E3); the summaries come from one reading."""
    made = cube.tables(cube.written_cube(df))
    return {
        "schema": schema_report(df),
        "sample": filters.sample_rows(df, 5),
        **{item: made[item] for item in ("describe", "magnitude_classes", "top_places", "depth_by_class", "hours")},
    }


def spark_analysis(df: DataFrame, k: int = 5, seed: int = 42) -> dict:
    """Basic report plus k-means with its clustered table."""
    out = basic_report(df)
    _, pred, silhouette, centers = models.kmeans_raw(df, k=k, seed=seed)
    out.update({"clustered": models.clustered_table(pred), "centers": centers,
                "cluster_sizes": summaries.cluster_sizes(pred)})
    out["silhouette"] = df.sparkSession.createDataFrame([(float(silhouette),)], "silhouette double")
    return out


def pattern_report(df: DataFrame, k: int = 5, contamination: float = 0.1, seed: int = 42, trees: int = 100,
                   models_path: str | None = None) -> dict:
    """Scaled clustering, anomalies, PCA and patterns, forest predictions; models kept under ``models_path``."""
    spark, base = df.sparkSession, filters.drop_incomplete(df)
    scaled, clustered, cluster_stats = models.kmeans_scaled(base, k=k, seed=seed)
    detector = isolation.fit_detector(base, trees=trees, seed=seed)
    anomalies = isolation.detect_anomalies(base, contamination=contamination, fitted=detector)
    pca_rows, ratio = models.pca_components(base, k=2)
    forest, predicted = models.forest_magnitude(base, trees=trees, seed=seed)
    patterns = cube.tables(cube.written_cube(base))
    if models_path:  # A12
        models.save_model(scaled, f"{models_path}/kmeans_scaled")
        models.save_model(forest, f"{models_path}/forest_magnitude")
        detector[1].save(spark, f"{models_path}/isolation_forest")
    return {
        "clustered": clustered,
        "cluster_stats": cluster_stats,
        "anomalies": anomalies,
        "pca": pca_rows,
        "explained_variance": spark.createDataFrame([(i + 1, float(r)) for i, r in enumerate(ratio)],
                                                    "component int, explained_variance_ratio double"),
        **{item: patterns[item] for item in ("hourly_patterns", "spatial_patterns")},
        "predictions": predicted,
    }


def write_report(report: dict, out: str) -> dict:
    """Each item of a report as a Parquet table under ``out``; returns {item: path}."""
    for name, frame in report.items():
        frame.write.mode("overwrite").parquet(f"{out}/{name}")
    return {name: f"{out}/{name}" for name in report}


def dashboard(df: DataFrame, as_of, days: int = 30, min_magnitude: float = 0.0, pattern: str | None = None, eps: float = 1.0,
              trees: int = 100, models_path: str | None = None) -> dict:
    """The dashboard sequence on one look-back window: KPI row, map, histogram and curve, series, forecast, search.

    Returns named frames; ``write_report`` writes them.  An empty window gives empty frames.
    """
    rows = filters.recent_days(df, as_of, days, min_magnitude)
    predicted = forecast.predict_future(rows, eps=eps, trees=trees, model_path=f"{models_path}/forecast" if models_path else None)
    out = {
        "kpi": summaries.kpi_row(rows),
        "map_rows": map_rows(rows),
        "map_center": summaries.map_center(rows),
        "magnitude_histogram": grids.magnitude_histogram(rows),
        "magnitude_kde": grids.magnitude_kde(rows),
        "daily": summaries.daily_series(rows),
        "hours": summaries.hour_counts(rows, source="time", keep_null=False),
        "forecast": predicted,
        "forecast_markers": forecast_markers(predicted),
        "forecast_center": summaries.map_center(rows, complete=False),
        "forecast_buckets": forecast.bucket_counts(predicted),
        "forecast_confidence": forecast.confidence_counts(predicted),
    }
    if pattern is not None:
        out["search"] = filters.place_search(rows, pattern)
    return out


def map_rows(df: DataFrame) -> DataFrame:
    """One marker row per event with a place and a magnitude."""
    rows = filters.drop_incomplete(df, ["latitude", "longitude", "magnitude"])
    return rows.select("id", "latitude", "longitude", marker_radius("magnitude", 1.5).alias("radius"),
                       severity_band("magnitude", MAP_BANDS).alias("color"), popup_text().alias("popup"))


def report_sizes(report: dict) -> DataFrame:
    """One row per report item with its row count (one aggregate per item)."""
    frames = [v.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(k).alias("item"), "rows") for k, v in report.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
