"""The end-to-end batch job: load → basic report → processed tables → k-means → map and chart data.

Run with ``spark-submit -m seisflow.plans.batch --input PATH --format csv|parquet|feed --output DIR``
(or ``python -m``).  Every output is a Parquet table under ``--output``; the
catalogue is written first and every other output derives from that table by
pruned reads.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from seisflow.operators import forecast, grids, models, summaries
from seisflow.plans import jobs
from seisflow.sources.catalogue import read_catalogue_csv, read_catalogue_parquet, require_rows
from seisflow.sources.geojson import read_feed


def load(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "csv":
        return read_catalogue_csv(spark, path)
    if fmt == "parquet":
        return read_catalogue_parquet(spark, path)
    if fmt == "feed":
        return read_feed(spark, path, line_delimited=True)
    raise ValueError(f"unknown format {fmt}")


def run_batch(spark: SparkSession, df: DataFrame, out: str, k: int = 5, seed: int = 42) -> dict:
    """Write every output of the batch job under ``out``; returns {name: path}."""
    paths = jobs.save_processed(require_rows(df, 1, "catalogue"), f"{out}/events")
    base = read_catalogue_parquet(spark, paths["events"])
    report = jobs.basic_report(base)
    model, pred, silhouette, centers = models.kmeans_raw(base, k=k, seed=seed)
    outputs = {
        **{f"report_{name}": frame for name, frame in report.items()},
        "clustered": models.clustered_table(pred),
        "cluster_centers": centers,
        "cluster_stats": summaries.cluster_stats(models.clustered_table(pred)),
        "map_rows": jobs.map_rows(base),
        "map_center": summaries.map_center(base),
        "heat_cells": grids.heat_cells(base),
        "marker_tiles": grids.marker_tiles(base),
        "magnitude_histogram": grids.magnitude_histogram(base),
        "magnitude_kde": grids.magnitude_kde(base),
        "depth_scatter": grids.depth_scatter(base),
        "time_ordered": grids.time_ordered(base),
        "hour_frequency": summaries.hour_counts(base, source="time", keep_null=False),
        "density_grid": grids.density_grid(base),
    }
    for name, frame in outputs.items():
        frame.write.mode("overwrite").parquet(f"{out}/{name}")
        paths[name] = f"{out}/{name}"
    models.save_model(model, f"{out}/kmeans_model")
    paths["kmeans_model"] = f"{out}/kmeans_model"
    spark.createDataFrame([(float(silhouette),)], "silhouette double").write.mode("overwrite") \
        .parquet(f"{out}/silhouette")
    paths["silhouette"] = f"{out}/silhouette"
    patterns = jobs.pattern_report(base, k=k, seed=seed, models_path=f"{out}/models")
    paths.update({f"pattern_{n}": p for n, p in jobs.write_report(patterns, f"{out}/pattern").items()})
    predicted = forecast.predict_future(base, model_path=f"{out}/models/forecast")
    predicted.write.mode("overwrite").parquet(f"{out}/forecast")
    return {**paths, "models": f"{out}/models", "forecast": f"{out}/forecast"}


def main(argv=None) -> None:
    from seisflow.session import build_session

    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--input", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet", "feed"])
    ap.add_argument("--output", required=True)
    ap.add_argument("--clusters", type=int, default=5)
    args = ap.parse_args(argv)
    spark = build_session(app="seisflow-batch")
    paths = run_batch(spark, load(spark, args.input, args.format), args.output, k=args.clusters)
    for name, path in sorted(paths.items()):
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
