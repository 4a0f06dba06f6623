import os

from seisflow.plans.batch import load, run_batch
from seisflow.sources.catalogue import write_catalogue_csv
from seisflow.sources.fixture import load_catalogue


def test_batch_job_writes_every_output(spark, tmp_dir):
    cat = load_catalogue(spark, "/root/testdata/sf0.001").drop("event_id")
    write_catalogue_csv(cat, os.path.join(tmp_dir, "in"))
    paths = run_batch(spark, load(spark, os.path.join(tmp_dir, "in"), "csv"), os.path.join(tmp_dir, "out"), k=3)
    assert spark.read.parquet(paths["events"]).count() == cat.count()
    assert spark.read.parquet(paths["clustered"]).count() == cat.dropna(
        subset=["magnitude", "longitude", "latitude", "depth"]).count()
    assert spark.read.parquet(paths["hourly" if "hourly" in paths else "hour_frequency"]).count() == 24
    assert spark.read.parquet(paths["magnitude_histogram"]).count() == 20
    assert os.path.isdir(paths["kmeans_model"])
    for name in ("kmeans_scaled", "forest_magnitude", "isolation_forest"):
        assert os.path.isdir(os.path.join(paths["models"], name))
    assert set(spark.read.parquet(paths["forecast"]).columns) == {"latitude", "longitude", "predicted_magnitude", "confidence", "zone"}


def test_dashboard_sequence(spark, tmp_dir):
    from seisflow.plans import jobs
    cat = load_catalogue(spark, "/root/testdata/sf0.001").drop("event_id")
    frames = jobs.dashboard(cat, "2024-01-30 00:00:00", days=20, min_magnitude=0.0, pattern="km S", eps=0.1, trees=5)
    paths = jobs.write_report(frames, os.path.join(tmp_dir, "dash"))
    n = spark.read.parquet(paths["kpi"]).first().total_events
    assert n == spark.read.parquet(paths["search"]).count() > 0
    assert spark.read.parquet(paths["forecast"]).count() == spark.read.parquet(paths["forecast_markers"]).count()
