import os

from pyspark.sql import functions as F

from seisflow.operators.summaries import daily_series
from seisflow.sources.fixture import load_catalogue
from seisflow.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch_on_closed_windows(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    ingest.run_to_parquet(ingest.daily_counts_stream(ingest.event_stream(spark, SF)), out, os.path.join(tmp_dir, "ck"))
    got = {r.window_start.day: r.earthquakes_count for r in spark.read.parquet(out).collect()}
    batch = {r.day: r.earthquakes_count for r in daily_series(load_catalogue(spark, SF)).collect()}
    last = max(batch)
    assert got == {d: n for d, n in batch.items() if d != last}


def test_replayed_drop_is_deduplicated(spark, tmp_dir):
    s = ingest.event_stream(spark, SF)
    out = os.path.join(tmp_dir, "dedup")
    ingest.run_to_parquet(ingest.dedup_stream(s.unionByName(ingest.event_stream(spark, SF))), out,
                          os.path.join(tmp_dir, "ck2"))
    back = spark.read.parquet(out)
    assert back.count() == back.select("id").distinct().count() == load_catalogue(spark, SF).count()


def test_latest_revision(spark):
    rows = [("a", 1.0, "2024-01-01 00:00:00"), ("a", 2.0, "2024-01-02 00:00:00"), ("b", 3.0, "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "id string, magnitude double, u string").withColumn(
        "updated", F.col("u").cast("timestamp")).drop("u")
    got = {r.id: r.magnitude for r in ingest.latest_revisions(df).collect()}
    assert got == {"a": 2.0, "b": 3.0}


def test_feed_stream(spark, tmp_dir):
    from seisflow.sources.geojson import write_feed
    cat = load_catalogue(spark, SF).drop("event_id")
    write_feed(cat, os.path.join(tmp_dir, "landing"))
    out = os.path.join(tmp_dir, "feed_out")
    ingest.run_to_parquet(ingest.feed_stream(spark, os.path.join(tmp_dir, "landing")), out, os.path.join(tmp_dir, "ck3"))
    assert spark.read.parquet(out).count() == cat.count()
