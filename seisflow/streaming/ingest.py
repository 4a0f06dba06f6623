"""Streaming forms of ingest and the time-series summaries.

Sources are file streams over landed drops (Parquet event drops or
line-delimited feed features); each new file is processed once, exactly, with
progress in the checkpoint location.  ``availableNow`` processes everything
present and stops, which is how the tests and batch back-fills run them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from seisflow.schema import CATALOGUE_COLUMNS, FEED_FEATURE
from seisflow.sources.fixture import EVENTS_COLUMNS, catalogue_from_events
from seisflow.sources.geojson import flatten_features


def event_stream(spark: SparkSession, source_dir: str, glob: str = "events.parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream Parquet event drops from a folder into catalogue rows."""
    schema = spark.read.option("pathGlobFilter", glob).parquet(source_dir if "*" in glob else f"{source_dir.rstrip('/')}/{glob}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return catalogue_from_events(reader.parquet(source_dir).select(*EVENTS_COLUMNS))


def feed_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream line-delimited feed features (one feature per line) into catalogue rows."""
    reader = spark.readStream.schema(FEED_FEATURE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    feats = reader.json(source_dir)
    return flatten_features(feats.select(F.struct(*feats.columns).alias("f")))


def dedup_stream(stream: DataFrame, delay: str = "1 hour", key: str = "id") -> DataFrame:
    """Drop repeats of an event id arriving within the watermark delay.

    State is kept per id only until the watermark passes its event time, so it
    stays bounded however long the stream runs.
    """
    return stream.withWatermark("time", delay).dropDuplicatesWithinWatermark([key])


def daily_counts_stream(stream: DataFrame, delay: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Tumbling-window event counts and mean magnitude; a window is emitted once closed."""
    return (stream.withWatermark("time", delay)
            .groupBy(F.window("time", size).alias("w"))
            .agg(F.count(F.lit(1)).alias("earthquakes_count"), F.avg("magnitude").alias("avg_magnitude"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "earthquakes_count", "avg_magnitude"))


def run_to_parquet(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append",
                   available_now: bool = True, timeout_s: float | None = None):
    """Run a streaming query into a Parquet folder (exactly-once file sink) and wait for it."""
    w = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint) \
        .outputMode(mode)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    return q


def latest_revisions(df: DataFrame, key: str = "id", version: str = "updated") -> DataFrame:
    """Newest revision of each event: the row with the greatest ``version`` (ties: greatest row).

    A hash aggregate of ``max(struct(version, …))`` — partial aggregation
    map-side, one row per key shuffled — rather than a window sort per key.
    """
    others = [c for c in df.columns if c not in (key, version)]
    best = F.max(F.struct(F.col(version).alias("__v"), *[F.col(c) for c in others])).alias("__best")
    out = df.groupBy(key).agg(best)
    return out.select(key, F.col("__best.__v").alias(version), *[F.col(f"__best.{c}").alias(c) for c in others]) \
        .select(*df.columns)


def upsert_batches(table_path: str, key: str = "id", version: str = "updated"):
    """``foreachBatch`` sink: append each micro-batch's newest revisions to a Parquet table.

    Readers take :func:`latest_revisions` of the table; compaction is the same
    operator written back.  Appends are idempotent per batch id because the
    batch folder name carries it (a retried batch overwrites its own folder).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        latest_revisions(batch, key, version).write.mode("overwrite").parquet(f"{table_path}/batch={batch_id}")
    return write


__all__ = ["event_stream", "feed_stream", "dedup_stream", "daily_counts_stream", "run_to_parquet",
           "latest_revisions", "upsert_batches", "CATALOGUE_COLUMNS"]
