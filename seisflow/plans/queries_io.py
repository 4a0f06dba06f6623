"""Registered queries: sinks and scans round-tripped through files, streaming, jobs.

Files are written under the session's checkpoint folder (the shared folder a
cluster names in ``spark.checkpoint.dir``), each run in a fresh sub-folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from seisflow.operators import cube
from seisflow.operators.regions import REGION_BOXES, UNCLASSIFIED
from seisflow.plans import jobs
from seisflow.plans.oracle import REGION_FIRST, q
from seisflow.schema import CATALOGUE_FIELDS
from seisflow.plans.registry import RANGE_END, RANGE_START, catalogue, fitted, register, round_cols
from seisflow.session import scratch_path
from seisflow.sources import catalogue as cat_io
from seisflow.sources import fixture, geojson
from seisflow.streaming import ingest, revisions

_ROW_COLS = ["id", "magnitude", "place", "time", "longitude", "latitude", "depth", "date", "hour"]
_ROW_SQL = ("SELECT id, magnitude, place, time, longitude, latitude, depth, strftime(time, '%Y-%m-%d') AS date, "
            "CAST(hour(time) AS INTEGER) AS hour FROM quakes")

# ---------------------------------------------------------------- file round trips


@register("csv_roundtrip", q(_ROW_SQL))
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    cat_io.write_catalogue_csv(catalogue(spark, sf_dir), path)
    return cat_io.read_catalogue_csv(spark, path).select(*_ROW_COLS)


def _dated(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    cat_io.write_catalogue_parquet(catalogue(spark, sf_dir).drop("event_id"), path, partition_by="date")
    return cat_io.read_catalogue_parquet(spark, path)


@register("parquet_roundtrip", q(_ROW_SQL))
def parquet_roundtrip(spark, sf_dir):
    return _dated(spark, sf_dir).select(*_ROW_COLS)


@register("parquet_pruned_read", q(
    _ROW_SQL + " WHERE strftime(time, '%Y-%m-%d') BETWEEN '2024-01-10' AND '2024-01-12'"))
def parquet_pruned_read(spark, sf_dir):
    # The whole table is written; the date predicate prunes partition folders before any file is opened.
    return _dated(spark, sf_dir).where(F.col("date").between("2024-01-10", "2024-01-12")).select(*_ROW_COLS)


# Feed documents carry epoch milliseconds, so times come back truncated to the millisecond.
_FEED_SQL = ("SELECT id, magnitude, place, date_trunc('millisecond', time) AS time, longitude, latitude, depth, "
             "strftime(time, '%Y-%m-%d') AS date, CAST(hour(time) AS INTEGER) AS hour FROM quakes")


@register("geojson_roundtrip", q(_FEED_SQL))
def geojson_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "feed")
    geojson.write_feed(catalogue(spark, sf_dir), path)
    return geojson.read_feed(spark, path, line_delimited=True).select(*_ROW_COLS)


@register("geojson_documents", q(_FEED_SQL))
def geojson_documents(spark, sf_dir):
    path = scratch_path(spark, "docs")
    geojson.write_feed_documents(catalogue(spark, sf_dir), path, features_per_document=500)
    return geojson.read_feed_documents(spark, path).select(*_ROW_COLS)


@register("collect_job", q(
    f"SELECT count(*) AS rows_written FROM quakes WHERE time BETWEEN TIMESTAMP '{RANGE_START}' "
    f"AND TIMESTAMP '{RANGE_END}' AND magnitude >= 2.5e0"))
def collect_job(spark, sf_dir):
    feed = scratch_path(spark, "landed")
    geojson.write_feed(catalogue(spark, sf_dir), feed)
    n = jobs.collect_and_save(spark, feed, scratch_path(spark, "collected"), RANGE_START, RANGE_END, 2.5)
    return spark.createDataFrame([(n,)], "rows_written long")


@register("collected_table", q(
    _FEED_SQL + f" WHERE time BETWEEN TIMESTAMP '{RANGE_START}' AND TIMESTAMP '{RANGE_END}' AND magnitude >= 2.5e0"))
def collected_table(spark, sf_dir):
    feed, out = scratch_path(spark, "landed"), scratch_path(spark, "collected")
    geojson.write_feed(catalogue(spark, sf_dir), feed)
    jobs.collect_and_save(spark, feed, out, RANGE_START, RANGE_END, 2.5)
    return cat_io.read_catalogue_parquet(spark, out).select(*_ROW_COLS)


def _processed(spark, sf_dir):
    def write():
        paths = jobs.save_processed(catalogue(spark, sf_dir).drop("event_id"), scratch_path(spark, "processed"))
        return {k: spark.read.parquet(p) for k, p in paths.items()}
    return fitted(spark, sf_dir, "processed", write)


@register("processed_events", q(_ROW_SQL))
def processed_events(spark, sf_dir):
    return _processed(spark, sf_dir)["events"].select(*_ROW_COLS[:-2], F.col("date").cast("string").alias("date"), "hour")


@register("processed_daily", q(
    "SELECT CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month, CAST(day(time) AS INTEGER) AS day, "
    "count(*) AS earthquakes_count, round(avg(magnitude), 6) AS avg_magnitude FROM quakes GROUP BY 1, 2, 3"))
def processed_daily(spark, sf_dir):
    return round_cols(_processed(spark, sf_dir)["daily"], ["avg_magnitude"])


@register("processed_hourly", q(
    "SELECT CAST(hour(time) AS INTEGER) AS hour, count(*) AS earthquakes_count FROM quakes GROUP BY 1"))
def processed_hourly(spark, sf_dir):
    return _processed(spark, sf_dir)["hourly"].select("hour", "earthquakes_count")


@register("processed_regions", q(f"SELECT id, {REGION_FIRST} AS code FROM quakes"))
def processed_regions(spark, sf_dir):
    from seisflow.operators.regions import region_code
    return _processed(spark, sf_dir)["regions"].select("id", region_code(mode="first").alias("code"))


@register("processed_tables", q(
    "SELECT 'events' AS item, count(*) AS \"rows\" FROM quakes UNION ALL "
    "SELECT 'regions', count(*) FROM quakes UNION ALL "
    f"SELECT 'region_summary', count(DISTINCT {REGION_FIRST}) FROM quakes UNION ALL "
    "SELECT 'daily', count(DISTINCT CAST(time AS DATE)) FROM quakes UNION ALL "
    "SELECT 'hourly', count(DISTINCT hour(time)) FROM quakes"))
def processed_tables(spark, sf_dir):
    return jobs.report_sizes(_processed(spark, sf_dir))


_CLASS = "(CASE WHEN isnan(magnitude) THEN NULL ELSE CAST(trunc(magnitude) AS INTEGER) END)"
_BASIC = (f"SELECT 'schema' AS item, {len(CATALOGUE_FIELDS) + 1} AS \"rows\" UNION ALL SELECT 'sample', 5 UNION ALL SELECT 'describe', 1 UNION ALL "
          f"SELECT 'magnitude_classes', count(*) FROM (SELECT DISTINCT {_CLASS} FROM quakes) UNION ALL "
          "SELECT 'top_places', least(10, count(DISTINCT place)) FROM quakes UNION ALL "
          f"SELECT 'depth_by_class', count(*) FROM (SELECT DISTINCT {_CLASS} FROM quakes) UNION ALL "
          "SELECT 'hours', count(DISTINCT hour(time)) FROM quakes")


@register("basic_report", q(_BASIC))
def basic_report(spark, sf_dir):
    return jobs.report_sizes(jobs.basic_report(catalogue(spark, sf_dir)))


_WHOLE = "magnitude IS NOT NULL AND longitude IS NOT NULL AND latitude IS NOT NULL AND depth IS NOT NULL"


_CUBE_KEYS = {"all": "NULL", "class": f"CAST({_CLASS} AS VARCHAR)", "place": "place", "region": "region", "day": "CAST(CAST(time AS DATE) AS VARCHAR)",
              "hour": "CAST(hour(time) AS VARCHAR)", "stored_hour": "CAST(hour(time) AS VARCHAR)"}
_CUBE_NAMES = "CASE " + REGION_FIRST + " " + " ".join(f"WHEN {code} THEN '{name}'" for code, name, *_ in REGION_BOXES) + f" ELSE '{UNCLASSIFIED}' END AS region"


@register("one_scan_report", q(" UNION ALL ".join(
    f"SELECT '{item}' AS item, {key} AS key, count(*) AS events, count(magnitude) AS magnitude_count, round(avg(magnitude), 6) AS magnitude_mean, "
    "round(stddev_samp(magnitude), 6) AS magnitude_stddev, min(magnitude) AS magnitude_min, max(magnitude) AS magnitude_max, round(avg(depth), 6) AS depth_mean, "
    f"count(*) FILTER ({_WHOLE}) AS c_events, count(magnitude) FILTER ({_WHOLE}) AS c_magnitude_count, round(avg(magnitude) FILTER ({_WHOLE}), 6) AS c_magnitude_mean, "
    f"max(magnitude) FILTER ({_WHOLE}) AS c_magnitude_max, round(avg(depth) FILTER ({_WHOLE}), 6) AS c_depth_mean FROM rq GROUP BY {key if item != 'all' else 'ALL'}"
    for item, key in _CUBE_KEYS.items()), f"rq AS (SELECT *, {_CUBE_NAMES} FROM quakes)"))
def one_scan_report(spark, sf_dir):
    """Every summary of the reports, by value, from one scan."""
    made = cube.cube(catalogue(spark, sf_dir))
    day = F.when(F.col("item") == "day", F.make_date("year", "month", "day").cast("string"))
    key = F.coalesce(day, F.when(F.col("item") == "class", F.col("class").cast("string")), F.when(F.col("item") == "place", F.col("place")), F.when(F.col("item") == "region", F.col("region")),
                     F.when(F.col("item") == "hour", F.col("hour").cast("string")), F.when(F.col("item") == "stored_hour", F.col("stored_hour").cast("string")))
    means = [c for c in made.columns if c.endswith("_mean") or c.endswith("_stddev")]
    return round_cols(made.withColumn("key", key).drop(*[k for keys in cube.SETS.values() for k in keys]), means)


@register("spark_analysis", q(_BASIC + f" UNION ALL SELECT 'clustered', count(*) FROM quakes WHERE {_WHOLE} UNION ALL SELECT 'centers', 5 "
                              "UNION ALL SELECT 'cluster_sizes', 5 UNION ALL SELECT 'silhouette', 1"))
def spark_analysis(spark, sf_dir):
    return jobs.report_sizes(jobs.spark_analysis(catalogue(spark, sf_dir)))


@register("pattern_report", q(
    f"SELECT unnest(['clustered', 'anomalies', 'pca', 'predictions']) AS item, count(*) AS \"rows\" FROM quakes WHERE {_WHOLE} UNION ALL "
    "SELECT 'cluster_stats', 5 UNION ALL SELECT 'explained_variance', 2 UNION ALL "
    f"SELECT 'hourly_patterns', count(DISTINCT hour(time)) FROM quakes WHERE {_WHOLE} UNION ALL "
    f"SELECT 'spatial_patterns', count(DISTINCT place) FROM quakes WHERE {_WHOLE}"))
def pattern_report(spark, sf_dir):
    return jobs.report_sizes(jobs.pattern_report(catalogue(spark, sf_dir)))


_DERIVED = {c: c for c in ("id", "magnitude", "place", "time", "updated", "longitude", "latitude", "depth")} | {"date": "time", "hour": "time"}


@register("schema_report", q(" UNION ALL ".join(
    f"SELECT {i} AS position, '{n}' AS name, '{t.simpleString()}' AS data_type, TRUE AS nullable, count({_DERIVED.get(n, 'NULL')}) AS non_null FROM quakes"
    for i, (n, t) in enumerate(CATALOGUE_FIELDS))))
def schema_report(spark, sf_dir):
    from seisflow.schema import schema_report as report
    return report(catalogue(spark, sf_dir).drop("event_id"))


# ---------------------------------------------------------------- streaming


def _run(spark, stream, name, mode="append"):
    sink, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    ingest.run_to_parquet(stream, sink, ckpt, mode=mode)
    return spark.read.parquet(sink)


DROPS = 4
_LATE_DAYS = 5


def _landed(spark, drops, stream, name):
    """Drops landed one after another in one folder, each followed by a run of the stream on one checkpoint.

    A drop is written with its own partitions; what counts is the order of drops, so each is one micro-batch.
    ``stream`` makes the query's frame from the event stream. Returns what the sink holds after the last run.
    """
    folder, sink, checkpoint = (scratch_path(spark, f"{name}-{part}") for part in ("drops", "out", "ckpt"))
    for drop in drops:
        drop.write.mode("append").parquet(folder)
        ingest.run_to_parquet(stream(ingest.event_stream(spark, folder, glob="*.parquet")), sink, checkpoint)
    return spark.read.parquet(sink)


def _by_day(spark, sf_dir):
    """The table in DROPS drops of consecutive days."""
    events = fixture.load_events(spark, sf_dir)
    day = F.dayofmonth("ts")
    return [events.where((day > 8 * k) & (day <= 8 * (k + 1))) for k in range(DROPS)]


@register("stream_ingest", q("SELECT id, magnitude, time, longitude, latitude, depth FROM quakes"))
def stream_ingest(spark, sf_dir):
    return _landed(spark, _by_day(spark, sf_dir), lambda s: s.select("id", "magnitude", "time", "longitude", "latitude", "depth"), "ingest")


@register("stream_feed", q(_FEED_SQL))
def stream_feed(spark, sf_dir):
    # Feed features landed as several files, one per micro-batch.
    folder = scratch_path(spark, "feed-drops")
    geojson.write_feed(catalogue(spark, sf_dir).repartition(DROPS, "id"), folder)
    return _run(spark, ingest.feed_stream(spark, folder, max_files_per_trigger=1), "feed").select(*_ROW_COLS)


@register("stream_dedup", q("SELECT id, magnitude, time FROM quakes"))
def stream_dedup(spark, sf_dir):
    # Every drop lands a second time, right after the first: repeats meet the state of an earlier micro-batch, and
    # each event comes out once.
    drops = [d for part in _by_day(spark, sf_dir) for d in (part, part)]
    return _landed(spark, drops, lambda s: ingest.dedup_stream(s.select("id", "magnitude", "time"), delay="10 days"), "dedup")


_LATEST_SQL = q("SELECT id, round(magnitude + 1e-1, 6) AS magnitude, time + INTERVAL 1 HOUR AS updated FROM quakes")
_REVISION = "id string, magnitude double, updated timestamp"


def _revised(spark, sf_dir, sink):
    """Originals and revisions (one hour later, magnitude + 0.1) in drops, the revisions of the first before its originals."""
    folder, checkpoint = scratch_path(spark, "revision-drops"), scratch_path(spark, "revisions-ckpt")
    base = catalogue(spark, sf_dir).select("id", "magnitude", "updated", F.dayofmonth("time").alias("day"))
    revised = base.select("id", (F.col("magnitude") + 0.1).alias("magnitude"), (F.col("updated") + F.expr("INTERVAL 1 HOUR")).alias("updated"), "day")
    early = F.col("day") <= 15
    for part in (revised.where(early), base.where(early), base.where(~early), revised.where(~early)):
        part.drop("day").write.mode("append").parquet(folder)
        stream = spark.readStream.schema(_REVISION).parquet(folder)
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


@register("stream_latest", _LATEST_SQL)
def stream_latest(spark, sf_dir):
    # Readers take the newest revision over all micro-batches.
    table = scratch_path(spark, "revisions")
    _revised(spark, sf_dir, ingest.upsert_batches(table))
    latest = ingest.latest_revisions(spark.read.parquet(table).select("id", "magnitude", "updated"))
    return round_cols(latest, ["magnitude"])


@register("stream_merged", _LATEST_SQL)
def stream_merged(spark, sf_dir):
    # The table merges every two batches: a merge takes revisions that came before their originals.
    table = revisions.RevisionTable(spark, scratch_path(spark, "merged"), _REVISION)
    _revised(spark, sf_dir, revisions.merging_sink(table, every=2))
    return round_cols(table.read(), ["magnitude"])


def _late_drops(spark, sf_dir):
    """Days in order, but the rows of user_id % 50 = 2 on the first three days come after everything else."""
    very_late = (F.col("user_id") % 50 == 2) & (F.dayofmonth("ts") <= 3)
    events = fixture.load_events(spark, sf_dir)
    return [*(d.where(~very_late) for d in _by_day(spark, sf_dir)), events.where(very_late)]


def _delayed_drops(spark, sf_dir):
    """Days in order, but the rows of user_id % 50 = 1 come one drop (eight days) late."""
    late, days = F.col("user_id") % 50 == 1, _by_day(spark, sf_dir)
    return [days[0].where(~late), *(b.where(~late).unionByName(a.where(late)) for a, b in zip(days, days[1:])), days[-1].where(late)]


# Rows of the last drop lie more than the watermark behind the newest time by then, so their windows are closed.
_ON_TIME = "quakes_in AS (SELECT quakes.* FROM quakes JOIN events USING (event_id) WHERE NOT (user_id % 50 = 2 AND day(time) <= 3))"


@register("stream_daily", q(
    "SELECT date_trunc('day', time) AS window_start, date_trunc('day', time) + INTERVAL 1 DAY AS window_end, "
    "count(*) AS earthquakes_count, round(avg(magnitude), 6) AS avg_magnitude FROM quakes_in "
    f"GROUP BY 1, 2 HAVING date_trunc('day', time) + INTERVAL 1 DAY <= (SELECT max(time) FROM quakes) - INTERVAL {_LATE_DAYS} DAY", _ON_TIME))
def stream_daily(spark, sf_dir):
    out = _landed(spark, _late_drops(spark, sf_dir), lambda s: ingest.daily_counts_stream(s, delay=f"{_LATE_DAYS} days"), "daily")
    return round_cols(out, ["avg_magnitude"])


@register("stream_late_kept", q(
    "SELECT date_trunc('day', time) AS window_start, date_trunc('day', time) + INTERVAL 1 DAY AS window_end, "
    "count(*) AS earthquakes_count, round(avg(magnitude), 6) AS avg_magnitude FROM quakes "
    "GROUP BY 1, 2 HAVING date_trunc('day', time) + INTERVAL 1 DAY <= (SELECT max(time) FROM quakes) - INTERVAL 20 DAY"))
def stream_late_kept(spark, sf_dir):
    # Rows eight days late under a watermark of 20 days: inside it, so every one is counted.
    out = _landed(spark, _delayed_drops(spark, sf_dir), lambda s: ingest.daily_counts_stream(s, delay="20 days"), "late")
    return round_cols(out, ["avg_magnitude"])


@register("stream_hourly", q(
    "SELECT date_trunc('hour', time) AS window_start, date_trunc('hour', time) + INTERVAL 1 HOUR AS window_end, "
    "count(*) AS earthquakes_count, round(avg(magnitude), 6) AS avg_magnitude FROM quakes "
    "GROUP BY 1, 2 HAVING date_trunc('hour', time) + INTERVAL 1 HOUR <= "
    "(SELECT max(time) FROM quakes) - INTERVAL 1 HOUR"))
def stream_hourly(spark, sf_dir):
    # I3 with hourly tumbling windows: a window is emitted once the watermark passes its end.
    out = _landed(spark, _by_day(spark, sf_dir), lambda s: ingest.daily_counts_stream(s, size="1 hour"), "hourly")
    return round_cols(out, ["avg_magnitude"])
