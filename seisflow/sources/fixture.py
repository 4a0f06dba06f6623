"""Event catalogue derived from the driver's ``events`` table.

``events`` (event_id, ts, user_id, event_type, value, props) has no
coordinates, so positions, magnitudes and depths are derived from the ids with
integer arithmetic that any SQL engine evaluates identically.  The result has
twelve dense clusters plus 10 % scattered background and nulls in magnitude,
longitude and depth.  Pure projection: no shuffle, fully pushed into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from seisflow.schema import CATALOGUE_FIELDS

EVENTS_COLUMNS = ["event_id", "ts", "user_id", "event_type"]


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def catalogue_from_events(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    c = (F.col("user_id") * 7) % 12
    magnitude = F.when(eid % 50 == 0, F.lit(None)).otherwise(((eid * 13) % 95) / 10.0 - 0.5)
    place = F.concat(((F.col("user_id") * 3) % 90).cast("string"), F.lit(" km S of "), F.col("event_type"))
    longitude = (F.when(eid % 97 == 0, F.lit(None))
                 .when(eid % 10 == 0, ((eid * 7919) % 36000) / 100.0 - 180.0)
                 .otherwise(c * 30.0 - 175.0 + ((eid * 37) % 400) / 100.0))
    latitude = (F.when(eid % 10 == 0, ((eid * 104729) % 18000) / 100.0 - 90.0)
                .otherwise(((c * 5) % 12) * 12.0 - 65.0 + ((eid * 53) % 400) / 100.0))
    depth = F.when(eid % 83 == 0, F.lit(None)).otherwise(((eid * 31) % 7000) / 10.0)
    time = F.col("ts").cast("timestamp")
    derived = {
        "id": F.concat(F.lit("ev"), eid.cast("string")),
        "magnitude": magnitude,
        "place": place,
        "time": time,
        "updated": time,
        "longitude": longitude,
        "latitude": latitude,
        "depth": depth,
        "date": F.date_format(time, "yyyy-MM-dd"),
        "hour": F.hour(time),
    }
    cols = [eid.alias("event_id")]
    for name, dtype in CATALOGUE_FIELDS:
        if name in derived:
            cols.append(derived[name].alias(name))
        else:
            cols.append(F.lit(None).cast(dtype.simpleString()).alias(name))
    # Derived columns already have the schema's types; type names (not DataType
    # objects) keep the Python-side plan building cheap.
    return events.select(*cols)


def load_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue_from_events(load_events(spark, sf_dir).select(*EVENTS_COLUMNS))
