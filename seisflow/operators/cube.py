"""All summary tables of the reports from one reading of the catalogue.

One aggregate over grouping sets: a row is expanded once per table and summed up with map-side partials, so what is
shuffled is one row per task and key, and the catalogue is scanned once. The result is written; every table is a
filter of it. It has a row per class, place, region, day and hour, not per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from seisflow.functions.display import fixed
from seisflow.functions.scalars import magnitude_class, round2
from seisflow.operators.filters import FEATURE_COLUMNS
from seisflow.operators.regions import region_code, region_name
from seisflow.session import scratch_path

#: The tables' keys, by item of the report. The item ``all`` has no key.
SETS = {
    "all": (), "class": ("class",), "place": ("place",), "region": ("region",), "day": ("year", "month", "day"),
    "hour": ("hour",), "stored_hour": ("stored_hour",),
}
_KEYS = ("class", "place", "region", "year", "month", "day", "hour", "stored_hour")


def cube(df: DataFrame, region_mode: str = "first") -> DataFrame:
    """(item, keys…, measures…): ``events`` and the statistics of all rows, and ``c_…`` of rows complete in the features."""
    whole = ~F.isnull(F.col(FEATURE_COLUMNS[0]))
    for c in FEATURE_COLUMNS[1:]:
        whole = whole & F.col(c).isNotNull()
    for c in FEATURE_COLUMNS:
        whole = whole & ~F.isnan(F.col(c).cast("double"))
    stored = F.col("hour") if "hour" in df.columns else F.hour("time")
    rows = df.select(magnitude_class("magnitude").alias("class"), "place", region_name(region_code(mode=region_mode)).alias("region"),
                     F.year("time").alias("year"), F.month("time").alias("month"), F.dayofmonth("time").alias("day"), F.hour("time").alias("hour"),
                     stored.alias("stored_hour"), F.col("magnitude").alias("__m"), F.col("depth").alias("__d"), whole.alias("__whole"))
    own_m, own_d = F.when(F.col("__whole"), F.col("__m")), F.when(F.col("__whole"), F.col("__d"))
    out = rows.groupingSets([[F.col(c) for c in keys] for keys in SETS.values()], *[F.col(c) for c in _KEYS]).agg(
        F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("events"), F.count("__m").alias("magnitude_count"), F.avg("__m").alias("magnitude_mean"),
        F.stddev_samp("__m").alias("magnitude_stddev"), F.min("__m").alias("magnitude_min"), F.max("__m").alias("magnitude_max"), F.avg("__d").alias("depth_mean"),
        F.count_if("__whole").alias("c_events"), F.count(own_m).alias("c_magnitude_count"), F.avg(own_m).alias("c_magnitude_mean"),
        F.max(own_m).alias("c_magnitude_max"), F.avg(own_d).alias("c_depth_mean"))
    numbers = {sum(1 << (len(_KEYS) - 1 - i) for i, c in enumerate(_KEYS) if c not in keys): item for item, keys in SETS.items()}
    item = None
    for number, name in numbers.items():
        item = F.when(F.col("__set") == number, name) if item is None else item.when(F.col("__set") == number, name)
    return out.withColumn("item", item).drop("__set").select("item", *_KEYS, *[c for c in out.columns if c not in (*_KEYS, "__set")])


def written_cube(df: DataFrame, region_mode: str = "first") -> DataFrame:
    """The cube as a table in the shared folder."""
    made, path = cube(df, region_mode), scratch_path(df.sparkSession, "cube")
    made.write.parquet(path)
    return df.sparkSession.read.schema(made.schema).parquet(path)


def tables(made: DataFrame, top: int = 10) -> dict[str, DataFrame]:
    """The report's tables from a cube, each with the columns and order of the single summary of that name."""
    of = lambda item: made.where(F.col("item") == item)
    # A table without rows has no row of the empty grouping set: an aggregate always has one.
    counts = ("events", "magnitude_count")
    whole_table = [c for c in made.columns if c in counts or c.startswith(("magnitude_", "depth_"))]
    everything = of("all").agg(*[(F.coalesce(F.sum(c), F.lit(0)) if c in counts else F.max(c)).alias(c) for c in whole_table])
    classes = of("class")
    places = of("place").select("place", F.col("events").alias("count")).orderBy(F.desc("count"), F.asc("place"))
    hours = lambda item, key, name: of(item).select(F.col(key).alias("hour"), F.col("events").alias(name)).orderBy("hour")
    whole = lambda item: of(item).where((F.col("c_events") > 0) & F.col(item).isNotNull())
    return {
        "describe": everything.select("magnitude_count", "magnitude_mean", "magnitude_stddev", "magnitude_min", "magnitude_max"),
        "kpi": everything.select(F.col("events").alias("total_events"), F.col("magnitude_mean").alias("avg_magnitude"), F.col("magnitude_max").alias("max_magnitude"),
                                 F.col("depth_mean").alias("avg_depth"), fixed("magnitude_mean").alias("avg_magnitude_text"), fixed("magnitude_max").alias("max_magnitude_text"),
                                 F.concat(fixed("depth_mean"), F.lit(" km")).alias("avg_depth_text")),
        "magnitude_classes": classes.select(F.col("class").alias("magnitude_range"), F.col("events").alias("count")).orderBy("magnitude_range"),
        "depth_by_class": classes.select(F.col("class").alias("magnitude_range"), F.col("depth_mean").alias("avg_depth"), F.col("events").alias("count")).orderBy("magnitude_range"),
        "place_counts": places,
        "top_places": places.limit(top),
        "region_summary": of("region").select("region", F.col("events").alias("count"), F.col("magnitude_mean").alias("avg_magnitude"),
                                              F.col("magnitude_max").alias("max_magnitude"), F.col("depth_mean").alias("avg_depth")).orderBy(F.desc("count"), F.asc("region")),
        "daily": of("day").select("year", "month", "day", F.col("events").alias("earthquakes_count"), F.col("magnitude_mean").alias("avg_magnitude")).orderBy("year", "month", "day"),
        "hourly": hours("hour", "hour", "earthquakes_count"),
        "hours": hours("stored_hour", "stored_hour", "count"),
        "hourly_patterns": whole("hour").select("hour", round2("c_magnitude_mean").alias("magnitude_mean"), F.col("c_magnitude_count").alias("magnitude_count"),
                                                round2("c_depth_mean").alias("depth_mean")).orderBy("hour"),
        "spatial_patterns": whole("place").select("place", round2("c_magnitude_mean").alias("magnitude_mean"), F.col("c_magnitude_count").alias("magnitude_count"),
                                                  round2("c_magnitude_max").alias("magnitude_max"), round2("c_depth_mean").alias("depth_mean")).orderBy("place"),
    }
