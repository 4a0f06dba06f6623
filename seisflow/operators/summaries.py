"""Group-by summaries (C1-C18, C22-C26) and ordered reports.

All of them are hash aggregates: Spark computes partial aggregates map-side,
shuffles one row per (task, key) and merges; no raw row crosses the network.
The outputs are tiny (one row per class, hour, day, region, place), so the
final ``orderBy`` sorts a small frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from seisflow.functions.display import fixed
from seisflow.functions.scalars import magnitude_class, round2
from seisflow.operators.filters import FEATURE_COLUMNS, drop_incomplete

_STATS = {
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "sum": F.sum,
    "std": F.stddev_samp,
}


def group_stats(df: DataFrame, keys, spec: dict, digits: int | None = 2,
                drop_null_keys: bool = True) -> DataFrame:
    """Grouped statistics with flat ``column_stat`` names (pandas-style ``agg``).

    ``spec`` maps a column to a list of statistics (mean/min/max/count/sum/std);
    ``count`` counts non-null values.  Means are rounded half-even to
    ``digits`` like pandas ``round``.  Null keys are dropped as pandas does.
    """
    keys = [keys] if isinstance(keys, (str, Column)) else list(keys)
    key_names = [k if isinstance(k, str) else None for k in keys]
    if drop_null_keys:
        for k in keys:
            df = df.where((F.col(k) if isinstance(k, str) else k).isNotNull())
    aggs = []
    for col, stats in spec.items():
        for stat in ([stats] if isinstance(stats, str) else stats):
            e = _STATS[stat](col)
            if digits is not None and stat not in ("count",):
                e = round2(e, digits)
            aggs.append(e.alias(f"{col}_{stat}"))
    out = df.groupBy(*keys).agg(*aggs)
    order = [k for k in key_names if k] or out.columns[:len(keys)]
    return out.orderBy(*order)


def describe_magnitude(df: DataFrame, col: str = "magnitude") -> DataFrame:
    """Count (non-null), mean, sample stddev, min, max as typed columns."""
    return df.agg(F.count(col).alias(f"{col}_count"), F.avg(col).alias(f"{col}_mean"),
                  F.stddev_samp(col).alias(f"{col}_stddev"), F.min(col).alias(f"{col}_min"),
                  F.max(col).alias(f"{col}_max"))


def class_counts(df: DataFrame) -> DataFrame:
    """Events per truncated magnitude class (null class kept), ascending."""
    return (df.groupBy(magnitude_class("magnitude").alias("magnitude_range"))
              .agg(F.count(F.lit(1)).alias("count")).orderBy("magnitude_range"))


def depth_by_class(df: DataFrame) -> DataFrame:
    """C4: mean depth and event count per magnitude class."""
    return (df.groupBy(magnitude_class("magnitude").alias("magnitude_range"))
              .agg(F.avg("depth").alias("avg_depth"), F.count(F.lit(1)).alias("count"))
              .orderBy("magnitude_range"))


def place_counts(df: DataFrame) -> DataFrame:
    """Events per place, most first (place breaks ties)."""
    return df.groupBy("place").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc("place"))


def top_places(df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` places with most events (top-k → TakeOrderedAndProject, no full sort)."""
    return place_counts(df).limit(k)


def hour_counts(df: DataFrame, source: str = "time", keep_null: bool = True) -> DataFrame:
    """Events per hour of day.

    ``source='time'`` derives the hour from the timestamp (UTC session);
    ``source='hour'`` uses the stored column.  ``keep_null=False`` drops rows
    without a time, as a pandas group-by does.
    """
    h = F.hour("time") if source == "time" else F.col("hour")
    out = df.select(h.alias("hour"))
    if not keep_null:
        out = out.where(F.col("hour").isNotNull())
    return out.groupBy("hour").agg(F.count(F.lit(1)).alias("count")).orderBy("hour")


def daily_series(df: DataFrame) -> DataFrame:
    """Events and mean magnitude per calendar day, ascending."""
    return (df.groupBy(F.year("time").alias("year"), F.month("time").alias("month"),
                       F.dayofmonth("time").alias("day"))
              .agg(F.count(F.lit(1)).alias("earthquakes_count"), F.avg("magnitude").alias("avg_magnitude"))
              .orderBy("year", "month", "day"))


def first_days(df: DataFrame, n: int = 30) -> DataFrame:
    """The first ``n`` days of the daily series."""
    return daily_series(df).orderBy("year", "month", "day").limit(n)


def last_days(df: DataFrame, n: int = 30) -> DataFrame:
    """The last ``n`` days of the daily series, newest first."""
    return daily_series(df).orderBy(F.desc("year"), F.desc("month"), F.desc("day")).limit(n)


def hourly_series(df: DataFrame) -> DataFrame:
    """Events per hour of day (from ``time``), ascending."""
    return (df.groupBy(F.hour("time").alias("hour"))
              .agg(F.count(F.lit(1)).alias("earthquakes_count")).orderBy("hour"))


def hourly_patterns(df: DataFrame) -> DataFrame:
    """C11: on complete rows, per hour: mean/count magnitude, mean depth, 2 dp half-even."""
    clean = drop_incomplete(df, FEATURE_COLUMNS).withColumn("hour", F.hour("time"))
    return group_stats(clean, "hour", {"magnitude": ["mean", "count"], "depth": ["mean"]})


def spatial_patterns(df: DataFrame) -> DataFrame:
    """On complete rows, per place: magnitude mean/count/max and mean depth."""
    clean = drop_incomplete(df, FEATURE_COLUMNS)
    return group_stats(clean, "place", {"magnitude": ["mean", "count", "max"], "depth": ["mean"]})


def kpi_row(df: DataFrame) -> DataFrame:
    """One row — events, mean and max magnitude, mean depth, plus 2-dp display text."""
    agg = df.agg(F.count(F.lit(1)).alias("total_events"), F.avg("magnitude").alias("avg_magnitude"),
                 F.max("magnitude").alias("max_magnitude"), F.avg("depth").alias("avg_depth"))
    return agg.select("*", fixed("avg_magnitude").alias("avg_magnitude_text"),
                      fixed("max_magnitude").alias("max_magnitude_text"),
                      F.concat(fixed("avg_depth"), F.lit(" km")).alias("avg_depth_text"))


def map_center(df: DataFrame, complete: bool = True) -> DataFrame:
    """Mean latitude and longitude of mappable rows (coordinates and magnitude present), or of all rows."""
    rows = drop_incomplete(df, ["latitude", "longitude", "magnitude"]) if complete else df
    return rows.agg(F.avg("latitude").alias("center_latitude"), F.avg("longitude").alias("center_longitude"))


def mean_depth(df: DataFrame, columns=("latitude", "longitude", "depth", "magnitude")) -> DataFrame:
    """Mean depth of complete rows (one row)."""
    return drop_incomplete(df, list(columns)).agg(F.avg("depth").alias("mean_depth"))


def mean_abs_error(df: DataFrame, error_col: str = "magnitude_error") -> DataFrame:
    """Mean absolute prediction error."""
    return df.agg(F.avg(F.abs(F.col(error_col))).alias("mean_abs_error"))


def anomaly_count(df: DataFrame, label_col: str = "is_anomaly") -> DataFrame:
    """Number of rows labelled -1 and the total."""
    return df.agg(F.count_if(F.col(label_col) == -1).alias("anomalies"), F.count(F.lit(1)).alias("rows"))


def cluster_sizes(df: DataFrame, label_col: str = "prediction") -> DataFrame:
    """Rows per cluster label."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count")).orderBy(label_col)


def cluster_stats(df: DataFrame, label_col: str = "prediction", digits: int | None = None) -> DataFrame:
    """C14 (and C10 with ``digits=2`` and fewer statistics): per-cluster magnitude and depth stats."""
    return group_stats(df, label_col, {"magnitude": ["mean", "min", "max", "count"],
                                       "depth": ["mean", "min", "max"]}, digits=digits)


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
