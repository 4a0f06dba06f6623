"""Registered queries: scans, filters, regions, summaries, scalars (exact oracle)."""

from __future__ import annotations

from seisflow.functions.display import CHART_BANDS, MAP_BANDS, severity_band
from seisflow.functions.scalars import ts_text
from seisflow.operators import filters, regions, summaries
from seisflow.plans import jobs
from seisflow.plans.oracle import REGION_FIRST, q
from seisflow.plans.registry import AS_OF, RANGE_END, RANGE_START, catalogue, register, round_cols

# ---------------------------------------------------------------- scans


@register("catalog_view", q(
    "SELECT event_id, id, magnitude, place, time, longitude, latitude, depth, "
    "strftime(time, '%Y-%m-%d') AS date, CAST(hour(time) AS INTEGER) AS hour FROM quakes"))
def catalog_view(spark, sf_dir):
    return catalogue(spark, sf_dir).select("event_id", "id", "magnitude", "place", "time",
                                           "longitude", "latitude", "depth", "date", "hour")


@register("catalog_sql", q(
    "SELECT id, place, magnitude AS mag, depth AS depth_km FROM quakes "
    "WHERE magnitude >= 6e0 AND depth < 1e2"))
def catalog_sql(spark, sf_dir):
    # A4: the catalogue registered as a temp view and queried with Spark SQL.
    catalogue(spark, sf_dir).createOrReplaceTempView("earthquakes")
    return spark.sql("SELECT id, place, magnitude AS mag, depth AS depth_km FROM earthquakes "
                     "WHERE magnitude >= 6e0 AND depth < 1e2")


@register("sample_rows", q("SELECT id, magnitude, place, time FROM quakes ORDER BY id LIMIT 5"))
def sample_rows(spark, sf_dir):
    return filters.sample_rows(catalogue(spark, sf_dir), 5, "id").select("id", "magnitude", "place", "time")


@register("row_count", q("SELECT count(*) AS n_rows FROM quakes"))
def row_count(spark, sf_dir):
    return summaries.row_count(catalogue(spark, sf_dir))


# ---------------------------------------------------------------- filters


@register("range_query", q(
    f"SELECT id, time, magnitude, place FROM quakes WHERE time BETWEEN TIMESTAMP '{RANGE_START}' "
    f"AND TIMESTAMP '{RANGE_END}' AND magnitude >= 2.5e0"))
def range_query(spark, sf_dir):
    return filters.range_query(catalogue(spark, sf_dir), RANGE_START, RANGE_END, 2.5) \
        .select("id", "time", "magnitude", "place")


@register("lookback_query", q(
    f"SELECT id, time, magnitude FROM quakes WHERE time >= TIMESTAMP '{AS_OF}' - INTERVAL 36 HOUR "
    f"AND time <= TIMESTAMP '{AS_OF}'"))
def lookback_query(spark, sf_dir):
    return filters.lookback(catalogue(spark, sf_dir), AS_OF, hours=36).select("id", "time", "magnitude")


@register("recent_days_query", q(
    f"SELECT id, time, magnitude FROM quakes WHERE time >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY "
    f"AND time <= TIMESTAMP '{AS_OF}' AND magnitude >= 2.5e0"))
def recent_days_query(spark, sf_dir):
    return filters.recent_days(catalogue(spark, sf_dir), AS_OF, days=7, min_magnitude=2.5) \
        .select("id", "time", "magnitude")


@register("place_search", q(
    "SELECT id, place FROM quakes WHERE coalesce(regexp_matches(place, '(?i)^1[0-9] KM S OF (VIEW|click)'), false)"))
def place_search(spark, sf_dir):
    return filters.place_search(catalogue(spark, sf_dir), "^1[0-9] KM S OF (VIEW|click)").select("id", "place")


@register("clean_rows", q(
    "SELECT id, magnitude, longitude, latitude, depth FROM quakes WHERE magnitude IS NOT NULL "
    "AND NOT isnan(magnitude) AND longitude IS NOT NULL AND NOT isnan(longitude) AND latitude IS NOT NULL "
    "AND NOT isnan(latitude) AND depth IS NOT NULL AND NOT isnan(depth)"))
def clean_rows(spark, sf_dir):
    return filters.drop_incomplete(catalogue(spark, sf_dir)) \
        .select("id", "magnitude", "longitude", "latitude", "depth")


# ---------------------------------------------------------------- regions

_SUM_SQL = """(CAST(longitude BETWEEN -170 AND -30 AND latitude BETWEEN 15 AND 90 AS INTEGER) * 1
 + CAST(longitude BETWEEN -85 AND -30 AND latitude BETWEEN -60 AND 15 AS INTEGER) * 2
 + CAST(longitude BETWEEN -30 AND 40 AND latitude BETWEEN 35 AND 90 AS INTEGER) * 3
 + CAST(longitude BETWEEN 40 AND 180 AND latitude BETWEEN 0 AND 90 AS INTEGER) * 4
 + CAST(longitude BETWEEN -30 AND 60 AND latitude BETWEEN -40 AND 35 AS INTEGER) * 5
 + CAST(longitude BETWEEN 110 AND 180 AND latitude BETWEEN -50 AND 0 AS INTEGER) * 6
 + CAST(NOT (longitude BETWEEN -170 AND 180 AND latitude BETWEEN -60 AND 90) AS INTEGER) * 7)"""

_FIRST_SQL = REGION_FIRST


def _name_sql(code: str) -> str:
    return (f"CASE {code} WHEN 1 THEN 'North America' WHEN 2 THEN 'South America' WHEN 3 THEN 'Europe' "
            f"WHEN 4 THEN 'Asia' WHEN 5 THEN 'Africa' WHEN 6 THEN 'Australia' "
            f"WHEN 7 THEN 'Pacific and Others' ELSE 'Unclassified' END")


@register("region_codes_sum", q(
    f"SELECT id, longitude, latitude, {_SUM_SQL} AS region_code FROM quakes"))
def region_codes_sum(spark, sf_dir):
    return catalogue(spark, sf_dir).select("id", "longitude", "latitude",
                                           regions.region_code(mode="sum").alias("region_code"))


@register("region_first_match", q(
    f"SELECT id, longitude, latitude, code AS region_code, {_name_sql('code')} AS region "
    f"FROM (SELECT *, {_FIRST_SQL} AS code FROM quakes) t"))
def region_first_match(spark, sf_dir):
    return regions.with_region(catalogue(spark, sf_dir), "first") \
        .select("id", "longitude", "latitude", "region_code", "region")


_REGION_SUMMARY_SQL = (
    "SELECT region, count(*) AS \"count\", round(avg(magnitude), 6) AS avg_magnitude, "
    "max(magnitude) AS max_magnitude, round(avg(depth), 6) AS avg_depth FROM "
    "(SELECT *, {name} AS region FROM (SELECT *, {code} AS code FROM quakes) t) r "
    "GROUP BY region ORDER BY \"count\" DESC, region")


@register("region_summary", q(_REGION_SUMMARY_SQL.format(name=_name_sql("code"), code=_FIRST_SQL)))
def region_summary(spark, sf_dir):
    return round_cols(regions.region_summary(catalogue(spark, sf_dir), "first"), ["avg_magnitude", "avg_depth"])


@register("region_summary_sum", q(_REGION_SUMMARY_SQL.format(name=_name_sql("code"), code=_SUM_SQL)))
def region_summary_sum(spark, sf_dir):
    return round_cols(regions.region_summary(catalogue(spark, sf_dir), "sum"), ["avg_magnitude", "avg_depth"])


# ---------------------------------------------------------------- magnitude summaries

_CLASS = "CAST(trunc(magnitude) AS INTEGER)"


@register("magnitude_describe", q(
    "SELECT count(magnitude) AS magnitude_count, round(avg(magnitude), 6) AS magnitude_mean, "
    "round(stddev_samp(magnitude), 6) AS magnitude_stddev, min(magnitude) AS magnitude_min, "
    "max(magnitude) AS magnitude_max FROM quakes"))
def magnitude_describe(spark, sf_dir):
    return round_cols(summaries.describe_magnitude(catalogue(spark, sf_dir)), ["magnitude_mean", "magnitude_stddev"])


@register("magnitude_class_counts", q(
    f"SELECT {_CLASS} AS magnitude_range, count(*) AS \"count\" FROM quakes GROUP BY 1 ORDER BY 1"))
def magnitude_class_counts(spark, sf_dir):
    return summaries.class_counts(catalogue(spark, sf_dir))


@register("depth_by_class", q(
    f"SELECT {_CLASS} AS magnitude_range, round(avg(depth), 6) AS avg_depth, count(*) AS \"count\" "
    "FROM quakes GROUP BY 1 ORDER BY 1"))
def depth_by_class(spark, sf_dir):
    return round_cols(summaries.depth_by_class(catalogue(spark, sf_dir)), ["avg_depth"])


@register("place_counts", q("SELECT place, count(*) AS \"count\" FROM quakes GROUP BY place"))
def place_counts(spark, sf_dir):
    return summaries.place_counts(catalogue(spark, sf_dir))


@register("top_places", q(
    "SELECT place, count(*) AS \"count\" FROM quakes GROUP BY place ORDER BY \"count\" DESC, place LIMIT 10"))
def top_places(spark, sf_dir):
    return summaries.top_places(catalogue(spark, sf_dir), 10)


_CLEAN = ("magnitude IS NOT NULL AND depth IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL")


@register("spatial_patterns", q(
    "SELECT place, round_even(round(avg(magnitude), 9), 2) AS magnitude_mean, count(magnitude) AS magnitude_count, "
    "round_even(round(max(magnitude), 9), 2) AS magnitude_max, round_even(round(avg(depth), 9), 2) AS depth_mean "
    f"FROM quakes WHERE {_CLEAN} AND place IS NOT NULL GROUP BY place"))
def spatial_patterns(spark, sf_dir):
    return summaries.spatial_patterns(catalogue(spark, sf_dir))


# ---------------------------------------------------------------- time series

_DAILY = ("SELECT CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month, "
          "CAST(day(time) AS INTEGER) AS day, count(*) AS earthquakes_count, "
          "round(avg(magnitude), 6) AS avg_magnitude FROM quakes GROUP BY 1, 2, 3")


@register("daily_series", q(_DAILY + " ORDER BY 1, 2, 3"))
def daily_series(spark, sf_dir):
    return round_cols(summaries.daily_series(catalogue(spark, sf_dir)), ["avg_magnitude"])


@register("first_days", q(_DAILY + " ORDER BY 1, 2, 3 LIMIT 10"))
def first_days(spark, sf_dir):
    return round_cols(summaries.first_days(catalogue(spark, sf_dir), 10), ["avg_magnitude"])


@register("last_days", q(_DAILY + " ORDER BY 1 DESC, 2 DESC, 3 DESC LIMIT 10"))
def last_days(spark, sf_dir):
    return round_cols(summaries.last_days(catalogue(spark, sf_dir), 10), ["avg_magnitude"])


@register("hourly_series", q(
    "SELECT CAST(hour(time) AS INTEGER) AS hour, count(*) AS earthquakes_count FROM quakes GROUP BY 1 ORDER BY 1"))
def hourly_series(spark, sf_dir):
    return summaries.hourly_series(catalogue(spark, sf_dir))


@register("hour_counts", q(
    "SELECT CAST(hour(time) AS INTEGER) AS hour, count(*) AS \"count\" FROM quakes GROUP BY 1 ORDER BY 1"))
def hour_counts(spark, sf_dir):
    return summaries.hour_counts(catalogue(spark, sf_dir), source="hour")


@register("hour_frequency", q(
    "SELECT CAST(hour(time) AS INTEGER) AS hour, count(*) AS \"count\" FROM quakes "
    "WHERE time IS NOT NULL GROUP BY 1 ORDER BY 1"))
def hour_frequency(spark, sf_dir):
    return summaries.hour_counts(catalogue(spark, sf_dir), source="time", keep_null=False)


@register("hourly_patterns", q(
    "SELECT CAST(hour(time) AS INTEGER) AS hour, round_even(round(avg(magnitude), 9), 2) AS magnitude_mean, "
    "count(magnitude) AS magnitude_count, round_even(round(avg(depth), 9), 2) AS depth_mean "
    f"FROM quakes WHERE {_CLEAN} AND time IS NOT NULL GROUP BY 1 ORDER BY 1"))
def hourly_patterns(spark, sf_dir):
    return summaries.hourly_patterns(catalogue(spark, sf_dir))


# ---------------------------------------------------------------- KPI, centre, display


@register("kpi_row", q(
    "SELECT count(*) AS total_events, round(avg(magnitude), 6) AS avg_magnitude, "
    "max(magnitude) AS max_magnitude, round(avg(depth), 6) AS avg_depth, "
    "printf('%.2f', avg(magnitude)) AS avg_magnitude_text, printf('%.2f', max(magnitude)) AS max_magnitude_text, "
    "printf('%.2f', avg(depth)) || ' km' AS avg_depth_text FROM quakes"))
def kpi_row(spark, sf_dir):
    return round_cols(summaries.kpi_row(catalogue(spark, sf_dir)), ["avg_magnitude", "avg_depth"])


@register("map_center", q(
    "SELECT round(avg(latitude), 6) AS center_latitude, round(avg(longitude), 6) AS center_longitude "
    "FROM quakes WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND magnitude IS NOT NULL"))
def map_center(spark, sf_dir):
    return round_cols(summaries.map_center(catalogue(spark, sf_dir)), ["center_latitude", "center_longitude"])


@register("mean_depth_clean", q(
    f"SELECT round(avg(depth), 6) AS mean_depth FROM quakes WHERE {_CLEAN}"))
def mean_depth_clean(spark, sf_dir):
    return round_cols(summaries.mean_depth(catalogue(spark, sf_dir)), ["mean_depth"])


@register("severity_bands", q(
    "SELECT id, magnitude, CASE WHEN magnitude < 2e0 THEN 'green' WHEN magnitude < 4e0 THEN 'blue' "
    "WHEN magnitude < 6e0 THEN 'orange' WHEN magnitude IS NOT NULL THEN 'red' END AS map_band, "
    "CASE WHEN magnitude < 1e0 THEN 'green' WHEN magnitude < 3e0 THEN 'blue' "
    "WHEN magnitude < 5e0 THEN 'orange' WHEN magnitude IS NOT NULL THEN 'red' END AS chart_band, "
    "strftime(time, '%Y-%m-%d %H:%M:%S') AS time_text FROM quakes"))
def severity_bands(spark, sf_dir):
    return catalogue(spark, sf_dir).select(
        "id", "magnitude", severity_band("magnitude", MAP_BANDS).alias("map_band"),
        severity_band("magnitude", CHART_BANDS).alias("chart_band"), ts_text("time").alias("time_text"))


@register("map_rows", q(
    "SELECT id, latitude, longitude, magnitude * 1.5e0 AS radius, "
    "CASE WHEN magnitude < 2e0 THEN 'green' WHEN magnitude < 4e0 THEN 'blue' "
    "WHEN magnitude < 6e0 THEN 'orange' ELSE 'red' END AS color, "
    "'<strong>Magnitude:</strong> ' || coalesce(CAST(magnitude AS VARCHAR), 'unknown') || '<br><strong>Location:</strong> ' "
    "|| coalesce(place, 'unknown') || '<br><strong>Depth:</strong> ' || coalesce(CAST(depth AS VARCHAR), 'unknown') "
    "|| ' km<br><strong>Time:</strong> ' || coalesce(strftime(time, '%Y-%m-%d %H:%M:%S'), 'unknown') || '<br>' AS popup "
    "FROM quakes WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND magnitude IS NOT NULL"))
def map_rows(spark, sf_dir):
    return jobs.map_rows(catalogue(spark, sf_dir))


@register("map_center_all_rows", q(
    "SELECT round(avg(latitude), 6) AS center_latitude, round(avg(longitude), 6) AS center_longitude FROM quakes"))
def map_center_all_rows(spark, sf_dir):
    return round_cols(summaries.map_center(catalogue(spark, sf_dir), complete=False), ["center_latitude", "center_longitude"])
