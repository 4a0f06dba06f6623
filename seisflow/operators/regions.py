"""Bounding-box region labels (B8, B9) and the region summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Region boxes (code, name, longitude range, latitude range), closed
# intervals.  Code 7 is the complement of the box lon -170..180, lat -60..90.
REGION_BOXES = (
    (1, "North America", (-170, -30), (15, 90)),
    (2, "South America", (-85, -30), (-60, 15)),
    (3, "Europe", (-30, 40), (35, 90)),
    (4, "Asia", (40, 180), (0, 90)),
    (5, "Africa", (-30, 60), (-40, 35)),
    (6, "Australia", (110, 180), (-50, 0)),
    (7, "Pacific and Others", (-170, 180), (-60, 90)),
)
COMPLEMENT_CODE = 7
UNCLASSIFIED = "Unclassified"


def _in_box(code: int, lon_rng, lat_rng, lon: Column, lat: Column) -> Column:
    inside = lon.between(lon_rng[0], lon_rng[1]) & lat.between(lat_rng[0], lat_rng[1])
    return ~inside if code == COMPLEMENT_CODE else inside


def region_code(lon: str = "longitude", lat: str = "latitude", mode: str = "first") -> Column:
    """B8.

    ``first``: the first box in code order that contains the point, else 0.
    ``sum``: Σ code × [point in box] with SQL three-valued logic — overlapping
    boxes add up, exactly as the summed-indicator formula does.
    """
    lo, la = F.col(lon), F.col(lat)
    if mode == "sum":
        total = None
        for code, _, lon_rng, lat_rng in REGION_BOXES:
            term = _in_box(code, lon_rng, lat_rng, lo, la).cast("int") * code
            total = term if total is None else total + term
        return total
    if mode != "first":
        raise ValueError("mode must be 'first' or 'sum'")
    expr = None
    for code, _, lon_rng, lat_rng in REGION_BOXES:
        cond = _in_box(code, lon_rng, lat_rng, lo, la)
        expr = F.when(cond, code) if expr is None else expr.when(cond, code)
    return expr.otherwise(0)


def region_name(code: Column) -> Column:
    """Code → name; any other code (0, overlaps in ``sum`` mode, null) → Unclassified."""
    expr = None
    for c, name, _, _ in REGION_BOXES:
        expr = F.when(code == c, name) if expr is None else expr.when(code == c, name)
    return expr.otherwise(UNCLASSIFIED)


def with_region(df: DataFrame, mode: str = "first") -> DataFrame:
    code = region_code(mode=mode)
    return df.withColumn("region_code", code).withColumn("region", region_name(F.col("region_code")))


def region_summary(df: DataFrame, mode: str = "first") -> DataFrame:
    """Per region: events, mean and max magnitude, mean depth; most events first."""
    return (with_region(df, mode)
            .groupBy("region")
            .agg(F.count(F.lit(1)).alias("count"),
                 F.avg("magnitude").alias("avg_magnitude"),
                 F.max("magnitude").alias("max_magnitude"),
                 F.avg("depth").alias("avg_depth"))
            .orderBy(F.desc("count"), F.asc("region")))
