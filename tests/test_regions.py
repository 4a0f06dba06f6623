import pytest
from pyspark.sql import functions as F

from seisflow.operators.regions import region_code, region_name, region_summary, with_region

# (longitude, latitude, code in sum mode) — box edges and overlaps.
SUM_CASES = [
    (-60.0, 15.0, 3), (-30.0, 15.0, 8), (-30.0, 20.0, 6), (-30.0, 50.0, 4), (-30.0, 35.0, 9), (-30.0, 0.0, 7),
    (40.0, 50.0, 7), (40.0, 35.0, 12), (40.0, 10.0, 9), (0.0, 35.0, 8), (120.0, 0.0, 10), (-150.0, 0.0, 0),
    (80.0, -20.0, 0), (-175.0, 0.0, 7), (None, 0.0, None), (None, -70.0, 7), (100.0, None, None), (-175.0, None, 7),
]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "longitude double, latitude double")


def test_sum_mode_codes(spark):
    df = _frame(spark, [(a, b) for a, b, _ in SUM_CASES]).withColumn("c", region_code(mode="sum"))
    got = [r["c"] for r in df.collect()]
    assert got == [c for _, _, c in SUM_CASES]


def test_first_mode_takes_first_box(spark):
    rows = [(-100.0, 40.0), (-60.0, 10.0), (10.0, 50.0), (100.0, 30.0), (20.0, 0.0), (130.0, -20.0),
            (-175.0, 0.0), (-150.0, 0.0), (-30.0, 15.0), (None, None)]
    df = with_region(_frame(spark, rows), "first")
    got = [(r["region_code"], r["region"]) for r in df.collect()]
    assert got == [(1, "North America"), (2, "South America"), (3, "Europe"), (4, "Asia"), (5, "Africa"),
                   (6, "Australia"), (7, "Pacific and Others"), (0, "Unclassified"), (1, "North America"),
                   (0, "Unclassified")]


def test_overlap_codes_are_unclassified_by_name(spark):
    df = spark.createDataFrame([(9,), (12,), (None,)], "c int").select(region_name(F.col("c")).alias("n"))
    assert [r["n"] for r in df.collect()] == ["Unclassified"] * 3


def test_region_summary_orders_by_count(spark):
    rows = [(-100.0, 40.0, 5.0, 10.0)] * 3 + [(10.0, 50.0, 3.0, 20.0)]
    df = spark.createDataFrame(rows, "longitude double, latitude double, magnitude double, depth double")
    out = region_summary(df).collect()
    assert [(r["region"], r["count"]) for r in out] == [("North America", 3), ("Europe", 1)]
    assert out[0]["avg_magnitude"] == pytest.approx(5.0) and out[1]["max_magnitude"] == 3.0
