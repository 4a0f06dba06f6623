import pytest
from pyspark.sql import functions as F

from seisflow.operators import forecast


def test_grid_sizes_and_bounds(spark):
    zones = spark.createDataFrame([(0, 4, 5.0, 10.0, 20.0), (1, 100, 6.0, -5.0, 30.0)],
                                  "zone int, magnitude_count long, magnitude_max double, latitude_mean double, "
                                  "longitude_mean double")
    g = forecast.forecast_grid(zones, depth=12.0).toPandas()
    sizes = g.groupby("zone").size().to_dict()
    assert sizes == {0: 25, 1: 225}
    z0 = g[g.zone == 0]
    assert z0.latitude.min() == pytest.approx(9.7) and z0.latitude.max() == 10.3
    assert (g.depth == 12.0).all()


def test_table_cap_threshold_confidence(spark):
    rows = [(0, 20, 5.0, 1.0, 2.0, 7.0),   # capped to 6.0, above max → Medium
            (0, 20, 5.0, 1.0, 2.0, 4.5),   # High
            (1, 5, 5.0, 1.0, 2.0, 4.5),    # count ≤ 10 → Medium
            (1, 5, 5.0, 1.0, 2.0, 3.9)]    # below threshold → dropped
    df = spark.createDataFrame(rows, "zone int, magnitude_count long, magnitude_max double, latitude double, "
                                     "longitude double, prediction double")
    out = forecast.forecast_table(df).collect()
    assert [(r.predicted_magnitude, r.confidence, r.zone) for r in out] == [
        (6.0, "Medium", 0), (4.5, "High", 0), (4.5, "Medium", 1)]


def test_bucket_and_confidence_counts(spark):
    df = spark.createDataFrame([(4.0, "High"), (4.5, "High"), (5.0, "Medium"), (6.5, "Medium"), (5.5, "Medium")],
                               "predicted_magnitude double, confidence string")
    b = [(r.bucket, r["count"]) for r in forecast.bucket_counts(df).collect()]
    assert b == [("4.0-4.9", 2), ("5.0-5.9", 1), ("6.0+", 1)]
    c = [(r.confidence, r["count"]) for r in forecast.confidence_counts(df).collect()]
    assert c == [("Medium", 3), ("High", 2)]


def test_predict_future_end_to_end(spark):
    from seisflow.sources.fixture import load_catalogue
    cat = load_catalogue(spark, "/root/testdata/sf0.001")
    out = forecast.predict_future(cat, eps=0.1, order_col="event_id", trees=10, max_depth=5).toPandas()
    assert list(out.columns) == ["latitude", "longitude", "predicted_magnitude", "confidence", "zone"]
    assert (out.predicted_magnitude >= 4.0).all() and set(out.confidence) <= {"High", "Medium"}
