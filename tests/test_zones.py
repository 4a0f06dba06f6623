import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import dbscan_sequential
from seisflow.operators.zones import active_zones, dbscan, zone_stats
from seisflow.sources.fixture import load_catalogue


def _compare(spark, pdf, eps, min_samples, partitions=4, sub=8):
    df = spark.createDataFrame(pdf).repartition(partitions)
    out = dbscan(df, "x", "y", "k", eps=eps, min_samples=min_samples, sub=sub).select("k", "zone").toPandas()
    got = out.set_index("k").loc[pdf.k, "zone"].to_numpy()
    ref, _ = dbscan_sequential(pdf[["x", "y"]].to_numpy(), eps, min_samples)
    return got, ref


def test_border_point_takes_smaller_cluster(spark):
    import pandas as pd
    # Two clusters; point 99 is within eps of a core point of each, not core itself.
    pts = [(0, 0.0, 0.0), (1, 0.1, 0.0), (2, 0.2, 0.0), (3, 3.0, 0.0), (4, 3.1, 0.0), (5, 3.2, 0.0),
           (99, 1.1, 0.0), (7, 10.0, 10.0)]
    pdf = pd.DataFrame(pts, columns=["k", "x", "y"])
    got, ref = _compare(spark, pdf, eps=0.95, min_samples=3)
    assert list(got) == list(ref) == [0, 0, 0, 1, 1, 1, 0, -1]


@pytest.mark.parametrize("eps,parts", [(0.1, 1), (0.1, 8), (0.3, 3)])
def test_dbscan_matches_brute_force(spark, eps, parts):
    cat = load_catalogue(spark, "/root/testdata/sf0.001").where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    pdf = cat.select(F.col("event_id").alias("k"), "latitude", "longitude").orderBy("k").toPandas()
    X = pdf[["latitude", "longitude"]].to_numpy()
    Z = (X - X.mean(0)) / X.std(0)
    pdf = pdf.assign(x=Z[:, 0], y=Z[:, 1])[["k", "x", "y"]]
    got, ref = _compare(spark, pdf, eps=eps, min_samples=3, partitions=parts)
    assert (got == ref).all()


@pytest.mark.parametrize("sub", [1, 2])
def test_point_level_edge_checks(spark, sub):
    # Coarse sub-cells leave many cell pairs undecided by boxes, exercising the point-pair path.
    cat = load_catalogue(spark, "/root/testdata/sf0.001").where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    pdf = cat.select(F.col("event_id").alias("k"), F.col("latitude").alias("x"), F.col("longitude").alias("y")) \
        .orderBy("k").toPandas()
    got, ref = _compare(spark, pdf, eps=2.0, min_samples=4, sub=sub)
    assert (got == ref).all()


def test_duplicates_and_dense_cells(spark):
    import pandas as pd
    rng = np.random.default_rng(7)
    base = rng.normal(0, 1, (300, 2)).round(1)          # many exact duplicates
    pdf = pd.DataFrame({"k": np.arange(300), "x": base[:, 0], "y": base[:, 1]})
    got, ref = _compare(spark, pdf, eps=0.25, min_samples=5)
    assert (got == ref).all()


def test_active_zones_and_stats(spark):
    cat = load_catalogue(spark, "/root/testdata/sf0.001")
    zoned = active_zones(cat, eps=0.1, min_samples=3, order_col="event_id")
    stats = zone_stats(zoned).toPandas()
    assert (stats.magnitude_count >= 3).all() and len(stats) >= 1
    assert zoned.count() == cat.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).count()
