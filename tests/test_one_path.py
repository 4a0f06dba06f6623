"""One path at every size and placement: exact order statistics, fits that ignore partitioning, nothing left cached."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seisflow.functions.display import forecast_colour, forecast_popup, popup_text
from seisflow.operators import common, features, forecast, isolation, models, zones
from seisflow.sources.catalogue import require_columns
from seisflow.sources.fixture import load_catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def cat(spark):
    return load_catalogue(spark, SF)


def cached(spark) -> int:
    return spark.sparkContext._jsc.getPersistentRDDs().size()


@pytest.mark.parametrize("few", [4096, 3])
def test_order_statistic_is_exact(spark, few):
    rng = np.random.default_rng(0)
    for values in (rng.normal(size=997), rng.integers(0, 5, 400).astype(float), np.array([2.5]), np.array([1.0, 1e300, -1e300, 0.0])):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(5)
        for fraction in (0.0, 0.1, 0.5, 0.37, 1.0):
            assert common.order_statistic(df, "v", fraction, bins=7, few=few) == pytest.approx(np.quantile(values, fraction), rel=1e-12)
    assert common.order_statistic(spark.createDataFrame([], "v double"), "v", 0.5) is None


def test_anomaly_labels_do_not_depend_on_placement(spark, cat, monkeypatch):
    def labels(parts):
        out = isolation.detect_anomalies(cat.repartition(parts), contamination=0.1, trees=30)
        return {r.id: r.is_anomaly for r in out.select("id", "is_anomaly").collect()}
    want = labels(1)
    assert labels(4) == want and labels(8) == want
    # The narrowing passes run here too: the few values that are read at once are cut to a handful.
    monkeypatch.setattr(isolation, "order_statistic", lambda df, c, f: common.order_statistic(df, c, f, bins=5, few=4))
    assert labels(3) == want


def test_fits_do_not_depend_on_placement(cat):
    def fitted(parts):
        rows = cat.repartition(parts)
        model, _, silhouette, _ = models.kmeans_raw(rows, k=4, seed=7, partitions=6)
        _, out = models.forest_magnitude(rows, trees=5, max_depth=4, partitions=6)
        return (np.round(np.array(model.clusterCenters()), 6).tolist(), round(silhouette, 6),
                {r.id: round(r.predicted_magnitude, 6) for r in out.select("id", "predicted_magnitude").collect()})
    want = fitted(1)
    assert fitted(4) == want and fitted(8) == want


def test_scaled_clusters_converge(cat):
    model, out, stats = models.kmeans_scaled(cat, k=4, seed=1)
    assert model.summary.numIter < 300 and stats.count() == 4
    assert out.count() == cat.dropna(subset=features.PATTERN_FEATURES).count()


def test_nothing_stays_cached(spark, cat):
    spark.catalog.clearCache()
    before = cached(spark)
    models.kmeans_raw(cat, k=3)
    models.kmeans_scaled(cat, k=3)
    models.elastic_net(cat)
    models.forest_magnitude(cat, trees=3, max_depth=3)
    isolation.detect_anomalies(cat, trees=5)
    models.pca_components(cat)
    zones.active_zones(cat, eps=0.1, order_col="event_id").count()
    assert cached(spark) == before


def test_anomaly_scoring_reads_feature_columns_only(cat):
    plan = isolation.detect_anomalies(cat, trees=5).select("id", "anomaly_score")._jdf.queryExecution().executedPlan().toString()
    scan = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "event_type" not in scan and "ts" not in scan


def test_empty_catalogue(spark, cat):
    none = cat.limit(0)
    assert zones.active_zones(none, order_col="event_id").count() == 0
    assert forecast.predict_future(none, order_col="event_id").columns == ["latitude", "longitude", "predicted_magnitude", "confidence", "zone"]
    assert isolation.detect_anomalies(none).columns[-2:] == ["anomaly_score", "is_anomaly"] and isolation.detect_anomalies(none).count() == 0
    model, out, stats = models.kmeans_scaled(none)
    assert model is None and out.count() == 0 and stats.count() == 0
    rows, ratio = models.pca_components(none)
    assert rows.count() == 0 and ratio == []


def test_required_columns(cat):
    require_columns(cat, ["id", "magnitude"])
    with pytest.raises(Exception, match="nothing_of_the_kind"):
        require_columns(cat, ["id", "nothing_of_the_kind"])


def test_repeated_ids_keep_their_rows(spark):
    rows = [("a", 0.0, 0.0), ("a", 0.1, 0.0), ("b", 0.0, 0.1), ("a", 9.0, 9.0), ("a", 9.0, 9.0), ("c", 9.1, 9.0), ("a", 50.0, 50.0)]
    df = spark.createDataFrame(rows, "id string, x double, y double")
    got = sorted((r.x, r.zone) for r in zones.dbscan(df, "x", "y", "id", eps=1.0).collect())
    assert got == [(0.0, 0), (0.0, 0), (0.1, 0), (9.0, 1), (9.0, 1), (9.1, 1), (50.0, -1)]


def test_popups_and_colours(spark):
    df = spark.createDataFrame([(None, None, None, None)], "magnitude double, place string, depth double, time timestamp")
    assert df.select(popup_text().alias("p")).first().p == ("<strong>Magnitude:</strong> unknown<br><strong>Location:</strong> unknown<br>"
                                                            "<strong>Depth:</strong> unknown km<br><strong>Time:</strong> unknown<br>")
    rows = [("High", 6.0), ("High", 5.0), ("High", 4.9), ("Medium", 6.1), ("Medium", 5.9), ("Medium", 4.0)]
    df = spark.createDataFrame([(c, p, 3) for c, p in rows], "confidence string, predicted_magnitude double, zone int")
    got = df.select(forecast_colour().alias("c"), forecast_popup().alias("p")).collect()
    assert [r.c for r in got] == ["red", "orange", "yellow", "lightred", "lightorange", "lightyellow"]
    assert got[1].p == "<strong>Predicted Magnitude:</strong> 5.0<br><strong>Confidence:</strong> High<br><strong>Zone:</strong> 3"


def test_long_look_back(cat):
    from seisflow.operators.filters import recent_days
    assert recent_days(cat, "2030-01-01 00:00:00", days=4000, min_magnitude=-1).count() > 0
