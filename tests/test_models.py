import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from seisflow.operators import common, features, isolation, models
from seisflow.sources.fixture import load_catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def cat(spark):
    return load_catalogue(spark, SF).persist()


def test_standardizer_population_std(spark, cat):
    z, scaler = features.standardize(cat, features.PATTERN_FEATURES)
    pdf = z.select(*[f"{c}_z" for c in features.PATTERN_FEATURES]).toPandas()
    assert np.allclose(pdf.mean().to_numpy(), 0, atol=1e-12)
    assert np.allclose(pdf.std(ddof=0).to_numpy(), 1, atol=1e-12)
    const = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    s = features.fit_standardizer(const, ["v"])
    assert [r[0] for r in s.transform(const).select("v_z").collect()] == [0.0, 0.0]


def test_hash_split_is_deterministic(spark, cat):
    a = features.hash_split(cat.repartition(1), "id").select("id", "split")
    b = features.hash_split(cat.repartition(7), "id").select("id", "split")
    assert a.exceptAll(b).count() == 0
    share = a.where(F.col("split") == "train").count() / a.count()
    assert 0.7 < share < 0.9


def test_kmeans_invariants(spark, cat):
    model, pred, silhouette, centers = models.kmeans_raw(cat, k=5, seed=42)
    pdf = pred.select(vector_to_array("features").alias("f"), "prediction").toPandas()
    X = np.stack(pdf.f.to_numpy())
    C = np.array(model.clusterCenters())
    nearest = ((X[:, None, :] - C[None]) ** 2).sum(-1).argmin(1)
    assert (nearest == pdf.prediction.to_numpy()).all()
    assert len(pdf) == cat.dropna(subset=["magnitude", "longitude", "latitude", "depth"]).count()
    assert -1.0 <= silhouette <= 1.0 and centers.count() == 5


def test_nearest_center_matches_numpy(spark, cat):
    cols = ["magnitude", "longitude", "latitude", "depth"]
    clean = cat.dropna(subset=cols)
    centres = [[1.0, 0.0, 0.0, 100.0], [5.0, 100.0, 20.0, 300.0], [3.0, -100.0, -20.0, 600.0]]
    pdf = models.assign_clusters(clean, cols, centres).select(*cols, "prediction").toPandas()
    d = ((pdf[cols].to_numpy()[:, None, :] - np.array(centres)[None]) ** 2).sum(-1)
    assert (d.argmin(1) == pdf.prediction.to_numpy()).all()


def test_pca_ratio_matches_eigen(spark, cat):
    out, ratio = models.pca_components(cat, k=2)
    Z = features.standardize(cat, features.PATTERN_FEATURES)[0] \
        .select(*[f"{c}_z" for c in features.PATTERN_FEATURES]).toPandas().to_numpy()
    ev = np.sort(np.linalg.eigvalsh(np.cov(Z.T, ddof=1)))[::-1]
    assert np.allclose(ratio, ev[:2] / ev.sum(), rtol=1e-6)
    assert sum(ratio) <= 1.0 + 1e-12 and out.count() == Z.shape[0]


def test_unregularised_linear_model_equals_closed_form(spark, cat):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    df = cat.dropna(subset=["depth", "latitude"]).withColumn(
        "label_lin", F.lit(2.0) + F.col("depth") * 4e-3 + F.col("latitude") * 1e-2)
    fit = models.linear_fit(df, "label_lin", "depth").first()
    lr = LinearRegression(featuresCol="f", labelCol="label_lin", regParam=0.0, solver="normal").fit(
        VectorAssembler(inputCols=["depth"], outputCol="f").transform(df))
    assert lr.coefficients[0] == pytest.approx(fit["slope"], rel=1e-9)
    assert lr.intercept == pytest.approx(fit["intercept"], rel=1e-9)


def test_elastic_net_reports_train_and_test(spark, cat):
    _, test, metrics = models.elastic_net(cat)
    m = {r["split"]: r for r in metrics.collect()}
    assert set(m) == {"train", "test"} and m["train"]["n"] + m["test"]["n"] == cat.dropna(
        subset=["latitude", "longitude", "depth", "magnitude"]).count()
    assert test.count() == m["test"]["n"]


def test_forest_predictions(spark, cat):
    _, out = models.forest_magnitude(cat, trees=10, max_depth=5)
    pdf = out.select("magnitude", "predicted_magnitude", "magnitude_error").toPandas()
    assert pdf.predicted_magnitude.between(pdf.magnitude.min(), pdf.magnitude.max()).all()
    assert pdf.magnitude_error.mean() < (pdf.magnitude - pdf.magnitude.mean()).abs().mean()
    assert np.allclose(pdf.magnitude_error, (pdf.magnitude - pdf.predicted_magnitude).abs())


def test_forest_levels_go_on_from_the_nodes_reached(spark, cat):
    feats = ["depth", "latitude", "longitude"]
    rows = cat.dropna(subset=[*feats, "magnitude"]).select("id", "magnitude", *feats).coalesce(1).sortWithinPartitions("id")
    pipe = models.forest_pipeline(feats, trees=5, max_depth=6)
    assert pipe.getStages()[-1].getCacheNodeIds()
    walked = models.forest_pipeline(feats, trees=5, max_depth=6)
    walked.getStages()[-1].setCacheNodeIds(False)
    trees = lambda p: p.fit(rows).stages[-1].toDebugString.split("\n", 1)[1]
    assert trees(pipe) == trees(walked)


def test_forest_scores_rows_of_one_file_in_many_tasks(spark, cat):
    one = cat.coalesce(1)
    _, out = models.forest_magnitude(one, trees=3, max_depth=3)
    assert out.rdd.getNumPartitions() >= common.FIT_PARTITIONS
    scan = out.select("predicted_magnitude")._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in scan and "place" not in scan.split("Repartition")[0]
    assert out.count() == cat.dropna(subset=["depth", "latitude", "longitude", "magnitude"]).count()


def test_anomaly_scores_of_one_file_in_many_tasks(spark, cat):
    out = isolation.detect_anomalies(cat.coalesce(1), trees=5)
    assert out.rdd.getNumPartitions() >= common.FIT_PARTITIONS


def test_isolation_forest(spark, cat):
    out = isolation.detect_anomalies(cat, contamination=0.1, trees=50)
    pdf = out.select("id", "anomaly_score", "is_anomaly").toPandas()
    share = (pdf.is_anomaly == -1).mean()
    assert 0.08 <= share <= 0.11
    assert pdf.anomaly_score.between(0, 1).all()
    # the most isolated rows are the ones labelled
    assert pdf[pdf.is_anomaly == -1].anomaly_score.min() >= pdf[pdf.is_anomaly == 1].anomaly_score.max()
    again = isolation.detect_anomalies(cat.repartition(3), contamination=0.1, trees=50)
    pdf2 = again.select("id", "anomaly_score").toPandas().set_index("id").loc[pdf.id]
    assert np.allclose(pdf2.anomaly_score.to_numpy(), pdf.anomaly_score.to_numpy())


def test_isolation_forest_scores_outlier_highest(spark):
    rng = np.random.default_rng(0)
    pts = [(f"p{i}", float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (500, 2)))]
    pts.append(("far", 25.0, 25.0))
    df = spark.createDataFrame(pts, "id string, a double, b double")
    model = isolation.fit_isolation_forest(df, ["a", "b"], key="id", trees=50)
    scored = model.score(df).orderBy(F.desc("anomaly_score")).first()
    assert scored.id == "far" and scored.anomaly_score > 0.6
    assert isolation.average_path([256])[0] == pytest.approx(10.244770920, rel=1e-6)


def test_models_reload_give_same_results(spark, cat, tmp_dir):
    from pyspark.ml.clustering import KMeansModel
    model, pred, _, _ = models.kmeans_raw(cat, k=3, seed=1)
    models.save_model(model, tmp_dir + "/km")
    again = KMeansModel.load(tmp_dir + "/km").transform(pred.drop("prediction"))
    assert again.select("id", "prediction").exceptAll(pred.select("id", "prediction")).count() == 0

    z = features.standardize(cat, features.PATTERN_FEATURES)[0]
    zc = [f"{c}_z" for c in features.PATTERN_FEATURES]
    forest = isolation.fit_isolation_forest(z, zc, key="id", trees=20)
    forest.save(spark, tmp_dir + "/iforest")
    back = isolation.IsolationForestModel.load(spark, tmp_dir + "/iforest")
    a = forest.score(z).select("id", "anomaly_score").toPandas().set_index("id").sort_index()
    b = back.score(z).select("id", "anomaly_score").toPandas().set_index("id").sort_index()
    assert np.allclose(a.anomaly_score, b.anomaly_score)
