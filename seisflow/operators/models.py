"""Spark ML models and their SQL-checkable parts.

Linear models and components come from moments (one pass). Iterative
estimators (k-means, forests) come from Spark ML, which keeps the data
distributed and only moves model-sized state (centres, split statistics)
through the driver.  The key and the features are
persisted while a fit runs, because every iteration rescans them, and released
when it ends.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from seisflow.operators.common import fit_partitions, placed, spread
from seisflow.operators.features import (CLUSTER_FEATURES, LOCATION_FEATURES, PATTERN_FEATURES,
                                         fit_standardizer, hash_split, prepare_features)
from seisflow.operators.filters import drop_incomplete
from seisflow.operators.moments import fit_components, fit_elastic_net
from seisflow.operators.summaries import group_stats


# ----------------------------------------------------------------------------- nearest centre (H3)

def nearest_center(cols, centers) -> Column:
    """H3: index of the nearest centre by squared Euclidean distance (lowest index on ties)."""
    dists = []
    for c in centers:
        d = None
        for name, v in zip(cols, c):
            t = F.pow(F.col(name) - F.lit(float(v)), 2)
            d = t if d is None else d + t
        dists.append(d)
    best = F.least(*dists) if len(dists) > 1 else dists[0]
    expr = None
    for i, d in enumerate(dists):
        expr = F.when(d == best, i) if expr is None else expr.when(d == best, i)
    return expr


def assign_clusters(df: DataFrame, cols, centers, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, nearest_center(cols, centers))


def group_centers(df: DataFrame, key: str, cols) -> list:
    """Mean feature vector per group, in key order (a handful of rows)."""
    rows = df.groupBy(key).agg(*[F.avg(c).alias(c) for c in cols]).orderBy(key).collect()
    return [[r[c] for c in cols] for r in rows]


# ----------------------------------------------------------------------------- k-means

def _fit_placed(estimator, df: DataFrame, key: str, partitions: int | None, evaluate=None):
    """Fit on rows of fixed placement, held only while fitting; returns (model, what ``evaluate`` gives)."""
    held = placed(df, key, partitions or fit_partitions(df)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = estimator.fit(held)
        return model, evaluate(model, held) if evaluate else None
    finally:
        held.unpersist()


def kmeans_raw(df: DataFrame, k: int = 5, seed: int = 42, max_iter: int = 20, partitions: int | None = None):
    """H2/H4/H5: k-means on raw (magnitude, longitude, latitude, depth).

    Returns (model, predictions of id and features, silhouette, centres frame).  ``partitions`` (by default from
    the number of rows) is part of the model's definition, like the seed; the rows' own partitioning and the cluster's
    size are not.
    """
    feats = prepare_features(df.select("id", *CLUSTER_FEATURES), CLUSTER_FEATURES)
    model, silhouette = _fit_placed(KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features"), feats, "id", partitions,
                                    lambda m, rows: ClusteringEvaluator(featuresCol="features").evaluate(m.transform(rows)))
    spark = df.sparkSession
    centers = spark.createDataFrame(
        [(i, *[float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
        "prediction int, " + ", ".join(f"{c} double" for c in CLUSTER_FEATURES))
    return model, model.transform(feats), silhouette, centers


def clustered_table(pred: DataFrame) -> DataFrame:
    """H6: the table written for the cluster map."""
    return pred.select("id", "magnitude", "longitude", "latitude", "depth", "prediction")


def kmeans_scaled(df: DataFrame, k: int = 5, seed: int = 42, max_iter: int = 300, partitions: int | None = None):
    """H11 + C10: k-means on population-z-scored features; returns (model, rows with cluster, stats).

    ``model.summary.numIter`` below ``max_iter`` says that it converged.  No complete rows: (None, empty, empty).
    """
    clean = drop_incomplete(df, PATTERN_FEATURES)
    scaler = fit_standardizer(clean, PATTERN_FEATURES)
    zcols = [f"{c}_z" for c in PATTERN_FEATURES]
    assemble = VectorAssembler(inputCols=zcols, outputCol="features")
    if scaler.means[0] is None:
        model, out = None, scaler.transform(clean, suffix="_z").withColumn("cluster", F.lit(None).cast("int"))
    else:
        narrow = assemble.transform(scaler.transform(clean.select("id", *PATTERN_FEATURES), suffix="_z")).select("id", "features")
        model, _ = _fit_placed(KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster"), narrow, "id", partitions)
        out = model.transform(assemble.transform(scaler.transform(clean, suffix="_z"))).drop("features")
    stats = group_stats(out, "cluster", {"magnitude": ["mean", "min", "max", "count"], "depth": ["mean"]})
    return model, out, stats


# ----------------------------------------------------------------------------- PCA

def pca_components(df: DataFrame, k: int = 2):
    """PCA on standardised features, from one pass of their covariances.

    Returns (rows with pca1..pcak, explained variance ratio list).  Component
    signs are fixed so the largest-magnitude loading is positive.
    """
    clean = drop_incomplete(df, PATTERN_FEATURES)
    scaler = fit_standardizer(clean, PATTERN_FEATURES)
    if scaler.means[0] is None:
        return clean.select("*", *[F.lit(None).cast("double").alias(f"pca{j + 1}") for j in range(k)]), []
    z = scaler.transform(clean, suffix="_z")
    fit = fit_components(z, [f"{c}_z" for c in PATTERN_FEATURES], k)
    return fit.transform(z).select(*df.columns, *[f"pca{j + 1}" for j in range(k)]), list(fit.ratios)


def covariance_matrix(df: DataFrame, cols) -> DataFrame:
    """Population covariance of every column pair, one row (``cov_<a>_<b>``)."""
    aggs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append(F.covar_pop(a, b).alias(f"cov_{a}_{b}"))
    return df.agg(*aggs)


# ----------------------------------------------------------------------------- regression

def linear_fit(df: DataFrame, label: str, feature: str) -> DataFrame:
    """Closed-form one-feature least squares via the SQL regression aggregates."""
    return df.agg(F.regr_slope(label, feature).alias("slope"), F.regr_intercept(label, feature).alias("intercept"),
                  F.regr_r2(label, feature).alias("r2"), F.regr_count(label, feature).alias("n"))


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """RMSE, R², MAE, count of a prediction column in one pass (R² = 1 − SSE/SST)."""
    err = F.col(label) - F.col(pred)
    agg = df.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
                 F.sum(err * err).alias("sse"), F.var_pop(label).alias("var"), F.count(F.lit(1)).alias("n"))
    return agg.select("rmse", "mae", (F.lit(1.0) - F.col("sse") / (F.col("var") * F.col("n"))).alias("r2"), "n")


def elastic_net(df: DataFrame, label: str = "magnitude", features=LOCATION_FEATURES, reg: float = 0.1,
                elastic: float = 0.8, train_percent: int = 80, seed: int = 42):
    """H7/H8/H9: elastic-net linear model on a hash split, from one pass of moments over the training rows.

    Returns (model, test predictions, metrics frame with train and test rows).
    """
    clean = drop_incomplete(df, list(features) + [label])
    split = hash_split(clean, "id", train_percent, seed)
    model = fit_elastic_net(split.where(F.col("split") == "train"), label, features, reg, elastic)
    scored = model.transform(split)
    metrics = (regression_metrics(scored.where(F.col("split") == "train"), label, "prediction")
               .withColumn("split", F.lit("train"))
               .unionByName(regression_metrics(scored.where(F.col("split") == "test"), label, "prediction")
                            .withColumn("split", F.lit("test"))))
    return model, scored.where(F.col("split") == "test"), metrics


def forest_pipeline(features=LOCATION_FEATURES, label: str = "magnitude", trees: int = 100, max_depth: int = 10,
                    seed: int = 42) -> Pipeline:
    """Random-forest regressor with every feature considered at each split (as scikit-learn's default).

    ``max_depth`` bounds the trees (at most 30 in Spark ML), so they are coarser than trees grown to the end.
    Each level goes on from the node a row has reached in each tree (``cacheNodeIds``), held like the rows, and does not
    walk down from the root again; the trees are the same.
    """
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=max_depth,
                              featureSubsetStrategy="all", seed=seed, subsamplingRate=1.0, bootstrap=True,
                              cacheNodeIds=True, checkpointInterval=-1)])


def forest_magnitude(df: DataFrame, trees: int = 100, max_depth: int = 10, seed: int = 42, label: str = "magnitude",
                     partitions: int | None = None):
    """In-sample random-forest magnitude prediction with absolute error (trees of at most ``max_depth``)."""
    feats = ["depth", "latitude", "longitude"]
    clean = drop_incomplete(df, feats + [label])
    model, _ = _fit_placed(forest_pipeline(feats, label, trees, max_depth, seed), clean.select("id", label, *feats), "id", partitions)
    out = model.transform(spread(clean)).drop("features").withColumnRenamed("prediction", "predicted_magnitude")
    return model, out.withColumn("magnitude_error", F.abs(F.col(label) - F.col("predicted_magnitude")))


def save_model(model, path: str) -> None:
    """Spark ML writer (overwrite)."""
    model.write().overwrite().save(path)
