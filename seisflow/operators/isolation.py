"""Distributed isolation forest (H12; Liu, Ting & Zhou 2008).

Spark ML has no isolation forest, so it is composed from DataFrame steps:

* **Sampling without a pass per tree.**  One hash of the row key picks a
  uniform pool of about ``2 × trees × sample_size`` rows (a filter, pushed
  into the scan's stage).  Inside the pool each tree ranks rows by its own hash
  of the key and keeps the ``sample_size`` smallest, so every tree sees a
  uniform sample and the choice does not depend on partitioning.
* **Growing.**  ``groupBy(tree).applyInPandas`` grows one tree per group from
  at most ``sample_size`` rows, with splits drawn from hashes of (seed, tree,
  node), so the trees follow from the sample alone; the forest is a node table (tree, node, depth,
  feature, threshold, left, right, size) — at most ``trees × (2·256 − 1)`` rows.
* **Scoring.**  The node table ships with an iterator pandas UDF over the feature
  columns alone; it walks all trees for a whole Arrow batch at once with numpy
  index arrays and returns the anomaly score ``2^(−E[h(x)]/c(ψ))``.
* **Labelling.**  Rows whose negated score lies strictly below its
  ``contamination`` quantile get -1, the rest 1.  The quantile is exact at
  every size (``common.order_statistic``), read from a written table of scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from seisflow.functions.scalars import zscore
from seisflow.operators.common import order_statistic, spread
from seisflow.operators.features import PATTERN_FEATURES, fit_standardizer
from seisflow.operators.filters import drop_incomplete
from seisflow.session import scratch_path

EULER_GAMMA = 0.5772156649015329
NODE_SCHEMA = ("tree int, node int, depth int, feature int, threshold double, "
               "left int, right int, size long")
_UNIT = float(2 ** 52)


def average_path(n) -> np.ndarray:
    """c(n): mean path length of an unsuccessful search in a binary search tree of n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _unit_hash(*cols) -> "F.Column":
    """A number in [0, 1) from the MD5 of the values, which every engine has."""
    digest = F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(_UNIT)


def _draw(*values) -> float:
    """The same of Python values."""
    return int(md5(":".join(map(str, values)).encode()).hexdigest()[:13], 16) / _UNIT


def _grow(features: list, max_depth: int, seed: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        X = pdf[features].to_numpy(dtype=float)
        rows = []

        def build(idx, depth, name):
            node = len(rows)
            rows.append(None)
            sub = X[idx]
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            usable = np.nonzero(hi > lo)[0]
            if depth >= max_depth or usable.size == 0:
                rows[node] = (tree, node, depth, -1, 0.0, -1, -1, len(idx))
                return node
            # One of the features that still vary in this node, and a place between their ends: both are hashes of
            # the node's name (1 for the root, then twice its parent's, and one more on the right).
            f = int(usable[int(_draw(seed, tree, name, "feature") * usable.size)])
            thr = float(lo[f] + _draw(seed, tree, name, "threshold") * (hi[f] - lo[f]))
            if not lo[f] < thr <= hi[f]:  # a draw of zero, or rounding: the lowest value alone goes left
                thr = float(np.nextafter(lo[f], np.inf))
            go_left = sub[:, f] < thr
            left = build(idx[go_left], depth + 1, 2 * name)
            right = build(idx[~go_left], depth + 1, 2 * name + 1)
            rows[node] = (tree, node, depth, f, thr, left, right, len(idx))
            return node

        build(np.arange(len(X)), 0, 1)
        return pd.DataFrame(rows, columns=["tree", "node", "depth", "feature", "threshold", "left", "right", "size"])

    return grow


class IsolationForestModel:
    """A fitted forest: its node table (at most trees × 511 rows, held on the driver) and the sample size."""

    def __init__(self, table: pd.DataFrame, features: list, sample_size: int):
        self.table = table.sort_values(["tree", "node"]).reset_index(drop=True)
        self.features = list(features)
        self.sample_size = int(sample_size)

    def save(self, spark, path: str, mode: str = "overwrite") -> None:
        """The node table as Parquet plus the features and sample size as columns."""
        (spark.createDataFrame(self.table, NODE_SCHEMA).withColumn("features", F.lit(",".join(self.features)))
         .withColumn("sample_size", F.lit(self.sample_size)).write.mode(mode).parquet(path))

    @classmethod
    def load(cls, spark, path: str) -> "IsolationForestModel":
        t = spark.read.parquet(path)
        meta = t.select("features", "sample_size").first()
        return cls(t.drop("features", "sample_size").toPandas(), meta["features"].split(","), meta["sample_size"])

    def _arrays(self):
        """All trees stacked into flat node arrays with global child indices, plus each tree's root."""
        pdf = self.table
        sizes = pdf.groupby("tree").size()
        offsets = np.concatenate([[0], np.cumsum(sizes.to_numpy())[:-1]])
        base = np.repeat(offsets, sizes.to_numpy())
        left = np.where(pdf["left"].to_numpy() >= 0, pdf["left"].to_numpy() + base, -1)
        right = np.where(pdf["right"].to_numpy() >= 0, pdf["right"].to_numpy() + base, -1)
        leaf_h = pdf["depth"].to_numpy() + average_path(pdf["size"].to_numpy())
        return (pdf["feature"].to_numpy(), pdf["threshold"].to_numpy(), left, right, leaf_h, offsets)

    def score_column(self, columns) -> "F.Column":
        """2^(−E[h]/c(ψ)) of the given feature columns (higher = more anomalous)."""
        feature, thr, left, right, leaf_h, roots = self._arrays()
        norm, n_trees = float(average_path([self.sample_size])[0]) or 1.0, len(roots)

        def walk(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for parts in batches:
                x = np.column_stack([p.to_numpy(dtype=float) for p in parts])
                rows = np.arange(len(x))[None, :]
                node = np.repeat(roots[:, None], len(x), axis=1)      # trees × rows, walked together
                while True:
                    f = feature[node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    go_left = x[rows, np.where(inner, f, 0)] < thr[node]
                    node = np.where(inner, np.where(go_left, left[node], right[node]), node)
                # Rounded, so that a row's score does not depend on the batch it comes in.
                yield pd.Series(np.round(np.power(2.0, -(leaf_h[node].sum(axis=0) / n_trees) / norm), 12))

        udf = F.pandas_udf(walk, "double")
        return udf(*[F.col(c) if isinstance(c, str) else c for c in columns])

    def score(self, df: DataFrame, out: str = "anomaly_score") -> DataFrame:
        return df.withColumn(out, self.score_column(self.features))


def fit_isolation_forest(df: DataFrame, features, key: str = "id", trees: int = 100, sample_size: int = 256,
                         seed: int = 42, n_rows: int | None = None, oversample: float = 4.0) -> IsolationForestModel:
    """Grow the forest from per-tree hash samples (see module notes).

    Before the per-tree ranking, each tree keeps only pool rows whose tree hash
    falls below ``oversample × sample_size / pool`` — about four times what it
    needs — so the shuffle carries ~``4 × trees × sample_size`` rows instead of
    ``trees × pool``.  If any tree ends up short, it is redone without the cut,
    so every tree still gets exactly its ``sample_size`` smallest hashes.
    """
    from pyspark.sql import Window

    n = n_rows if n_rows is not None else df.count()
    psi = max(1, min(sample_size, n))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    pool_rate = min(1.0, 2.0 * trees * psi / max(n, 1))
    pool = df.where(_unit_hash(F.col(key), F.lit(seed)) < F.lit(pool_rate)).select(key, *features)
    per_tree = (pool.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
                .withColumn("u", _unit_hash(F.col(key), F.lit(seed), F.col("tree"))))
    cut = min(1.0, oversample * psi / max(pool_rate * n, 1.0))
    cand = held = per_tree.where(F.col("u") < F.lit(cut)).persist(StorageLevel.MEMORY_AND_DISK)
    short = [r["tree"] for r in cand.groupBy("tree").count().where(F.col("count") < psi).collect()]
    have = cand.select("tree").distinct().count()
    if cut < 1.0 and (short or have < trees):
        present = {r["tree"] for r in cand.select("tree").distinct().collect()}
        redo = sorted(set(short) | (set(range(trees)) - present))
        cand = cand.where(~F.col("tree").isin(redo)).unionByName(per_tree.where(F.col("tree").isin(redo)))
    w = Window.partitionBy("tree").orderBy("u", key)
    sample = cand.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= psi).drop("rk")
    # Model-sized: at most trees × (2 × sample_size − 1) rows.
    table = sample.groupBy("tree").applyInPandas(_grow(list(features), max_depth, seed), NODE_SCHEMA).toPandas()
    held.unpersist()
    return IsolationForestModel(table, features, psi)


def label_anomalies(scored: DataFrame, contamination: float = 0.1, score_col: str = "anomaly_score",
                    out: str = "is_anomaly", scores: DataFrame | None = None) -> DataFrame:
    """-1 where −score is strictly below its exact ``contamination`` quantile, else 1.

    ``scores``: a table that already holds ``score_col`` of the same rows, so that the quantile's passes need not
    score again.
    """
    table = (scored if scores is None else scores).select((-F.col(score_col)).alias("neg"))
    q = order_statistic(table, "neg", contamination)
    low = F.lit(False) if q is None else -F.col(score_col) < F.lit(q)
    return scored.withColumn(out, F.when(low, F.lit(-1)).otherwise(F.lit(1)))


def fit_detector(df: DataFrame, key: str = "id", trees: int = 100, sample_size: int = 256, seed: int = 42,
                 features=PATTERN_FEATURES):
    """(scaler, forest) of the complete rows; the forest is None where there are none."""
    clean = drop_incomplete(df, list(features)).select(key, *features)
    scaler = fit_standardizer(clean, list(features))
    if scaler.means[0] is None:
        return scaler, None
    z = scaler.transform(clean, suffix="_z")
    return scaler, fit_isolation_forest(z, [f"{c}_z" for c in features], key=key, trees=trees, sample_size=sample_size, seed=seed)


def detect_anomalies(df: DataFrame, contamination: float = 0.1, key: str = "id", trees: int = 100,
                     sample_size: int = 256, seed: int = 42, features=PATTERN_FEATURES, fitted=None) -> DataFrame:
    """Standardise the features (population std), fit, score and label complete rows.

    Nothing stays cached: the scores are written once as a one-column table for the quantile, and computed again
    where the result is read.  No complete rows give an empty frame of the same columns.
    """
    clean = drop_incomplete(df, list(features))
    scaler, model = fitted or fit_detector(df, key, trees, sample_size, seed, features)
    if model is None:
        return clean.withColumn("anomaly_score", F.lit(None).cast("double")).withColumn("is_anomaly", F.lit(None).cast("int"))
    z = [zscore(c, m, s) for c, m, s in zip(scaler.columns, scaler.means, scaler.stds)]
    scored = spread(clean).withColumn("anomaly_score", model.score_column(z))
    path = scratch_path(df.sparkSession, "scores")
    scored.select("anomaly_score").write.parquet(path)
    return label_anomalies(scored, contamination, scores=df.sparkSession.read.parquet(path))
