"""Linear models from one pass of moments (H7, H13): elastic net by coordinate descent, components by eigenvectors.

Means and covariances of all column pairs come from one aggregate with map-side partials; everything after that works
on a matrix as large as the number of columns. No data are held, shuffled or read again, whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Moments:
    columns: tuple
    n: int
    means: np.ndarray
    cov: np.ndarray  # over n, not n - 1


def moments(df: DataFrame, cols) -> Moments:
    """Count, means and covariances of complete rows; null or NaN in a column leaves a row out."""
    cols = list(cols)
    v = [F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)]
    rows = df.select(*v)
    for i in range(len(cols)):
        rows = rows.where(f"v{i} is not null and not isnan(v{i})")
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    got = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"v{i}").alias(f"m{i}") for i in range(len(cols))],
                   *[F.covar_pop(f"v{i}", f"v{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    cov = np.zeros((len(cols), len(cols)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = got[f"c{i}_{j}"] or 0.0
    return Moments(tuple(cols), got["n"], np.array([got[f"m{i}"] or 0.0 for i in range(len(cols))]), cov)


@dataclass(frozen=True)
class LinearModel:
    features: tuple
    coefficients: tuple
    intercept: float
    sweeps: int

    def prediction(self) -> Column:
        out = F.lit(float(self.intercept))
        for c, b in zip(self.features, self.coefficients):
            out = out + F.col(c) * F.lit(float(b))
        return out

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.prediction())

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(list(self.features), [float(b) for b in self.coefficients], float(self.intercept), self.sweeps)]
        spark.createDataFrame(rows, "features array<string>, coefficients array<double>, intercept double, sweeps int").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LinearModel":
        r = spark.read.parquet(path).first()
        return LinearModel(tuple(r["features"]), tuple(r["coefficients"]), r["intercept"], r["sweeps"])


def fit_elastic_net(df: DataFrame, label: str, features, reg: float = 0.1, elastic: float = 0.8, max_sweeps: int = 10_000, tol: float = 1e-13) -> LinearModel:
    """The minimum of mean squared error / 2 plus the penalty ``reg · (elastic · |b|₁ + (1 - elastic) / 2 · |b|₂²)``.

    As in Spark ML's solver by normal equations, features and label are in units of their standard deviations (over n)
    while the penalty acts. Each sweep sets one coefficient after the other to its minimum, from the matrix of moments alone. A feature
    without variance has coefficient 0; with a constant label, or without rows, all are 0.
    """
    m = moments(df, [*features, label])
    d = len(m.columns) - 1
    scale = np.sqrt(np.diag(m.cov))
    b, sweeps = np.zeros(d), 0
    if scale[d] > 0:
        unit = np.where(scale > 0, scale, 1.0)
        g = m.cov / np.outer(unit, unit)
        l1, l2 = reg * elastic / scale[d], reg * (1 - elastic) / scale[d]
        live = [j for j in range(d) if scale[j] > 0]
        for sweeps in range(1, max_sweeps + 1):
            before = b.copy()
            for j in live:
                rest = g[j, d] - g[j, :d] @ b + g[j, j] * b[j]
                b[j] = np.sign(rest) * max(abs(rest) - l1, 0.0) / (g[j, j] + l2)
            if np.abs(b - before).max() <= tol:
                break
        b = b * scale[d] / unit[:d]
    return LinearModel(tuple(features), tuple(float(x) for x in b), float(m.means[d] - m.means[:d] @ b), sweeps)


@dataclass(frozen=True)
class Components:
    columns: tuple
    vectors: np.ndarray  # one column per component
    ratios: tuple  # share of the variance

    def transform(self, df: DataFrame, prefix: str = "pca") -> DataFrame:
        """``df`` with the components' scores of (centred) ``columns``."""
        score = lambda j: sum((F.col(c) * F.lit(float(w)) for c, w in zip(self.columns, self.vectors[:, j])), F.lit(0.0))
        return df.withColumns({f"{prefix}{j + 1}": score(j) for j in range(self.vectors.shape[1])})


def fit_components(df: DataFrame, cols, k: int = 2) -> Components:
    """The ``k`` directions of greatest variance; the largest loading of each is positive."""
    m = moments(df, cols)
    values, vectors = np.linalg.eigh(m.cov)
    order = np.argsort(values)[::-1][:k]
    vectors = vectors[:, order]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    total = values.sum()
    return Components(tuple(cols), vectors, tuple(float(v / total) if total else 0.0 for v in values[order]))
