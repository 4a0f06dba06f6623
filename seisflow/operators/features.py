"""Feature preparation: assembly, standardisation, deterministic splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from seisflow.functions.scalars import zscore
from seisflow.operators.filters import drop_incomplete
from seisflow.sources.catalogue import require_columns, require_rows

CLUSTER_FEATURES = ["magnitude", "longitude", "latitude", "depth"]
PATTERN_FEATURES = ["magnitude", "depth", "latitude", "longitude"]
LOCATION_FEATURES = ["latitude", "longitude", "depth"]


def prepare_features(df: DataFrame, cols=CLUSTER_FEATURES, out: str = "features", min_rows: int = 10) -> DataFrame:
    """H1: check columns, drop incomplete rows, require ``min_rows`` rows, assemble a vector."""
    require_columns(df, cols)
    clean = drop_incomplete(df, cols)
    require_rows(clean, min_rows, "complete feature rows")
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(clean)


@dataclass(frozen=True)
class Standardizer:
    """A fitted z-score transform: per-column mean and population std."""
    columns: tuple
    means: tuple
    stds: tuple

    def transform(self, df: DataFrame, suffix: str = "_z", replace: bool = False) -> DataFrame:
        exprs = {}
        for c, m, s in zip(self.columns, self.means, self.stds):
            exprs[c if replace else f"{c}{suffix}"] = zscore(c, m, s)
        return df.withColumns(exprs)


def fit_standardizer(df: DataFrame, cols) -> Standardizer:
    """One aggregate pass for all means and population stds (the scaler is a handful of numbers)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    return Standardizer(tuple(cols), tuple(row[f"m_{c}"] for c in cols), tuple(row[f"s_{c}"] for c in cols))


def standardize(df: DataFrame, cols=PATTERN_FEATURES, suffix: str = "_z"):
    """Drop incomplete rows, fit on them and add ``<col>_z`` columns; returns (frame, scaler)."""
    clean = drop_incomplete(df, cols)
    scaler = fit_standardizer(clean, cols)
    return scaler.transform(clean, suffix=suffix), scaler


def hash_split(df: DataFrame, key: str = "id", train_percent: int = 80, seed: int = 42) -> DataFrame:
    """H8: deterministic train/test label from a hash of the key.

    Unlike ``randomSplit`` the assignment does not depend on partitioning or
    row order, so a re-run (or a retried task) gives the same split.  The hash
    (first 32 bits of the MD5 of ``key:seed``) exists in every SQL engine.
    """
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
    return df.withColumn("split", F.when(bucket < train_percent, "train").otherwise("test"))
