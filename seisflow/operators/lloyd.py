"""k-means by weighted Lloyd steps over distinct places (H2-H6, H11), which any engine repeats exactly.

The first centres are the ``k`` distinct places with the smallest hash of an id there, so they depend on the data and
the seed alone. A step is one hash aggregate: each place goes to its nearest centre (the lower number on ties), and a
centre moves to the mean of its rows; a centre without rows stays. Copies are one place with a weight. Only the
centres reach the driver; no placement, no held partitions, no order of rows matters beyond the rounding of sums.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from seisflow.session import drop_scratch, scratch_path


def nearest(cols, centres) -> Column:
    """Number of the nearest centre; the lower one on ties.

    The centres are one array value and not numbers in the generated code, so that steps share their compiled code.
    """
    table = F.array(*[F.struct(F.lit(i).alias("i"), F.array(*[F.lit(float(v)) for v in c]).alias("at")) for i, c in enumerate(centres)])
    place = F.array(*[F.col(c) for c in cols])
    far = lambda c: F.aggregate(F.zip_with(place, c["at"], lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, d: a + d)
    return F.array_min(F.transform(table, lambda c: F.struct(far(c).alias("d"), c["i"].alias("i"))))["i"]


@dataclass(frozen=True)
class Centres:
    columns: tuple
    centres: tuple  # one tuple per cluster
    steps: int
    settled: bool

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        if not self.centres:
            return df.withColumn(out, F.lit(None).cast("int"))
        return df.withColumn(out, nearest(self.columns, self.centres))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(self.centres)], "prediction int, " + ", ".join(f"{c} double" for c in self.columns))


def fit_lloyd(df: DataFrame, cols, key: str = "id", k: int = 5, seed: int = 42, max_steps: int = 20) -> Centres:
    """At most ``max_steps`` steps over rows complete in ``cols``; fewer distinct places than ``k`` give fewer centres."""
    cols = list(cols)
    rows = df.select(F.col(key).alias("__key"), *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols)
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "places")
    h = F.min(F.md5(F.concat_ws(":", F.col("__key").cast("string"), F.lit(str(seed))))).alias("__h")
    rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"), h).write.parquet(path)
    places = spark.read.parquet(path)
    centres = [tuple(r[c] for c in cols) for r in places.orderBy("__h", *cols).limit(k).collect()]
    steps, settled = 0, not centres
    while not settled and steps < max_steps:
        sums = places.groupBy(nearest(cols, centres).alias("__c")).agg(F.sum("__n").alias("__n"), *[F.sum(F.col(c) * F.col("__n")).alias(c) for c in cols])
        moved = {r["__c"]: tuple(r[c] / r["__n"] for c in cols) for r in sums.collect()}
        after = [moved.get(i, c) for i, c in enumerate(centres)]
        steps, settled, centres = steps + 1, after == centres, after
    drop_scratch(spark, path)
    return Centres(tuple(cols), tuple(centres), steps, settled)


def silhouette(df: DataFrame, cols, cluster: str = "prediction") -> float | None:
    """Mean silhouette with squared Euclidean distances, from per-cluster counts, sums and squares; None below two clusters.

    A row's mean squared distance to a cluster follows from these sums; a cluster of one row has silhouette 0.
    """
    square: Column = sum((F.col(c) * F.col(c) for c in cols), F.lit(0.0))
    stats = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), F.sum(square).alias("q"), *[F.sum(c).alias(f"s_{c}") for c in cols]).collect()
    if len(stats) < 2:
        return None

    def mean_to(r, n: int) -> Column:
        cross = sum((F.col(c) * F.lit(float(r[f"s_{c}"])) for c in cols), F.lit(0.0))
        return (square * F.lit(float(r["n"])) + F.lit(float(r["q"])) - F.lit(2.0) * cross) / F.lit(float(n))

    score = None
    for own in stats:
        if own["n"] == 1:
            value = F.lit(0.0)
        else:
            a = mean_to(own, own["n"] - 1)
            others = [mean_to(r, r["n"]) for r in stats if r[cluster] != own[cluster]]
            b = F.least(*others) if len(others) > 1 else others[0]
            value = F.coalesce((b - a) / F.nullif(F.greatest(a, b), F.lit(0.0)), F.lit(0.0))
        score = F.when(F.col(cluster) == own[cluster], value) if score is None else score.when(F.col(cluster) == own[cluster], value)
    return df.agg(F.avg(score).alias("s")).first()["s"]
