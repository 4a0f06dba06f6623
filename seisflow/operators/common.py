"""Small planning helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Bytes a side may have, as rows in memory, to be broadcast explicitly.
BROADCAST_BYTES = 64 << 20
_FIXED, _ROW = 8, 32


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only after checking its size in bytes; otherwise leave the join to the planner.

    The size is rows × (a row's overhead and its fixed-width columns) plus the
    measured bytes of its text.  A known row bound (``known_rows``) saves the
    job where there is no text.  Above the limit the join stays a shuffled
    join, which AQE may still convert at runtime or split when skewed.
    """
    texts = [c for c, kind in df.dtypes if kind in ("string", "binary")]
    width = _ROW + _FIXED * (len(df.columns) - len(texts))
    n = getattr(df, "_known_rows", None)
    size = n * width if n is not None else None
    if size is None or (texts and size <= limit):
        length = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
        got = df.limit(limit // width + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(length).alias("b")).first()
        size = got["n"] * width + (got["b"] or 0)
    return F.broadcast(df) if size <= limit else df


def known_rows(df: DataFrame, n: int | None) -> DataFrame:
    """Remember a row count, or a bound of it, so size checks need no extra job."""
    if n is not None:
        df._known_rows = int(n)
    return df


def bounded_by(source: DataFrame, derived: DataFrame) -> DataFrame:
    """``derived`` (a projection or filter of ``source``) with the row bound of ``source``."""
    return known_rows(derived, getattr(source, "_known_rows", None))


# Partitions of the input of an iterative fit: at least so many, and one more for each so many rows.  Part of the model's
# definition, as its seed is: Spark ML's seeded sampling runs per partition.  They follow the rows and not the cluster.
FIT_PARTITIONS, FIT_ROWS = 32, 1_000_000


def fit_partitions(df: DataFrame) -> int:
    return max(FIT_PARTITIONS, -(-df.count() // FIT_ROWS))


def placed(df: DataFrame, key: str, partitions: int = FIT_PARTITIONS) -> DataFrame:
    """Rows dealt by a hash of ``key`` and sorted by it, so that a seeded fit does not depend on where rows came from."""
    return df.repartition(partitions, key).sortWithinPartitions(key)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly, for work per row that costs far more than moving it: a scan may have only a task per file."""
    return df.repartition(max(FIT_PARTITIONS, 3 * df.sparkSession.sparkContext.defaultParallelism))


def order_statistic(df: DataFrame, col: str, fraction: float, bins: int = 1024, few: int = 4096):
    """Exact ``fraction`` quantile of a numeric column, linear between the two neighbouring values; None if there are none.

    One way at every size: a histogram over the remaining range (a hash
    aggregate of at most ``bins`` rows) narrows the range to the bin that holds
    the wanted rank, until few values are left or all are equal; those few are
    read in order.  No task and no driver sees more.
    """
    v = F.col(col).cast("double")
    rest = df.select(v.alias("v")).where("v is not null and not isnan(v)")
    got = rest.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not got["n"]:
        return None
    rank = (got["n"] - 1) * fraction

    def at(k: int) -> float:
        part, n, lo, hi = rest, got["n"], got["lo"], got["hi"]
        while n > few and lo < hi:
            width = (hi - lo) / bins
            # Bounds are taken from the values in each bin, so bins never overlap whatever the rounding.
            bin_of = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)) if width > 0 else F.lit(0)
            rows = sorted(part.groupBy(bin_of.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect(),
                          key=lambda r: r["b"])
            for r in rows:
                if k < r["n"]:
                    break
                k -= r["n"]
            if r["n"] == n and (r["lo"], r["hi"]) == (lo, hi):
                break
            n, lo, hi = r["n"], r["lo"], r["hi"]
            part = rest.where(F.col("v").between(F.lit(lo), F.lit(hi)))
        return lo if lo == hi else part.orderBy("v").limit(k + 1).collect()[k]["v"]

    low = at(int(rank))
    if rank == int(rank):
        return low
    return low + (rank - int(rank)) * (at(int(rank) + 1) - low)


def dense_index(df: DataFrame, col: str, out: str = "index") -> DataFrame:
    """0-based position of each distinct ``col`` value in sorted order, computed in parallel.

    Values are range-partitioned, numbered inside each partition, and shifted
    by the number of values in earlier partitions (one count per partition is
    all that reaches the driver) — unlike an unpartitioned window, which would
    sort every value in one task.
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    values = df.select(col).distinct()
    n_parts = max(1, spark.sparkContext.defaultParallelism)
    # Kept until the index is read: a recomputed range partitioning could sample other bounds.
    ranged = values.repartitionByRange(n_parts, col).withColumn("__pid", F.spark_partition_id()).persist()
    counts = sorted((r["__pid"], r["n"]) for r in ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for pid, n in counts:
        offsets.append((pid, total))
        total += n
    off = spark.createDataFrame(offsets or [(0, 0)], "__pid int, __off long")
    w = Window.partitionBy("__pid").orderBy(col)
    made = (ranged.withColumn("__rn", F.row_number().over(w)).join(F.broadcast(off), "__pid")
            .select(col, (F.col("__off") + F.col("__rn") - 1).cast("int").alias(out)))
    made._held = ranged  # to be released once the index was read
    return made
