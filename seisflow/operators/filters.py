"""Projections, filters and predicates.

Every predicate is a plain Column expression over scan columns with literal
bounds, so Catalyst pushes it into the Parquet reader (``PushedFilters``) and,
for catalogues written partitioned by ``date``, prunes whole directories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from seisflow.functions.scalars import ci_regex, shift

FEATURE_COLUMNS = ["magnitude", "longitude", "latitude", "depth"]


def _ts(value):
    return F.lit(value).cast("timestamp") if isinstance(value, str) else F.lit(value)


def range_query(df: DataFrame, start, end, min_magnitude: float | None = None) -> DataFrame:
    """B1: ``start <= time <= end`` and ``magnitude >= min_magnitude`` (both ends inclusive)."""
    cond = F.col("time").between(_ts(start), _ts(end))
    if min_magnitude is not None:
        cond = cond & (F.col("magnitude") >= F.lit(float(min_magnitude)))
    return df.where(cond)


def lookback(df: DataFrame, as_of, hours: int = 1, min_magnitude: float | None = None) -> DataFrame:
    """B2: the ``hours`` before an explicit ``as_of`` instant (inclusive), ``as_of`` included."""
    anchor = _ts(as_of)
    cond = (F.col("time") >= shift(anchor, hours=-hours)) & (F.col("time") <= anchor)
    if min_magnitude is not None:
        cond = cond & (F.col("magnitude") >= F.lit(float(min_magnitude)))
    return df.where(cond)


def recent_days(df: DataFrame, as_of, days: int = 30, min_magnitude: float = 0.0) -> DataFrame:
    """The last ``days`` days before ``as_of`` at or above a minimum magnitude."""
    anchor = _ts(as_of)
    return df.where((F.col("time") >= shift(anchor, days=-days)) & (F.col("time") <= anchor)
                    & (F.col("magnitude") >= F.lit(float(min_magnitude))))


def place_search(df: DataFrame, pattern: str, literal: bool = False) -> DataFrame:
    """Case-insensitive regex (or literal) search in ``place``; null place never matches."""
    return df.where(ci_regex("place", pattern, literal))


def drop_incomplete(df: DataFrame, columns=FEATURE_COLUMNS) -> DataFrame:
    """Drop rows with null or NaN in any of ``columns``."""
    return df.na.drop(how="any", subset=list(columns))


def sample_rows(df: DataFrame, n: int = 5, order_by: str = "id") -> DataFrame:
    """The first ``n`` rows in a stated order (top-k, no full sort)."""
    return df.orderBy(F.col(order_by).asc_nulls_last()).limit(n)
