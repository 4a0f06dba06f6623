"""Registered queries: name → (spark, sf_dir) -> DataFrame, with oracle SQL.

Each query reads the driver's ``events`` table through the catalogue fixture,
so its work grows with the table.  Computed doubles are rounded to 6 decimals
in both the Spark plan and the SQL text so the two engines hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from seisflow.sources.fixture import load_catalogue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed query parameters used by both engines.
AS_OF = "2024-01-30 00:00:00"
RANGE_START, RANGE_END = "2024-01-05 00:00:00", "2024-01-20 00:00:00"


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


_MEMO: dict = {}


def _of_application(spark: SparkSession) -> dict:
    """What is kept for the running application; a new application drops what an ended one left."""
    app = spark.sparkContext.applicationId
    if app not in _MEMO:
        _MEMO.clear()
    return _MEMO.setdefault(app, {})


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue over ``sf_dir``'s events, built once per session and folder.

    A DataFrame is an immutable, lazy plan; reusing it saves re-reading the
    Parquet footer and re-analysing the projection for every query.  No rows
    are cached.
    """
    # Every time-of-day and calendar result is defined in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    memo = _of_application(spark)
    if ("catalogue", sf_dir) not in memo:
        memo["catalogue", sf_dir] = load_catalogue(spark, sf_dir)
    return memo["catalogue", sf_dir]


def fitted(spark: SparkSession, sf_dir: str, name: str, fit: Callable):
    """Fit a model (or run an iterative operator) once per application and folder; later queries reuse it.

    Kept are models and plans over written tables, never cached rows.
    """
    memo = _of_application(spark)
    if (name, sf_dir) not in memo:
        memo[name, sf_dir] = fit()
    return memo[name, sf_dir]


def r6(c) -> "F.Column":
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def round_cols(df: DataFrame, cols) -> DataFrame:
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def all_queries():
    # Import modules that register queries (side effect) before returning the tables.
    from seisflow.plans import queries_basic, queries_grids, queries_io, queries_ml, queries_spatial  # noqa: F401
    return QUERIES, ORACLE
