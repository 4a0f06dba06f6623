"""CSV and Parquet scans/sinks for the flat catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from seisflow.schema import CATALOGUE_FIELDS, CATALOGUE_COLUMNS, CATALOGUE_SCHEMA


class EmptyInputError(ValueError):
    """Raised where the reference printed a message and returned nothing."""


def _text_read_schema() -> T.StructType:
    # Integers are read as double: a pandas writer stores an int column with
    # gaps as "12.0", which an IntegerType CSV field would silently turn to null.
    # Timestamps are read as text and cast, which accepts "2024-01-01 00:00:07",
    # fractional seconds of any length and the ISO "T" separator alike.
    fields = []
    for name, dtype in CATALOGUE_FIELDS:
        if isinstance(dtype, T.IntegerType):
            read_type = T.DoubleType()
        elif isinstance(dtype, T.TimestampType):
            read_type = T.StringType()
        else:
            read_type = dtype
        fields.append(T.StructField(name, read_type, True))
    return T.StructType(fields)


def conform(df: DataFrame) -> DataFrame:
    """Cast a frame to the fixed catalogue schema; NaN in integer columns becomes null."""
    return _cast_integers(df)


def read_catalogue_csv(spark: SparkSession, path: str) -> DataFrame:
    """A1: header CSV with the fixed schema.

    ``escape='"'`` reads doubled quotes inside quoted fields; ``enforceSchema``
    off makes Spark check the header names against the schema instead of
    binding columns by position.
    """
    raw = (spark.read.schema(_text_read_schema())
           .option("header", True)
           .option("escape", '"')
           .option("enforceSchema", False)
           .option("mode", "PERMISSIVE")
           .csv(path))
    return _cast_integers(raw)


def _cast_integers(raw: DataFrame) -> DataFrame:
    cols = []
    for name, dtype in CATALOGUE_FIELDS:
        c = F.col(name)
        if isinstance(dtype, T.IntegerType):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(c.try_cast("int"))
        elif isinstance(dtype, T.TimestampType):
            c = c.try_cast("timestamp")
        cols.append(c.cast(dtype).alias(name))
    return raw.select(*cols)


def write_catalogue_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV; quotes inside values are doubled so the reader above round-trips."""
    (df.select(*CATALOGUE_COLUMNS).write.mode(mode)
       .option("header", True).option("escape", '"').option("quoteAll", False)
       .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
       .csv(path))


def read_catalogue_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan with the fixed schema (partition column ``date`` restored)."""
    return spark.read.schema(CATALOGUE_SCHEMA).parquet(path).select(*CATALOGUE_COLUMNS)


def write_catalogue_parquet(df: DataFrame, path: str, partition_by: str | None = "date",
                            mode: str = "overwrite") -> None:
    """Overwrite Parquet; events are partitioned by ``date`` so day ranges prune files."""
    w = df.write.mode(mode)
    if partition_by:
        # Group rows of one partition value into few tasks so each writes few
        # files; ``rebalance`` (unlike ``repartition``) lets AQE split a crowded
        # day across tasks and merge sparse ones.
        w = df.hint("rebalance", partition_by).write.mode(mode).partitionBy(partition_by)
    w.parquet(path)


def require_rows(df: DataFrame, minimum: int = 1, what: str = "input") -> DataFrame:
    """Stop when fewer than ``minimum`` rows exist; reads at most ``minimum`` rows."""
    if len(df.limit(minimum).take(minimum)) < minimum:
        raise EmptyInputError(f"{what}: fewer than {minimum} rows")
    return df


def require_columns(df: DataFrame, columns) -> DataFrame:
    """Fail early when a required column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df
