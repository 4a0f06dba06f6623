"""Helpers shared by the corpus operators: bounded Arrow batches, byte views of text, written cuts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from seisflow.session import drop_scratch, scratch_path

#: Text handled at once inside a Python task; numpy temporaries are a small multiple of it.
SLICE_BYTES = 4 << 20
#: Rows and bytes of one Arrow batch between the JVM and Python.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound Arrow batches in rows and bytes, so very long texts cannot pile up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs inside remove their shuffle files when they end, and not when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut of the lineage that survives lost executors.

    The job's shuffle files are removed when it ends, so disk holds the table alone.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop_written(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written` that nothing reads any more."""
    for t in tables:
        drop_scratch(t.sparkSession, t._scratch)


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose text is at most ``limit`` bytes (one row at least)."""
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = np.asarray(pa.compute.binary_length(texts).fill_null(0)).astype(np.int64)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield batch.slice(start)


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, at - at[0]


def text_bytes(texts: pa.Array) -> list[bytes]:
    """Each text as UTF-8 bytes; a null is an empty text."""
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def append_columns(df: DataFrame, text_col: str, fields: list[T.StructField],
                   make: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """Rows of ``df`` with columns computed from whole texts inside tasks; no shuffle.

    ``make`` gets the text column of a bounded slice and returns one array per field. A column of
    ``df`` that bears the name of a new field is replaced by it; all others pass through unchanged.
    """
    new = {f.name for f in fields}
    base = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(df.columns) if c not in new or c == text_col])
    passed = [c for c in base.columns if c not in new]
    schema = T.StructType([base.schema[c] for c in passed] + fields)
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text_col):
                arrays = [part.column(part.schema.get_field_index(c)) for c in passed]
                made = make(part.column(part.schema.get_field_index(text_col)))
                yield pa.RecordBatch.from_arrays(arrays + made, names=passed + [f.name for f in fields])

    return base.mapInArrow(run, schema)


def ragged_take(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate ``values[s:s + n]`` for each (s, n)."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return values[:0]
    return values[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1])]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all bits (splitmix constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
