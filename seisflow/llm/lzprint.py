"""Document fingerprints (4): Lempel-Ziv phrases under a minimum-hash signature.

A text's UTF-8 bytes are parsed into dictionary phrases: each phrase is the longest one seen before plus
one byte, so every phrase of a text is new (a last, known phrase adds nothing). Texts that compress
well together share phrases. The phrases are hashed (a polynomial over prefix sums, then mixed), dealt
into ``BINS`` bins by their hash, and each bin keeps its minimum: a one-permutation minimum-hash
signature of the phrase set. The likeness of two signatures is the share of bins that agree among
the bins filled in either, an estimate of the Jaccard similarity of the phrase sets.

``compare_with_successor`` needs each document's successor by id. It deals whole texts by ranges of
the id once, and sends the first text of each range also to the range that precedes it in the order;
the ranges are streamed in order, so a task holds one batch and one text more.

Defined results: a null text is an empty one; an empty text has the all-empty signature, which is like
another empty one (1.0) and unlike all others (0.0); equal texts have equal fingerprints; among rows
with one id the order is by text; a null id sorts last; a single row is its own successor.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F, types as T

from seisflow.llm.common import append_columns, bound_batches, mix64, text_bytes, text_slices

#: Bins of a signature; each keeps 16 bits of its minimum hash, 0 where it is empty.
BINS = 128
_BASE = np.uint64(0x9E3779B97F4A7C15)


_TABLES: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse modulo 2^64, from 0 to n at least; kept in the worker."""
    if not _TABLES or len(_TABLES[0]) <= n:
        size = max(1 << 14, 2 * n)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _TABLES[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))]) for b in (_BASE, inverse)]
    return _TABLES[0], _TABLES[1]


def phrase_ends(data: bytes) -> list[int]:
    """Where each new phrase of the parse ends."""
    trie: dict[int, int] = {}
    get, node, count, ends = trie.get, 0, 0, []
    add = ends.append
    for at, byte in enumerate(data, 1):
        key = node | byte
        node = get(key, -1)
        if node < 0:
            count += 256
            trie[key] = count
            add(at)
            node = 0
    return ends


def signature(data: bytes) -> np.ndarray:
    """BINS 16-bit values of the phrase set; all zero for an empty text."""
    out = np.zeros(BINS, np.uint16)
    if not data:
        return out
    ends = np.array(phrase_ends(data), np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    powers, back = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * powers[:len(data)], out=sums[1:])
    h = mix64((sums[ends] - sums[starts]) * back[starts])
    low = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    bins = (h >> np.uint64(57)).astype(np.int64)
    np.minimum.at(low, bins, h)
    filled = np.unique(bins)
    out[filled] = (mix64(low[filled]) % np.uint64(65535)).astype(np.uint16) + 1
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: share of bins that agree among those filled in either; two empty signatures are alike."""
    filled = (a != 0) | (b != 0)
    return float(((a == b) & filled).sum() / filled.sum()) if filled.any() else 1.0


def text_of(sig: np.ndarray) -> str:
    """Four hexadecimal digits a bin."""
    return sig.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of the whole text; no shuffle."""
    return append_columns(docs, text_col, [T.StructField(out, T.StringType())],
                          lambda texts: [pa.array([text_of(signature(t)) for t in text_bytes(texts)], pa.string())])


def edited_text(text: str, after: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many of ``after``, or all it has."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def by_ranges(docs: DataFrame, id_col: str, text_col: str, ranges: int) -> DataFrame:
    """(part, id, text, guest) with parts in one task each, sorted by guest, then descending id, then text.

    ``guest`` rows are copies of the row that follows the part's last one. The bounds come from the ids
    alone; three numbers per range reach the driver, and go back as a table of as many rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = rows.select("id").where("id is not null")
    cuts = sorted(set(ids.approxQuantile("id", [i / ranges for i in range(1, ranges)], 0.1 / ranges))) if ranges > 1 else []
    if cuts:  # binary search; a null id comes last in the order, so it lies in the lowest range
        bucket = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="at", outputCol="bucket", handleInvalid="keep")
        part = lambda df: bucket.transform(df.withColumn("at", F.col("id").cast("double"))).withColumn(
            "part", F.when(F.col("id").isNull(), 0).otherwise(F.col("bucket").cast("int"))).drop("at", "bucket")
    else:
        part = lambda df: df.withColumn("part", F.lit(0))
    tops = {r["part"]: r["top"] for r in part(rows.select("id")).groupBy("part").agg(F.max("id").alias("top")).collect()}
    order = sorted(tops)
    follows = [(p, tops[p], order[(i + 1) % len(order)]) for i, p in enumerate(order)]
    guests = F.broadcast(spark.createDataFrame(follows, "g_part int, g_id long, before int"))
    placed = part(rows)
    placed = placed.join(guests, (F.col("part") == F.col("g_part")) & F.col("id").eqNullSafe(F.col("g_id")), "left")
    own, copy = F.struct("part", F.lit(False).alias("guest")), F.struct(F.col("before").alias("part"), F.lit(True).alias("guest"))
    placed = placed.select("id", "text", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("to"))
    return (placed.select("to.part", "id", "text", "to.guest").repartition(max(1, ranges // 4), "part")
            .sortWithinPartitions("part", "guest", F.col("id").desc_nulls_last(), "text"))


def compare_with_successor(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: fingerprint of the text, of the edited text, and their likenesses; the next row's too.

    The successor is the row with the next smaller id; after the last comes the first.
    """
    bound_batches(docs.sparkSession)
    ranges = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        held = None  # (part, id, text, signature) that waits for its successor
        for batch in batches:
            for piece in text_slices(batch, "text"):
                out = []
                for part, key, text, guest in zip(*(c.to_pylist() for c in piece.columns)):
                    if guest and (held is None or held[0] != part):
                        continue  # another copy of a successor that was used
                    sig = signature(text.encode())
                    if held is not None and held[0] == part:
                        edited = edited_text(held[2], text)
                        other = signature(edited.encode())
                        out.append((held[1], len(held[2]), hashlib.sha256(edited.encode()).hexdigest(), text_of(held[3]), text_of(other),
                                    likeness(held[3], other), likeness(held[3], sig)))
                    held = None if guest else (part, key, text, sig)
                made = list(zip(*out)) or [()] * len(columns)
                kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(made, kinds)], names=columns)

    ordered = by_ranges(docs, id_col, text_col, ranges)
    return ordered.mapInArrow(run, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double").withColumnRenamed("id", id_col)
