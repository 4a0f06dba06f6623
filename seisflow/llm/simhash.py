"""SimHash near-duplicates (6) by anchor-point covering.

Fingerprint: ASCII A-Z folded, words split at ASCII white space, word shingles (repeats included,
joined by blanks; fewer words: the whole sequence; none: fingerprint zero), XXH64 with seed 42 of
each; a bit is set if it is set in more than half of the hashes.

Linking: two fingerprints within 3 bits differ by at most one bit in one of their 32-bit halves. In
each half the anchors are a covering code: the perfect Hamming code on 31 bits (covering radius 1)
times one free bit. A fingerprint's home is the anchor nearest to its half (radius ≤ 1); it is
replicated to every anchor within radius + 1 = 2 (17 at most). If two halves differ by one bit, each
is found at the other's home. Per anchor, homes are compared with all members on all 64 bits; a search
from each home emits links that keep the components but not all pairs of a dense group.

Only distinct fingerprints are dealt to anchors (with their smallest id), so copies cost nothing and
a group of any size is one row. Components are computed by Spark over written tables.

Defined results: a null text is an empty one; empty texts share fingerprint zero and link like any
other; a null id never becomes a component's id unless all its ids are null; repeated rows come out
as often as they went in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from seisflow.llm.common import append_columns, bound_batches, drop_written, text_bytes, written
from seisflow.operators.components import components

SHINGLE, MAX_BITS = 3, 3
#: Pairs of one anchor that are compared in bulk; larger groups are searched from home to home.
BULK = 4096
#: Fingerprints with more than this share of all rows (one in so many) are joined by broadcast.
HOT = 1000


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    words = data.lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), np.uint64)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounds the bit matrix of a very long text
        block = hashes[at:at + (1 << 16)]
        votes += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the 64-bit fingerprint as a (signed) long; no shuffle."""
    def make(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(np.array([fingerprint(t, shingle) for t in text_bytes(texts)], np.uint64).view(np.int64), pa.int64())]

    return append_columns(docs, text_col, [T.StructField(out, T.LongType())], make)


# Pairs of positions 1..31 whose exclusive or is s: the two-bit moves from a word with syndrome s to a codeword.
_PAIRS = np.array([[0] * 15] + [[(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if i < i ^ s and i != s] for s in range(1, 32)], np.uint64)
_SYNDROME_MASKS = [sum(1 << (i - 1) for i in range(1, 32) if i >> k & 1) for k in range(5)]


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(home, others) of 32-bit values: the nearest anchor, and up to 16 more within distance 2 (home repeated where fewer)."""
    code, free = half & np.uint64(0x7FFFFFFF), half & np.uint64(0x80000000)
    syndrome = np.zeros(len(half), np.int64)
    for k, mask in enumerate(_SYNDROME_MASKS):
        syndrome |= (np.bitwise_count(code & np.uint64(mask)).astype(np.int64) & 1) << k
    flip = np.where(syndrome > 0, np.uint64(1) << np.maximum(syndrome - 1, 0).astype(np.uint64), np.uint64(0))
    home = code ^ flip
    others = np.where((syndrome > 0)[:, None], code[:, None] ^ _PAIRS[syndrome], home[:, None]) | free[:, None]
    return home | free, np.column_stack([others, (home | free) ^ np.uint64(0x80000000)])


def replicate(batches):
    """(anchor, fingerprint, home) rows: both halves, each with the half's number in the anchor."""
    for batch in batches:
        x = np.asarray(batch.column(0)).view(np.uint64)
        for k in range(2):
            home, others = anchors((x >> np.uint64(32 * k)) & np.uint64(0xFFFFFFFF))
            tag = np.uint64(k << 32)
            guest = others != home[:, None]
            keys = np.concatenate([home, others[guest]]) | tag
            prints = np.concatenate([x, np.broadcast_to(x[:, None], others.shape)[guest]])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(prints.view(np.int64)), pa.array(np.arange(len(keys)) < len(x))],
                                             names=["anchor", "fp", "home"])


def search(homes: np.ndarray, guests: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of a large group: each home is reached once; a guest is linked once to each set of connected homes."""
    out, left = [], homes.copy()
    while len(left):
        todo, left, fresh = [left[0]], left[1:], guests
        while todo:
            x = todo.pop()
            near, seen = np.bitwise_count(left ^ x) <= max_bits, np.bitwise_count(fresh ^ x) <= max_bits
            found = np.concatenate([left[near], fresh[seen]])
            out.append((np.full(len(found), x), found))
            todo.extend(left[near])
            left, fresh = left[~near], fresh[~seen]
    return out


def group_links(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal anchors. Rows are sorted by anchor, homes first."""
    starts = np.flatnonzero(np.diff(anchor, prepend=anchor[0] - 1 if len(anchor) else 0))
    sizes = np.diff(np.append(starts, len(anchor)))
    n_homes = np.add.reduceat(home.astype(np.int64), starts) if len(starts) else sizes
    live = (sizes > 1) & (n_homes > 0)
    small = live & (sizes * n_homes <= BULK)
    # Every (home, member) pair of the small groups at once.
    s, m, h = starts[small], sizes[small], n_homes[small]
    each = np.repeat(np.arange(len(s)), m * h)
    nth = np.arange(len(each)) - np.repeat(np.cumsum(m * h) - m * h, m * h)
    i, j = nth // m[each], nth % m[each]
    a, b = fp[s[each] + i], fp[s[each] + j]
    keep = (i < j) & (np.bitwise_count(a ^ b) <= max_bits)
    out = [(a[keep], b[keep])]
    for s, m, h in zip(starts[live & ~small], sizes[live & ~small], n_homes[live & ~small]):
        out += search(fp[s:s + h], fp[s + h:s + m], max_bits)
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) between distinct fingerprints ``fp`` within ``max_bits``, enough for their components."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves cover distances up to 3")
    bound_batches(prints.sparkSession, rows=20000)

    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []  # rows of an anchor that may go on in the next batch

        def close(parts):
            a, b = group_links(*(np.concatenate(c) for c in zip(*parts)), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key, fp, home = (np.asarray(c) if i < 2 else np.asarray(c.cast(pa.int8())) > 0 for i, c in enumerate(batch.columns))
            fp, cut = fp.view(np.uint64), int(np.searchsorted(key, key[-1]))
            if held and key[0] != held[-1][0][-1]:
                yield close(held)
                held = []
            if cut:
                yield close([*held, (key[:cut], fp[:cut], home[:cut])])
                held = []
            held.append((key[cut:], fp[cut:], home[cut:]))
        if held:
            yield close(held)

    rows = prints.select("fp").mapInArrow(replicate, "anchor long, fp long, home boolean")
    return rows.repartition("anchor").sortWithinPartitions("anchor", F.desc("home")).mapInArrow(run, "a long, b long")


def classes(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, n, root, component_id) of every distinct fingerprint in ``prints`` (doc_id, fp).

    ``n`` is the number of its rows, ``root`` a name of its component and ``component_id`` the smallest doc_id there.
    """
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "prints")
    pairs = written(links(distinct, max_bits), "links")
    linked = components(pairs).withColumnRenamed("node", "fp")
    smallest = distinct.join(linked, "fp").groupBy("root").agg(F.min("first").alias("smallest"))
    out = written(distinct.join(linked.join(smallest, "root"), "fp", "left")
                  .select("fp", "n", F.coalesce("root", "fp").alias("root"), F.coalesce("smallest", "first").alias("component_id")), "classes")
    drop_written(distinct, pairs)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component_id): one row per row of ``docs``."""
    prints = fingerprints(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "text", "fp", shingle)
    prints = written(prints.select("doc_id", "fp"), "simhash")
    of = classes(prints, max_bits)
    # Fewer than HOT fingerprints can hold more than 1 / HOT of all rows each; their rows stay where they are.
    total = of.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = F.broadcast(of.where(F.col("n") * HOT > total).select("fp", "component_id"))
    others = prints.join(hot, "fp", "left_anti").join(of.select("fp", "component_id"), "fp")
    found = prints.join(hot, "fp").unionByName(others).select("doc_id", "fp", "component_id")
    return found.withColumnRenamed("doc_id", id_col)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` per component: the smallest id, nulls last, then the smallest digest of the text.

    Decided on ids, fingerprints and digests. Rows with their texts are shuffled once, by id and digest, to drop what
    goes and all but one of equal rows.
    """
    digest = lambda c: F.xxhash64(F.coalesce(c, F.lit(""))).alias("__digest")
    rows = docs.withColumn("__id", F.col(id_col).cast("long")).withColumn("__text", F.col(text_col))
    prints = written(fingerprints(rows.select("__id", "__text"), "__text", "fp", shingle).select("__id", digest(F.col("__text")), "fp"), "simhash")
    of = classes(prints.select(F.col("__id").alias("doc_id"), "fp"), max_bits)
    # A component's first (id, digest); its fingerprints are few rows each, so copies are counted before the join.
    first = F.min(F.struct(F.col("__id").isNull().alias("blank"), F.col("__id").alias("id"), F.col("__digest").alias("digest")))
    best = prints.groupBy("fp").agg(first.alias("first")).join(of.select("fp", "root"), "fp")
    least = best.groupBy("root").agg(F.min("first").alias("first"))
    key = ["__blank", "__key", "__digest"]
    kept = written(least.select(F.col("first.blank").alias("__blank"), F.coalesce("first.id", F.lit(0)).alias("__key"), F.col("first.digest").alias("__digest")).distinct(), "kept")
    drop_written(prints, of)
    own = F.col(id_col).cast("long")
    mine = docs.withColumns({"__blank": own.isNull(), "__key": F.coalesce(own, F.lit(0)), "__digest": digest(F.col(text_col))})
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.col(text_col)))
    return mine.join(kept, key, "left_semi").withColumn("__nth", nth).where("__nth = 1").select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint in hexadecimal and the smallest id it is linked to."""
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
