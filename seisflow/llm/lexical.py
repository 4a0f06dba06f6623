"""Ranked lexical search (13) over posting lists in geometric blocks.

The collection is read once: each text becomes the terms it shares with the stated queries, their frequencies and its
length; only these arrays are shuffled. Documents are range-partitioned by a similarity key, the signs of random
projections of their weight vectors in Gray order, so that alike documents lie side by side. Every stretch of
``CLUSTER`` documents cuts all posting lists at the same two places: a term's postings inside it are one block of that
term's list. The stretch stores its blocks and the coordinatewise maximum of its documents' vectors.

A query's bound for a block is the sum of the stored maxima over its terms; no document of the block can score more.
A block is skipped only where that bound is below the query's 50th best score so far in the same task (or is 0), so
results are exact, ties included. Each task returns its best documents per query, and Spark ranks these.

Scores are integers: ``w * ((10^9 * tf) div (1000 * tf + 20 * m))`` summed over a query's terms, with
``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and ``m = 50 + (50 * n * N) div L``. N, L and df cover all documents.

Queries come in blocks of bounded bytes; each block's results are written before the next is read.

Defined results: a null or empty text has no terms and is found by nothing; a query without terms finds nothing;
repeated rows of either table are documents or queries of their own; equal scores go by ascending doc_id, null first;
other columns are not looked at; an empty table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from seisflow.llm.common import bound_batches, drop_written, text_bytes, text_slices, written

#: Documents that a ranking returns for each query.
TOP = 50
#: Documents of a block, and bits of the similarity key.
CLUSTER, KEY_BITS = 128, 32
#: Bytes of query texts that a pass takes to its tasks.
BLOCK_BYTES = 8 << 20
# Fixed value: what ends a term is blank, A to Z are folded, all else stays.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII; A to Z are folded."""
    return text.translate(_FOLD).split()


class Queries:
    """A block of queries: their vocabulary and, flat, the vocabulary numbers of each one's terms."""

    def __init__(self, texts: list[bytes]) -> None:
        sets = [set(terms_of(t)) for t in texts]
        self.vocabulary = {t: i for i, t in enumerate(sorted(set().union(*sets)))}
        self.live = np.array([i for i, s in enumerate(sets) if s], np.int64)
        self.terms = [np.array(sorted(self.vocabulary[t] for t in sets[i]), np.int64) for i in self.live]


def frequencies(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): length of each text in terms, and its terms of the vocabulary with their frequencies."""
    bound_batches(docs.sparkSession)
    names = ["doc_id", "n", "terms", "tfs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                n, terms, tfs = [], [], []
                for text in text_bytes(part.column(1)):
                    words = terms_of(text)
                    found = Counter(map(vocabulary.get, words))
                    found.pop(None, None)
                    n.append(len(words))
                    terms.append(list(found.keys()))
                    tfs.append(list(found.values()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                                                  pa.array(tfs, pa.list_(pa.int64()))], names=names)

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("n long, terms array<int>, tfs array<long>").fields])
    return rows.mapInArrow(run, kind)


def weights(postings: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """(weight of each vocabulary number, N, L): one row per term of the stated queries reaches the driver."""
    total = postings.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    w = np.zeros(size, np.int64)
    for r in postings.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        w[r["t"]] = math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * r["df"] + 1)))
    return w, total["docs"], total["terms"]


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list column."""
    offsets = np.asarray(column.offsets).astype(np.int64)
    return np.asarray(column.values.slice(offsets[0], offsets[-1] - offsets[0])).astype(np.int64), offsets - offsets[0]


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def impacts(postings: DataFrame, w: np.ndarray, n_docs: int, n_terms: int, seed: int = 13) -> DataFrame:
    """(key, doc_id, terms, parts): the tf part of each term's score, and the similarity key; documents that can score only."""
    planes = np.random.default_rng(seed).choice([-1.0, 1.0], (len(w), KEY_BITS)).astype(np.float32) * w[:, None].astype(np.float32)
    names = ["key", "doc_id", "terms", "parts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, offsets = _flat(batch.column(2))
            tfs, _ = _flat(batch.column(3))
            m = 50 + (50 * np.asarray(batch.column(1)).astype(np.int64) * n_docs) // max(n_terms, 1)
            owner = np.repeat(np.arange(len(m)), np.diff(offsets))
            kept = w[terms] > 0
            terms, tfs, owner = terms[kept], tfs[kept], owner[kept]
            parts = (1_000_000_000 * tfs) // (1000 * tfs + 20 * m[owner])
            starts = np.searchsorted(owner, np.arange(len(m) + 1))
            some = np.flatnonzero(np.diff(starts))
            if not len(some):
                continue
            key = np.zeros(len(some), np.int64)
            for j in range(KEY_BITS):
                side = np.add.reduceat(planes[terms, j] * parts, starts[some]) > 0
                key = key << 1 | side
            for shift in (1, 2, 4, 8, 16):  # from Gray code to its place in the sequence
                key ^= key >> shift
            ends = np.concatenate([[0], starts[some + 1]])
            yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0).take(pa.array(some)), _lists(terms, ends, pa.int32()), _lists(parts, ends, pa.int32())], names=names)

    bound_batches(postings.sparkSession)
    kind = T.StructType([T.StructField("key", T.LongType()), postings.schema["doc_id"], *T._parse_datatype_string("terms array<int>, parts array<int>").fields])
    return postings.select("doc_id", "n", "terms", "tfs").mapInArrow(run, kind)


def cluster_blocks(vectors: DataFrame, cluster: int = CLUSTER) -> DataFrame:
    """The index: rows (docs, terms, starts, places, parts, summary), one per stretch of ``cluster`` alike documents.

    ``terms`` are the stretch's terms; the block of the i-th is ``places[starts[i]:starts[i + 1]]`` into ``docs`` with its
    ``parts``; ``summary`` is the coordinatewise maximum of the parts.
    """
    id_type = vectors.schema["doc_id"].dataType
    names = ["docs", "terms", "starts", "places", "parts", "summary"]

    def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        terms, offsets = _flat(whole.column(1))
        parts, _ = _flat(whole.column(2))
        place = np.repeat(np.arange(whole.num_rows), np.diff(offsets))
        order = np.argsort(terms, kind="stable")
        terms, parts, place = terms[order], parts[order], place[order]
        starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
        one = lambda a, kind: pa.array([a], pa.list_(kind))
        ids = pa.ListArray.from_arrays(pa.array([0, whole.num_rows], pa.int32()), whole.column(0))
        return pa.RecordBatch.from_arrays([ids, one(terms[starts], pa.int32()), one(np.append(starts, len(terms)), pa.int32()), one(place, pa.int32()),
                                           one(parts, pa.int32()), one(np.maximum.reduceat(parts, starts), pa.int32())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                take = min(cluster - n, batch.num_rows - at)
                held.append(batch.slice(at, take))
                at, n = at + take, n + take
                if n == cluster:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    kind = T.StructType([T.StructField("docs", T.ArrayType(id_type)),
                         *T._parse_datatype_string("terms array<int>, starts array<int>, places array<int>, parts array<int>, summary array<int>").fields])
    # The last key tells repeated documents apart, so that they can lie in several parts.
    order = ["key", "doc_id", "tie"]
    sorted_rows = vectors.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return sorted_rows.select("doc_id", "terms", "parts").mapInArrow(run, kind)


class Best:
    """The best documents of one query so far; ``least`` is the score below which no document can still enter."""

    def __init__(self, top: int) -> None:
        self.top, self.least = top, 1
        self.scores, self.ids, self.blank = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, blank: np.ndarray) -> None:
        scores, ids, blank = np.append(self.scores, scores), np.append(self.ids, ids), np.append(self.blank, blank)
        order = np.lexsort((ids, ~blank, -scores))[:self.top]
        self.scores, self.ids, self.blank = scores[order], ids[order], blank[order]
        if len(order) == self.top:
            self.least = int(self.scores[-1])


def search_blocks(index: DataFrame, queries: Queries, w: np.ndarray, top: int = TOP) -> DataFrame:
    """(query, doc_id, score): each task's best documents for every query, by exact bounds."""
    terms = np.concatenate(queries.terms) if queries.terms else np.zeros(0, np.int64)
    starts = np.cumsum([0, *map(len, queries.terms)])[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in queries.terms]
        least = np.ones(len(best), np.int64)
        peak, row_of = np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                docs = batch.column(0)[i].values
                own, cuts, places, parts, summary = (np.asarray(batch.column(c)[i].values).astype(np.int64) for c in range(1, 6))
                peak[own] = summary * w[own]
                near = np.flatnonzero(np.add.reduceat(peak[terms], starts) >= least)
                if len(near):
                    ids, blank = np.asarray(docs.fill_null(0)).astype(np.int64), np.asarray(docs.is_null())
                    # One row per block of a term; the last row stands for terms without one.
                    dense = np.zeros((len(own) + 1, len(docs)), np.int64)
                    dense[np.repeat(np.arange(len(own)), np.diff(cuts)), places] = parts * np.repeat(w[own], np.diff(cuts))
                    row_of[:] = len(own)
                    row_of[own] = np.arange(len(own))
                    for q in near:
                        scores = dense[row_of[queries.terms[q]]].sum(axis=0)
                        found = np.flatnonzero(scores >= least[q])
                        if len(found):
                            best[q].add(scores[found], ids[found], blank[found])
                            least[q] = best[q].least
                peak[own] = 0
        for q, b in enumerate(best):
            if len(b.ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.ids), queries.live[q])), pa.array(b.ids, mask=b.blank), pa.array(b.scores)],
                                                 names=["query", "doc_id", "score"])

    bound_batches(index.sparkSession, 64)
    return index.mapInArrow(run, "query long, doc_id long, score long")


def query_blocks(items: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[object, bytes]]]:
    """(id, text) of all queries, in blocks of at most ``limit`` bytes (one query at least); one block is held at a time."""
    block, size = [], 0
    for r in items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).toLocalIterator():
        text = r["text"].encode()
        if block and size + len(text) > limit:
            yield block
            block, size = [], 0
        block.append((r["item_id"], text))
        size += len(text)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item with a score above 0."""
    spark, found = docs.sparkSession, []
    kind = T.StructType([items.schema["item_id"], *T._parse_datatype_string("rank int, doc_id long, score long").fields])
    for block in query_blocks(items):
        queries = Queries([t for _, t in block])
        postings = written(frequencies(docs, queries.vocabulary), "search_postings")
        w, n_docs, n_terms = weights(postings, len(queries.vocabulary))
        vectors = written(impacts(postings, w, n_docs, n_terms), "search_vectors")
        drop_written(postings)
        index = written(cluster_blocks(vectors), "search_index")
        drop_written(vectors)
        by_score = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
        ranked = search_blocks(index, queries, w, top).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
        # The queries' ids, of a block of bounded bytes.
        ids = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], T.StructType([T.StructField("query", T.LongType()), kind["item_id"]]))
        found.append(written(ranked.join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score"), "search_found"))
        drop_written(index)
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], kind)


def oracle(top: int = TOP) -> str:
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS x FROM documents),
c AS (SELECT count(*) AS n, sum(len(x)) AS l FROM d WHERE len(x) > 0),
p AS MATERIALIZED (SELECT r, doc_id, any_value(len(x)) AS n, t, count(*) AS tf FROM (SELECT r, doc_id, x, unnest(x) AS t FROM d) GROUP BY r, doc_id, t),
w AS (SELECT t, floor(1000 * ln((2 * any_value(c.n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, c GROUP BY t),
s AS (SELECT r, doc_id, p.t, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * p.n * c.n) // c.l)::BIGINT))) AS part FROM p JOIN w ON w.t = p.t, c),
i AS (SELECT row_number() OVER () AS q, item_id, {words} AS x FROM benchmark),
it AS (SELECT DISTINCT q, item_id, unnest(x) AS t FROM i),
f AS (SELECT q, item_id, r, doc_id, sum(part)::BIGINT AS score FROM it JOIN s ON s.t = it.t GROUP BY q, item_id, r, doc_id HAVING sum(part) > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM f) WHERE rank <= {top}"""
