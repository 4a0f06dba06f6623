"""Benchmark decontamination (2): rare n-gram seeds, then Smith-Waterman alignment.

Texts are compared as words (ASCII case folded, ASCII punctuation as blanks; each character of a script without blanks
is a word). The score of an item in a document is the best local alignment (match 2, mismatch and gap -1) over that of
a full copy; a score of at least ``LEAST_SCORE`` is a leak.

Seeds are pairs of an item's words, next to each other or with one word between them, met in a document next to each
other or with one word between. An alignment of ``M`` matched words that scores at least the item's length ``n`` has at
most ``2 M - n`` edits between them, so at least ``n / 2 - 1`` of the steps from one matched word to the next hold at
most one edit: each is such a pair, with a first word of its own. So seeds may leave out the pairs of the item's
most frequent first words, half as many as that, and still each leak holds the other half within ``2 n`` words.
Only where a document has so many seeds of an item, the words around are aligned with the whole item. No copy that
reaches the score is lost, however its edits lie; frequent pairs cost no candidates.

The items are the query set: they are read in blocks of bounded size, each block is one pass over all documents, and
documents are never shuffled. Where there are several blocks, what a pass found is written before the next is built.

Defined results: null or empty texts have no leaks; items without words (null ones too) are never found; items of one or
two words are found where they stand as a whole; several copies of an item in a document are one leak, the best (first
among equals); repeated items are reported each; repeated documents are searched each for itself.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from seisflow.llm.common import append_columns, bound_batches, drop_written, text_bytes, written

LEAST_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, 1
#: Items of fewer words are searched as a whole.
SHORT = 3
#: Text of the items searched for at once; more items take more passes.
BLOCK_BYTES = 8 << 20
_FOLD = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
# Blocks of scripts that are written without blanks (Thai to Myanmar, Khmer, kana, Han).
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
_LONG = re.compile(rb"[\xe0-\xf4]")


def words_of(text: bytes) -> list[bytes]:
    if _LONG.search(text):
        text = _UNSPACED.sub(r" \1 ", text.decode("utf-8", "replace")).encode()
    return text.translate(_FOLD).split()


def item_blocks(items: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The items in blocks of at most ``limit`` bytes of text (one item at least)."""
    block, size = [], 0
    for r in items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).orderBy("id", "text").toLocalIterator():
        text = (r["text"] or "").encode()
        words = words_of(text)
        if not words:
            continue
        if block and size + len(text) > limit:
            yield block
            block, size = [], 0
        block.append((r["id"], words))
        size += len(text)
    if block:
        yield block


def word_frequencies(docs: DataFrame, text_col: str, vocabulary: set[bytes]) -> dict[bytes, float]:
    """Share of all words of all documents, for the words of ``vocabulary``."""
    bound_batches(docs.sparkSession)

    def run(batches):
        n: Counter = Counter()
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                words = words_of(text)
                n[b""] += len(words)
                n.update(w for w in words if w in vocabulary)
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n = {bytes(r["word"]): r["n"] for r in rows}
    total = max(1, n.pop(b"", 1))
    return {w: c / total for w, c in n.items()}


def align(window: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """(score, end in the window) of the best local alignment, over all gaps, a row at a time."""
    slope = np.arange(len(window) + 1) * GAP
    row, best, end = np.zeros(len(window) + 1, np.int64), 0, 0
    for w in item:
        to = np.maximum(row - GAP, 0)
        np.maximum(to[1:], row[:-1] + np.where(window == w, MATCH, MISMATCH), out=to[1:])
        row = np.maximum.accumulate(to + slope) - slope
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


class Seeds:
    """The seeds of a block of items, as sorted codes of word pairs with the items and places they belong to."""

    def __init__(self, items: list[list[bytes]], share: dict[bytes, float]) -> None:
        self.items = items
        self.number = {w: i for i, w in enumerate(sorted({w for t in items for w in t}))}
        self.coded = [np.array([self.number[w] for w in t], np.int64) for t in items]
        floor, size = min(share.values(), default=1.0), len(self.number)
        p = np.array([share.get(w, floor) for w in self.number], np.float64)
        codes: list[int] = []
        owner: list[int] = []
        self.enough = np.ones(len(items), np.int64)
        self.span = np.array([2 * len(t) for t in items], np.int64)
        for k, c in enumerate(self.coded):
            n = len(c)
            if n < SHORT:
                # The first word stands for the whole item, which is compared where it occurs.
                codes.append(2 * size * size + int(c[0]))
                owner.append(k)
                continue
            steps = -(-(n - 2) // 2)  # n / 2 - 1, rounded up
            left_out = steps // 2
            self.enough[k] = steps - left_out
            often = [p[c[i]] * sum(p[c[j]] for j in (i + 1, i + 2) if j < n) for i in range(n - 1)]
            kept = sorted(range(n - 1), key=lambda i: (often[i], i))[:n - 1 - left_out]
            for i in kept:
                for j in (i + 1, i + 2):
                    if j < n:
                        codes += [int(c[i]) * size + int(c[j]), size * size + int(c[i]) * size + int(c[j])]
                        owner += [k, k]
        order = np.lexsort((owner, codes)) if codes else np.zeros(0, np.int64)
        self.codes, first = np.unique(np.array(codes, np.int64)[order], return_index=True)
        self.first = np.append(first, len(order))
        self.owner = np.array(owner, np.int64)[order]

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, place) of every seed in a row of word numbers (-1: no word of an item), by item and place."""
        size, places, found = len(self.number), [], []
        for shift, a, b in ((0, words[:-1], words[1:]), (1, words[:-2], words[2:]), (2, words, None)):
            at = np.flatnonzero((a >= 0) & (b >= 0)) if b is not None else np.flatnonzero(a >= 0)
            code = shift * size * size + (a[at] * size + b[at] if b is not None else a[at])
            i = np.searchsorted(self.codes, code)
            known = i < len(self.codes)
            known[known] = self.codes[i[known]] == code[known]
            places.append(at[known])
            found.append(i[known])
        at, i = np.concatenate(places), np.concatenate(found)
        times = self.first[i + 1] - self.first[i]
        item = self.owner[np.repeat(self.first[i] - np.cumsum(times) + times, times) + np.arange(times.sum())]
        at = np.repeat(at, times)
        order = np.lexsort((at, item))
        return item[order], at[order]

    def candidates(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, place) from which on, within an item's span, there are enough of its seeds."""
        item, at = self.hits(words)
        far = len(words) + int(self.span.max(initial=0)) + 1
        key = item * far + at
        good = np.searchsorted(key, key + self.span[item], side="right") - np.arange(len(key)) >= self.enough[item]
        return item[good], at[good]


def _whole(words: np.ndarray, item: np.ndarray, places: np.ndarray) -> tuple[int, int] | None:
    """(score, end) of the first place where a short item stands as a whole."""
    for s in places.tolist():
        if s + len(item) <= len(words) and (words[s:s + len(item)] == item).all():
            return MATCH * len(item), s + len(item)
    return None


def _best(words: np.ndarray, item: np.ndarray, places: np.ndarray) -> tuple[int, int] | None:
    """(score, end) of the item's best alignment with the words around the places."""
    if len(item) < SHORT:
        return _whole(words, item, places)
    best, spans = None, []
    for s in places.tolist():
        lo, hi = max(0, s - 2 * len(item)), min(len(words), s + 2 * len(item) + 2)
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = hi
        else:
            spans.append([lo, hi])
    for lo, hi in spans:
        score, end = align(words[lo:hi], item)
        if best is None or score > best[0]:
            best = (score, lo + end)
    return best


def find_all(texts: list[bytes], seeds: Seeds, least: float) -> list[list[tuple[int, float, int, int]]]:
    """Per text (item, score, first word, end word) of each leak, by item."""
    out: list[list[tuple[int, float, int, int]]] = [[] for _ in texts]
    rows, starts, total = [], [], 0
    for text in texts:
        words = words_of(text)
        rows.append(np.fromiter(map(seeds.number.get, words, repeat(-1)), np.int64, len(words)))
        rows.append(np.full(2, -1))  # no pair reaches from one text into the next
        starts.append(total)
        total += len(words) + 2
    if not rows:
        return out
    item, at = seeds.candidates(np.concatenate(rows))
    text = np.searchsorted(starts, at, side="right") - 1
    order = np.lexsort((at, item, text))
    item, at, text = item[order], at[order], text[order]
    cuts = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0))
    for lo, hi in zip(cuts, np.append(cuts[1:], len(text))):
        i, k = int(text[lo]), int(item[lo])
        best, n = _best(rows[2 * i], seeds.coded[k], at[lo:hi] - starts[i]), len(seeds.coded[k])
        if best is not None and best[0] >= least * MATCH * n:
            out[i].append((k, best[0] / (MATCH * n), max(0, best[1] - n), best[1]))
    return out


LEAK = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW_LEAK = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))


def find_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", out: str = "leaks", item_id: str = "item_id", item_text: str = "text",
               least: float = LEAST_SCORE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``out``: array of (item_id, score, start, end), about where in the document's words the copy lies."""
    def search(block: list[tuple[int | None, list[bytes]]]):
        ids, texts = [i for i, _ in block], [w for _, w in block]
        seeds = Seeds(texts, word_frequencies(docs, text_col, {w for t in texts for w in t}))

        def make(column: pa.Array) -> list[pa.Array]:
            found = find_all(text_bytes(column), seeds, least)
            return [pa.array([[{"item_id": ids[k], "score": s, "start": a, "end": b} for k, s, a, b in x] for x in found], _ARROW_LEAK)]

        return make

    # A column that goes by the name of the result is replaced; the text stays beside it.
    made, before, n = docs.drop(out) if out != text_col else docs, None, 0
    made = made.withColumn("__leaks_so_far", F.array().cast(LEAK))
    for n, block in enumerate(item_blocks(items, item_id, item_text, block_bytes)):
        if n:
            cut = written(made, "leaks")
            if before is not None:
                drop_written(before)
            made = before = cut
        made = append_columns(made, text_col, [T.StructField("__leaks_here", LEAK)], search(block))
        made = made.withColumn("__leaks_so_far", F.concat("__leaks_so_far", "__leaks_here")).drop("__leaks_here")
    return made.withColumn(out, F.col("__leaks_so_far")).drop("__leaks_so_far")


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a leak; their columns unchanged."""
    return find_leaks(docs, items, text_col, "__leaks").where(F.size("__leaks") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def leak_rows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item it leaks."""
    found = find_leaks(docs.select("doc_id", "text"), items).select("doc_id", F.explode("leaks").alias("leak"))
    return found.select("doc_id", "leak.item_id", F.round("leak.score", 6).alias("score"), F.col("leak.start").alias("first_word"), F.col("leak.end").alias("end_word"))
