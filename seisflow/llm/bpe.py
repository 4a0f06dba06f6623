"""Byte-level BPE encoding and decoding (3) through a distinct-word table.

Spark splits every whole text into the tokenizer's words (``regexp_extract_all``, inside the JVM).
Within a task the words of a bounded block of documents are dictionary-encoded: one table of distinct
words, and each word's position in it. Each distinct word is encoded once; ids come back to every
position by a take on the table (a join on the word's number). Decoding is the same join the other way:
a table of id → bytes, taken by id, concatenated per document.

The table is kept per block of documents and not for the corpus: a corpus-wide word table would
have to be joined back to every word occurrence, a shuffle of several times the input (README).

Defined results: a null text encodes like an empty one, to no ids and empty text; the string of a
special token inside a text becomes that token's id, as the tokenizers library does; ids that the
vocabulary lacks decode to nothing; repeated rows are encoded each for itself.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, functions as F, types as T

from seisflow.llm.common import append_columns, bound_batches, ragged_take

#: Words that are encoded, decoded and hashed at once.
SLICE_WORDS = 1 << 20
# Fixed value: the byte-level vocabulary's word pattern, with Unicode white space spelled out for the JVM.
_SPACE = r"\p{IsWhite_Space}"
ROW_WORD = r"^ (\p{L}+|\p{N}+)$"
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|{_SPACE}+(?!\P{{IsWhite_Space}})|{_SPACE}+"


class Vocabulary:
    """A tokenizer file's text, small and of fixed size, so that it ships with the tasks."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            self.text = f.read()
        self.special = [t["content"] for t in json.loads(self.text)["added_tokens"]]
        self._tokenizer = None

    def __getstate__(self) -> dict:
        return {"text": self.text, "special": self.special, "_tokenizer": None}

    @property
    def tokenizer(self):
        if self._tokenizer is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_str(self.text)
            self._tokenizer.no_truncation()
            self._tokenizer.no_padding()
        return self._tokenizer

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each word), for an array of different words.

        Words of a blank and only letters or only digits stay words of their own in a row of such words, so these go
        to the tokenizer in long rows, which say of each id to which word it belongs; the others go one by one.
        """
        if not len(words):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        plain = pa.compute.match_substring_regex(words, ROW_WORD).to_numpy(zero_copy_only=False)
        texts, lengths, found = words.to_pylist(), np.zeros(len(words), np.int64), []
        alone = [np.flatnonzero(~plain)]
        for at in np.array_split(np.flatnonzero(plain), -(-int(plain.sum()) // 4096) or 1):
            row = self.tokenizer.encode("".join([texts[i] for i in at]), add_special_tokens=False)
            counts = np.bincount(np.array(row.word_ids, np.int64), minlength=len(at))
            if len(counts) == len(at) and counts.all():
                lengths[at] = counts
                found.append((at, np.array(row.ids, np.int32)))
            else:  # the tokenizer cuts some word otherwise than the pattern does
                alone.append(at)
        alone = np.concatenate(alone)
        for at in np.array_split(alone, -(-len(alone) // 4096) or 1):
            ids = [e.ids for e in self.tokenizer.encode_batch([texts[i] for i in at], add_special_tokens=False)]
            lengths[at] = [len(i) for i in ids]
            found.append((at, np.array([x for i in ids for x in i], np.int32)))
        # Ids in the order of the words.
        order = np.concatenate([at for at, _ in found])
        flat, starts = np.concatenate([ids for _, ids in found]), np.empty(len(words), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        return ragged_take(flat, starts, lengths), lengths

    def pieces(self) -> pa.Array:
        """The bytes of each id, by id."""
        # Fixed value: the byte-level alphabet keeps printable bytes and moves the others to 256 and up.
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in kept)}
        out = [b""] * (max(self.tokenizer.get_vocab().values()) + 1)
        for piece, i in self.tokenizer.get_vocab().items():
            known = all(c in byte_of for c in piece)
            out[i] = bytes(byte_of[c] for c in piece) if known else piece.encode()
        return pa.array(out, pa.binary())


def words_of(text: Column, special: list[str]) -> Column:
    """The tokenizer's words of a text; special tokens are words of their own and end the text around them."""
    split = lambda t: F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    if not special:
        return split(text)
    either = "|".join(re.escape(s) for s in special)
    parts = F.regexp_extract_all(text, F.lit(rf"(?s){either}|(?:(?!{either}).)++"), F.lit(0))
    mixed = F.flatten(F.transform(parts, lambda p: F.when(p.isin(*special), F.array(p)).otherwise(split(p))))
    holds = [F.contains(text, F.lit(s)) for s in special]
    return F.when(F.greatest(*holds) if len(holds) > 1 else holds[0], mixed).otherwise(split(text))


def _span(column: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """(values, offsets from 0) of a list column without nulls."""
    offsets = np.asarray(column.offsets).astype(np.int64)
    return column.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]


def encode_lists(vocabulary: Vocabulary, column: pa.ListArray) -> pa.ListArray:
    """The ids of each list of words, through the table of distinct words in all of them."""
    words, offsets = _span(column)
    flat = words.dictionary_encode()
    table, lengths = vocabulary.encode_words(flat.dictionary)
    at = np.asarray(flat.indices).astype(np.int64)
    ids = ragged_take(table, (np.cumsum(lengths) - lengths)[at], lengths[at])
    ends = np.concatenate([[0], np.cumsum(lengths[at])])[offsets]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def _joined(column: pa.ListArray, table: pa.Array, between: bytes) -> list[bytes]:
    """Each list's rows of a table of bytes by id, joined; ids that the table lacks are left out."""
    ids, offsets = _span(column)
    known = np.asarray(pa.compute.and_kleene(pa.compute.greater_equal(ids, 0), pa.compute.less(ids, len(table))).fill_null(False))
    if not known.all():
        ids, offsets = ids.filter(pa.array(known)), np.concatenate([[0], np.cumsum(known)])[offsets]
    return pa.compute.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), table.take(ids)), between).to_pylist()


class Decoder:
    """The join of ids with the table of their bytes."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.pieces = vocabulary.pieces()

    def texts(self, column: pa.ListArray) -> list[str]:
        return [b.decode("utf-8", "replace") for b in _joined(column, self.pieces, b"")]


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with ``out``: the token ids of the whole text. ``text_col`` is not kept."""
    words = docs.withColumn(out, words_of(F.coalesce(F.col(text_col), F.lit("")), vocabulary.special)).drop(text_col)
    return _replace_list(words, out, T.ArrayType(T.IntegerType()), lambda column: encode_lists(vocabulary, column))


def decode(docs: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out``: the text of the ids, special tokens included. A null list decodes to an empty text."""
    decoder = Decoder(vocabulary)
    kept = docs.withColumn(out, F.coalesce(F.col(ids_col), F.array().cast("array<int>")))
    return _replace_list(kept, out, T.StringType(), lambda column: pa.array(decoder.texts(column), pa.string()))


def _replace_list(df: DataFrame, column: str, kind: T.DataType, make: Callable[[pa.ListArray], pa.Array]) -> DataFrame:
    """``df`` with a list column replaced by what ``make`` computes of it, batch by batch."""
    schema = T.StructType([T.StructField(f.name, kind) if f.name == column else f for f in df.schema])
    bound_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(column)
            arrays = [make(c) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return df.mapInArrow(run, schema)


def word_slices(column: pa.ListArray, limit: int = SLICE_WORDS) -> Iterator[tuple[int, pa.ListArray]]:
    """(first row, rows) in runs of at most ``limit`` words (one row at least)."""
    ends, start = np.asarray(column.offsets).astype(np.int64), 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1)
        yield start, column.slice(start, stop - start)
        start = stop


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: number of ids, digest of the ids, digest of the text decoded from them.

    One stage from words to digests: ids and decoded texts stay inside it, for a bounded number of words at a time.
    """
    vocabulary = Vocabulary(path)
    words = docs.select("doc_id", words_of(F.coalesce("text", F.lit("")), vocabulary.special).alias("words"))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    digest = lambda data: hashlib.sha256(data).hexdigest()
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary)
        decimals = pa.array([str(i).encode() for i in range(len(decoder.pieces))], pa.binary())
        for batch in batches:
            for start, column in word_slices(batch.column(1)):
                ids = encode_lists(vocabulary, column)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, len(column)), ids.value_lengths().cast(pa.int64()),
                    pa.array([digest(b) for b in _joined(ids, decimals, b",")], pa.string()),
                    pa.array([digest(x.encode()) for x in decoder.texts(ids)], pa.string())], names=names)

    kind = T.StructType([docs.schema["doc_id"], *[T.StructField(n, T.LongType() if n == "n_tokens" else T.StringType()) for n in names[1:]]])
    return words.mapInArrow(run, kind)
