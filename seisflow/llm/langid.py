"""Language identification (9) as a mixture of languages per document.

Training counts byte trigrams of all training texts per language into a fixed number of buckets
(partial vectors per task, summed by Spark); the model is languages × buckets. For a document,
expectation-maximisation estimates the proportions π of the languages from its trigram counts c:

    maximise  Σ_g c_g log Σ_l π_l P(g | l)  −  ½ (k − 1) log n,   k languages in use, n trigrams.

The language set starts from all languages in order of their proportions in the full mixture; nested
sets are refitted and the best penalised likelihood wins. The likelihood is concave in π, so for the
best single language b no mixture gains more than max_l Σ_g c_g (P(g|l)/P(g|b) − 1); where that is below
the penalty, the single language is the answer and no EM is run.

Defined results: ``und`` with score 0 and no proportions if the text is null or has no letter, or if
nothing was learned; equal proportions go to the smaller language name; rows with a null language are
not learned from; repeated rows count as often as they come.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from seisflow.llm.common import append_columns, bound_batches, byte_view, text_slices

BUCKETS = 8192
SMOOTHING = 0.5
#: Documents counted at once: BUCKETS × this many counters.
DOCS_AT_ONCE = 512
#: Labels beyond this number are refused: the model is shipped to every task.
MAX_LANGUAGES = 500
_FOLD = np.array([b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint8)


def trigram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of each byte trigram: ASCII folded to lower case, other ASCII to blanks, blank-padded.

    Trigrams of three blanks or two leading ones are left out.
    """
    n = len(offsets) - 1
    padded = np.full(len(data) + 2 * n, 32, np.uint8)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    padded[np.arange(len(data)) + 2 * doc + 1] = _FOLD[data]
    owner = np.repeat(np.arange(n), np.diff(offsets) + 2)
    a, b, c = (padded[i:len(padded) - 2 + i] for i in range(3)) if len(padded) >= 3 else (padded[:0],) * 3
    good = ((b != 32) | (a != 32) & (c != 32)) & (owner[:-2] == owner[2:]) if len(padded) >= 3 else np.zeros(0, bool)
    code = (a[good].astype(np.uint32) << 16) | (b[good].astype(np.uint32) << 8) | c[good]
    return owner[:-2][good] if len(padded) >= 3 else owner[:0], (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


@dataclass
class Model:
    languages: list[str]
    p: np.ndarray  # buckets × languages


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn trigram probabilities per language from all rows with a language."""
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bound_batches(docs.sparkSession)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in text_slices(batch, "text"):
                langs = part.column(0).dictionary_encode()
                names, code = langs.dictionary.to_pylist(), np.asarray(langs.indices)
                doc, bucket = trigram_buckets(*byte_view(part.column(1)))
                cells = np.bincount(code[doc].astype(np.int64) * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
                for i, name in enumerate(names):
                    sums[name] = sums.get(name, 0) + cells[i]
        for name, cells in sums.items():
            at = np.flatnonzero(cells)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(cells[at], pa.int64())], names=["lang", "bucket", "n"])

    counted = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counted.limit(MAX_LANGUAGES * BUCKETS + 1).toPandas()
    languages = sorted(found["lang"].unique().tolist())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.full((BUCKETS, len(languages)), SMOOTHING)
    counts[found["bucket"].to_numpy(np.int64), np.searchsorted(languages, found["lang"].to_numpy(str)) if languages else []] += found["n"].to_numpy(np.float64)
    return Model(languages, counts / counts.sum(axis=0))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0)


def mixtures(doc: np.ndarray, c: np.ndarray, p: np.ndarray, rounds: int, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM for all documents at once: (proportions, log likelihoods). ``doc`` is sorted and dense; ``start`` zero bars a language."""
    starts = np.flatnonzero(np.diff(doc, prepend=-1))
    n, pi = _sums(c, starts)[:, None], start
    for _ in range(rounds):
        weighted = p * pi[doc]
        weighted *= (c / weighted.sum(axis=1))[:, None]
        new = _sums(weighted, starts) / n
        moved, pi = np.abs(new - pi).max(initial=0.0), new
        if moved < 1e-4:
            break
    return pi, _sums(c * np.log((p * pi[doc]).sum(axis=1)), starts)


def proportions(doc: np.ndarray, bucket: np.ndarray, n_docs: int, model: Model, rounds: int = 30) -> np.ndarray:
    """documents × languages; rows of zeros for documents without trigrams."""
    cells = np.bincount(doc * BUCKETS + bucket, minlength=n_docs * BUCKETS)
    at = np.flatnonzero(cells)
    out = np.zeros((n_docs, len(model.languages)))
    if not len(at) or not model.languages:
        return out
    d, g, c = at // BUCKETS, at % BUCKETS, cells[at].astype(np.float64)
    starts = np.flatnonzero(np.diff(d, prepend=-1))
    ids, n = d[starts], _sums(c, starts)
    single = _sums(c[:, None] * np.log(model.p)[g], starts)
    best, rank = single.argmax(axis=1), np.cumsum(np.diff(d, prepend=d[0]) > 0)
    p = model.p[g]
    gain = _sums(c[:, None] * (p / p[np.arange(len(g)), best[rank]][:, None] - 1), starts).max(axis=1)
    penalty = 0.5 * np.log(np.maximum(n, 2))
    out[ids, best] = 1.0
    open_ = gain > penalty
    if not open_.any():
        return out
    rows = open_[rank]
    sub, c, p = (np.cumsum(open_) - 1)[rank[rows]], c[rows], p[rows]
    full, _ = mixtures(sub, c, p, rounds, np.full((int(open_.sum()), p.shape[1]), 1 / p.shape[1]))
    order = np.argsort(-full, axis=1, kind="stable")
    top, chosen = single[open_].max(axis=1), out[ids[open_]]
    for k in range(2, p.shape[1] + 1):
        allowed = np.zeros_like(full)
        np.put_along_axis(allowed, order[:, :k], np.maximum(np.take_along_axis(full, order[:, :k], axis=1), 1e-6), axis=1)
        pi, like = mixtures(sub, c, p, rounds, allowed / allowed.sum(axis=1, keepdims=True))
        like -= (k - 1) * penalty[open_]
        better = like > top
        chosen[better], top[better] = pi[better], like[better]
    out[ids[open_]] = chosen
    return out


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (its proportion) and ``lang_mix`` (language → proportion, chosen set only)."""
    mix = T.MapType(T.StringType(), T.DoubleType())

    def make(texts: pa.Array) -> list[pa.Array]:
        data, offsets = byte_view(texts)
        letters = np.concatenate([[0], np.cumsum(_FOLD[data] != 32)])
        lang, score, mixed = [], [], []
        for lo in range(0, len(texts), DOCS_AT_ONCE):
            cut = offsets[lo:lo + DOCS_AT_ONCE + 1]
            body = data[cut[0]:cut[-1]]
            shares = proportions(*trigram_buckets(body, cut - cut[0]), len(cut) - 1, model)
            for i, share in enumerate(shares, lo):
                a, b = offsets[i], offsets[i + 1]
                top = int(share.argmax()) if share.any() else -1
                # Bytes from 128 up may be symbols: ask Unicode where there is no ASCII letter.
                if top < 0 or letters[a] == letters[b] or not any(ch.isalpha() for ch in data[a:b].tobytes().decode()):
                    lang.append("und"), score.append(0.0), mixed.append([])
                else:
                    lang.append(model.languages[top]), score.append(min(1.0, float(share[top])))
                    mixed.append([(model.languages[j], float(share[j])) for j in np.flatnonzero(share).tolist()])
        return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(mixed, pa.map_(pa.string(), pa.float64()))]

    return append_columns(docs, text_col, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lang_mix", mix)], make)


def held_out():
    """One document in five, by checksum of its id, is kept from all learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def language_predictions(docs: DataFrame) -> DataFrame:
    """One row per document; the model is learned from text and language of the rows that are not held out."""
    model = fit(docs.where(~held_out()).select("text", "lang"))
    scored = predict(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("lang_mix").alias("n_langs"))
