"""Toxicity (10) by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives P; all training documents together are the unlabelled U.
A linear classifier g over words and word openings (their presence, and how often they come) minimises

    π E_P[ℓ(g, +1)] + max(0, E_U[ℓ(g, −1)] − π E_P[ℓ(g, −1)])

with logistic loss and the class prior π; where the bracket falls below zero its gradient is reversed,
so that the classifier does not fit U as if all of it were negative.

The document frequencies that choose the features, and the prior, come from all training rows: one pass counts
every feature among the positives and among all (an aggregate with map-side partials), and the tests for a feature
are column expressions. Every feature that passes them is in the model.

The risk is that of all training rows too. One more pass turns each text into its cells (features of the model, with
their rates in ``LEVELS`` steps); equal rows of cells are summed up to one with two counts, and that small table is
written. Each step of the fit is an aggregate over it in DataFrame functions, with map-side partials: the risk and its
gradient in whole numbers, so that a model does not depend on how the rows are dealt. The weights with the least risk
of all steps are the model.

Defined results: a null or empty text has no features and gets the score of the bias alone; without
positives every score is 0; repeated label rows count as toxic if one of them is; repeated documents
are learned and scored each for itself.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from seisflow.llm.common import append_columns, bound_batches, drop_written, text_bytes, text_slices, written
from seisflow.operators.common import broadcast_if_small, known_rows

#: A task hands on its counts when it holds so many different features, or rows of cells of so many bytes.
HELD_FEATURES, HELD_CELLS = 200_000, 32 << 20
#: Steps of the fit, and the length of the first.
STEPS, LENGTH = 60, 0.1
#: A feature is kept if at least this share of the documents that have it is estimated to be toxic (π P(f | P) / P(f | U)).
LEAST_SHARE = 0.25
#: And if the positives hold it so many standard deviations more often than all documents do.
LEAST_EXCESS = 4.0
OPENINGS = (3, 4, 5, 6)
RATE, LEVELS = 40, 16
#: Sums of the risk are whole multiples of 1 / UNIT for each row.
UNIT = 1 << 20
_FOLD = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def features(text: bytes) -> set[bytes]:
    """Words (marked by a trailing blank) and openings of longer words, ASCII case folded."""
    words = set(text.translate(_FOLD).split())
    out = {w + b" " for w in words}
    for k in OPENINGS:
        out.update(w[:k] for w in words if len(w) > k)
    return out


def cells(text: bytes, number: dict[bytes, int]) -> list[int]:
    """Numbered features of a text in order, each times ``LEVELS`` plus its level: the rate of its words, the last from one word in ``RATE`` on."""
    words = text.translate(_FOLD).split()
    found: dict[int, int] = {}
    for w, n in Counter(words).items():
        for f in (w + b" ", *(w[:k] for k in OPENINGS if len(w) > k)):
            if f in number:
                found[number[f]] = found.get(number[f], 0) + n
    return [i * LEVELS + min(LEVELS, -(-n * RATE * LEVELS // len(words))) - 1 for i, n in sorted(found.items())]


def margins(flat: np.ndarray, row: np.ndarray, n: int, theta: np.ndarray) -> np.ndarray:
    """g of ``n`` rows; ``flat``: their cells one after the other, ``row``: which row each is in."""
    k = len(theta) // 2
    at, level = flat // LEVELS, flat % LEVELS + 1
    return np.bincount(row, theta[at] + theta[k + at] * (level / LEVELS), n) + theta[-1]


@dataclass
class Model:
    """``weights``: of each feature's presence, then of each feature's rate."""

    names: list[bytes]
    weights: np.ndarray
    bias: float


def _count(docs: DataFrame) -> DataFrame:
    """(feature, p, u): in how many positive documents, and in how many of all, a feature occurs; of ``docs`` (positive, text)."""
    bound_batches(docs.sparkSession)

    def summed(p: Counter, u: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(u), pa.binary()), pa.array([p[f] for f in u], pa.int64()), pa.array(list(u.values()), pa.int64())], names=["feature", "p", "u"])

    def run(batches):
        p, u = Counter(), Counter()
        for batch in batches:
            for positive, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                found = features(text)
                u.update(found)
                if positive:
                    p.update(found)
                if len(u) >= HELD_FEATURES:
                    yield summed(p, u)
                    p, u = Counter(), Counter()
        yield summed(p, u)

    return docs.select("positive", "text").mapInArrow(run, "feature binary, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def chosen(counts: DataFrame, n_p: int, n_u: int, prior: float) -> list[bytes]:
    """The features that pass the tests; ``counts``: (feature, p, u)."""
    # An excess of so many deviations needs more than as many positives. The same holds, as their count is
    # whole, for a longer feature that has 0.9 of them.
    held = written(counts.where(F.col("p") > LEAST_EXCESS), "features")
    # An opening says no more than a longer feature that nearly all its positives hold.
    cuts = F.array(*[F.when(F.octet_length("feature") > k, F.substring("feature", 1, k)) for k in OPENINGS])
    longer = held.select(F.explode(cuts).alias("feature"), "p").where("feature is not null").groupBy("feature").agg(F.max("p").alias("longer"))
    a, b = F.col("p") / F.lit(n_p), F.col("u") / F.lit(n_u)
    excess = n_p * (a - b) / F.sqrt(n_p * b + 1)
    told = held.join(longer, "feature", "left").where(F.col("longer").isNull() | (F.col("longer") < 0.9 * F.col("p")))
    kept = told.where((prior * a >= LEAST_SHARE * b) & (excess >= LEAST_EXCESS)).select("feature")
    names = sorted(bytes(r["feature"]) for r in kept.collect())
    drop_written(held)
    return names


def cell_rows(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(cells, p, u): each different row of cells, and how many positive documents and how many of all have it; of ``docs`` (positive, text)."""
    bound_batches(docs.sparkSession)

    def summed(p: Counter, u: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(u), pa.list_(pa.int32())), pa.array([p[c] for c in u], pa.int64()), pa.array(list(u.values()), pa.int64())], names=["cells", "p", "u"])

    def run(batches):
        p, u, held = Counter(), Counter(), 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                for positive, text in zip(part.column(0).to_pylist(), text_bytes(part.column(1))):
                    found = tuple(cells(text, number))
                    held += 32 * len(found) + 100 if found not in u else 0
                    u[found] += 1
                    if positive:
                        p[found] += 1
                    if held >= HELD_CELLS:
                        yield summed(p, u)
                        p, u, held = Counter(), Counter(), 0
        yield summed(p, u)

    return docs.select("positive", "text").mapInArrow(run, "cells array<int>, p long, u long").groupBy("cells").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def sums(rows: DataFrame, theta: np.ndarray) -> np.ndarray:
    """Over ``rows`` (cells, p, u): Σ log(1 + e^g) and Σ σ(g) x, a line for the positives and one for all documents."""
    k = len(theta) // 2
    # The weights are one constant of the plan, as text that the planner folds. The driver keeps the text of every step's
    # plan, so it holds two weights a feature, and not one for each of its levels.
    weight = F.split(F.lit(",".join(map(repr, theta.tolist()))), ",").cast("array<double>")
    cell, one, loss = F.col("cell"), k * LEVELS, k * LEVELS + 1
    of = lambda c: F.get(weight, F.floor(c / LEVELS).cast("int")) + F.get(weight, (k + F.floor(c / LEVELS)).cast("int")) * ((c % LEVELS + 1) / F.lit(float(LEVELS)))
    g = F.aggregate("cells", F.lit(float(theta[-1])), lambda z, c: z + of(c))
    g = F.least(F.greatest(g, F.lit(-30.0)), F.lit(30.0))
    whole = lambda c: F.rint(UNIT * c).cast("long")
    told = rows.select("cells", "p", "u", g.alias("g")).select("p", "u", whole(F.log1p(F.exp("g"))).alias("loss"), whole(1 / (1 + F.exp(-F.col("g")))).alias("share"),
                                                              F.explode(F.concat("cells", F.array(F.lit(one), F.lit(loss)))).alias("cell"))
    value = F.when(cell == loss, F.col("loss")).otherwise(F.col("share"))
    out = np.zeros((2, len(theta) + 1))
    # At most one row for each cell of the model.
    for r in sorted(told.groupBy("cell").agg(F.sum(F.col("p") * value).alias("p"), F.sum(F.col("u") * value).alias("u")).collect()):
        line = np.array([r["p"], r["u"]]) / UNIT
        if r["cell"] >= one:
            out[:, -1 if r["cell"] == one else 0] = line
        else:
            out[:, 1 + r["cell"] // LEVELS] += line
            out[:, 1 + k + r["cell"] // LEVELS] += line * (r["cell"] % LEVELS + 1) / LEVELS
    return out


def means(rows: DataFrame, k: int) -> tuple[int, int, np.ndarray]:
    """(positives, documents, mean x of the positives) of ``rows`` (cells, p, u)."""
    size = rows.agg(F.sum("p").alias("p"), F.sum("u").alias("u")).first()
    # σ(0) is one half.
    return size["p"], size["u"], 2 * sums(rows, np.zeros(2 * k + 1))[0, 1:] / size["p"]


def risk(rows: DataFrame, theta: np.ndarray, prior: float, n_p: int, n_u: int, mean_p: np.ndarray) -> tuple[float, np.ndarray]:
    """(non-negative risk, its gradient, reversed where the bracket is negative) over all ``rows``."""
    p, u = sums(rows, theta) / np.array([[n_p], [n_u]])
    bracket = u[0] - prior * p[0]
    # ℓ(g, +1) = ℓ(g, −1) − g
    of_p, d_p, d_bracket = p[0] - mean_p @ theta, p[1:] - mean_p, u[1:] - prior * p[1:]
    return prior * of_p + max(0.0, bracket), prior * d_p + d_bracket if bracket >= 0 else -d_bracket


def nnpu(rows: DataFrame, k: int, prior: float, steps: int = STEPS, length: float = LENGTH, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """(weights, bias) of ``k`` features: ``steps`` of Adam, ever shorter, each over all ``rows``; those with the least risk."""
    n_p, n_u, mean_p = means(rows, k)
    theta = np.zeros(2 * k + 1)
    theta[-1] = np.log(prior / (1 - prior))
    m, v, best, least = np.zeros_like(theta), np.zeros_like(theta), theta, np.inf
    for t in range(1, steps + 1):
        value, grad = risk(rows, theta, prior, n_p, n_u, mean_p)
        value += decay / 2 * float(theta[:-1] @ theta[:-1])
        if value < least:
            best, least = theta, value
        grad = grad + decay * np.append(theta[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        now = length * (1 + np.cos(np.pi * (t - 1) / steps)) / 2
        theta = theta - now * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return best[:-1], float(best[-1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); both hold training rows only."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).where(F.col("doc_id").isNotNull())
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    told = known.agg(F.avg((F.col("toxic") > 0).cast("double")).alias("rate"), F.count_if(F.col("toxic") > 0).alias("n")).first()
    if not told["rate"]:
        return Model([], np.zeros(0), -30.0)
    prior = min(max(told["rate"], 1e-3), 0.9)

    positives = broadcast_if_small(known_rows(known.where("toxic > 0").select("doc_id", F.lit(True).alias("positive")), told["n"]))
    marked = docs.join(positives, "doc_id", "left").withColumn("positive", F.col("positive").isNotNull())
    size = marked.agg(F.count_if("positive").alias("p"), F.count(F.lit(1)).alias("u")).first()
    if not size["p"]:
        return Model([], np.zeros(0), float(np.log(prior / (1 - prior))))
    names = chosen(_count(marked), size["p"], size["u"], prior)
    rows = written(cell_rows(marked, {f: i for i, f in enumerate(names)}), "cells")
    weights, bias = nnpu(rows, len(names), prior)
    drop_written(rows)
    return Model(names, weights, bias)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability that the whole text is toxic."""
    number, theta = {f: i for i, f in enumerate(model.names)}, np.append(model.weights, model.bias)

    def make(texts: pa.Array) -> list[pa.Array]:
        found = [cells(t, number) for t in text_bytes(texts)]
        z = margins(np.array([c for f in found for c in f], np.int64), np.repeat(np.arange(len(found)), [len(f) for f in found]), len(found), theta)
        return [pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())]

    return append_columns(docs, text_col, [T.StructField(out, T.DoubleType())], make)


def held_out():
    """One document in five, by checksum of its id, is kept from all learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def fit_on_training_rows(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(docs.where(~held_out()), labels.where(~held_out()))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document; learned from the labels of the rows that are not held out."""
    scored = score(docs.select("doc_id", "text"), fit_on_training_rows(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
