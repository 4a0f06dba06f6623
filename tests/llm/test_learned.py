import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seisflow.llm import langid, toxicity

SF = "/root/testdata/sf0.1"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.language_predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97
    assert got.where("score < 0 or score > 1").count() == 0


def test_mixtures_are_recovered(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    long = {r.lang: r.text[:3000] for r in docs.where("length(text) > 3000 and text not like '%$$$%'").collect()}
    rows = [(1, long["en"][:1000] + long["de"][:3000]), (2, long["fr"]), (3, long["es"] + " " + long["fr"])]
    got = {r.doc_id: r.lang_mix for r in langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert abs(got[1]["en"] - 0.25) < 0.1 and abs(got[1]["de"] - 0.75) < 0.1
    assert got[2].get("fr", 0) > 0.9 and min(got[3]["es"], got[3]["fr"]) > 0.3


def test_mixture_likelihood_is_the_best_on_a_grid():
    rng = np.random.default_rng(0)
    p = rng.dirichlet(np.ones(40), 2).T
    c = rng.integers(1, 9, 40).astype(float)
    pi, like = langid.mixtures(np.zeros(40, np.int64), c, p, 500, np.full((1, 2), 0.5))
    grid = max(float((c * np.log(p @ [a, 1 - a])).sum()) for a in np.linspace(0, 1, 1001))
    assert abs(like[0] - grid) < 1e-2 and abs(pi.sum() - 1) < 1e-9


def test_language_odd_rows(frame, odd, spark):
    model = langid.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(odd, model).collect()}
    assert got[0] == got[1] == got[2] == got[8] == ("und", 0.0) and got[3][0] != "und"
    assert {r.lang_pred for r in langid.predict(frame([(1, "12 34 €€"), (2, "abc")]), langid.fit(frame([], "text string, lang string"))).collect()} == {"und"}
    empty = frame([], "doc_id long, text string, lang string")
    assert langid.language_predictions(empty).count() == 0


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity_scores(docs, labels)
    assert got.count() == docs.count()
    rows = got.where("held_out").join(labels, "doc_id").select("toxic", "predicted", "score").collect()
    hit = sum(r.predicted for r in rows if r.toxic) / sum(1 for r in rows if r.toxic)
    wrong = sum(r.predicted for r in rows if not r.toxic) / sum(1 for r in rows if not r.toxic)
    assert hit > 0.85 and wrong < 0.02


def test_toxicity_counts_all_positives(frame, spark):
    """Each of 100 words is in 12 of 1200 positives: too few for a share of them, and for a sample."""
    words = ["".join(chr(97 + i // k % 10) for k in (1, 10)) * 2 + "q" for i in range(100)]
    rows = [(i, f"plain text {words[i % 100]}" if i < 1200 else "plain text") for i in range(6000)]
    labels = spark.createDataFrame([(i, 0, int(i < 1200)) for i in range(6000)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame(rows), labels)
    assert {f.strip() for f in model.names} >= {w.encode() for w in words}
    assert toxicity.fit(frame(rows + rows[:1200] * 3, parts=5), labels).names == model.names
    assert toxicity.fit(frame(rows, parts=7), labels).bias == model.bias


def plain_matrix(texts, names):
    """Presence, rate in whole steps and a one, straight from the words."""
    x = np.zeros((len(texts), 2 * len(names) + 1))
    x[:, -1] = 1
    for i, text in enumerate(texts):
        words = re.findall("[a-z0-9\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        for j, name in enumerate(names):
            n = sum(w.encode() + b" " == name or (len(w.encode()) > len(name) and len(name) in toxicity.OPENINGS and w.encode().startswith(name)) for w in words)
            if n:
                x[i, j], x[i, len(names) + j] = 1, min(toxicity.LEVELS, math.ceil(n * toxicity.RATE * toxicity.LEVELS / len(words))) / toxicity.LEVELS
    return x


def test_toxicity_counts_and_choice_of_features(frame, spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"{chr(97 + i % 7)}{chr(97 + i // 7)}{'xyz'[i % 3]}w" for i in range(40)] + ["é€ö"]
    rows = [(i, " ".join([*rng.choice(vocabulary, 12), *(["vileness" if i % 2 else "Vile"] if i % 9 == 0 else [])])) for i in range(600)]
    rows += [(600, None), (601, "")]
    positive = {i for i in range(600) if i % 9 == 0}
    marked = frame(rows).withColumn("positive", F.col("doc_id").isin(list(positive)))
    plain_p, plain_u = Counter(), Counter()
    for i, text in rows:
        words = {w.lower().encode() for w in (text or "").split()}
        found = {w + b" " for w in words} | {w[:k] for w in words for k in toxicity.OPENINGS if len(w) > k}
        plain_u.update(found)
        plain_p.update(found if i in positive else ())
    got = {bytes(r.feature): (r.p, r.u) for r in toxicity._count(marked).collect()}
    assert got == {f: (plain_p[f], n) for f, n in plain_u.items()}

    n_p, n_u, prior = len(positive), len(rows), 0.2
    want = []
    for f, u in plain_u.items():
        p = plain_p[f]
        a, b = p / n_p, u / n_u
        longer = [plain_p[g] for g in plain_u if g != f and f in [g[:k] for k in toxicity.OPENINGS] and plain_p[g] > toxicity.LEAST_EXCESS]
        if p > toxicity.LEAST_EXCESS and not any(q >= 0.9 * p for q in longer) and prior * a >= toxicity.LEAST_SHARE * b and n_p * (a - b) / math.sqrt(n_p * b + 1) >= toxicity.LEAST_EXCESS:
            want.append(f)
    assert toxicity.chosen(toxicity._count(marked), n_p, n_u, prior) == sorted(want) and b"vileness " in want


def test_toxicity_features_are_not_limited(frame, spark):
    words = ["".join(chr(97 + i // k % 10) for k in (1, 10, 100)) * 2 + "q" for i in range(600)]
    rows = [(i, f"plain text {words[i % 600]}" if i < 7200 else "plain text") for i in range(36000)]
    labels = spark.createDataFrame([(i, 0, int(i < 7200)) for i in range(36000)], "doc_id long, quality int, toxic int")
    assert {f.strip() for f in toxicity.fit(frame(rows, parts=8), labels).names} >= {w.encode() for w in words}


def test_risk_and_gradient_of_all_rows(frame, monkeypatch):
    """Against the definition of the risk on a dense matrix, on both sides of zero; no matter how rows are dealt."""
    rng = np.random.default_rng(2)
    names = [b"bad ", b"wor", b"\xc3\xa9t\xc3\xa9 "]
    texts = [" ".join(rng.choice(["bad", "Worse", "été", "wor", "plain", "text", "x"], rng.integers(1, 90))) for _ in range(300)] + ["", None, "plain"] * 20
    positive = [bool(t) and ("bad" in t) and i % 2 == 0 for i, t in enumerate(texts)]
    docs = frame([(t, p) for t, p in zip(texts, positive)], "text string, positive boolean", parts=4)
    number = {f: i for i, f in enumerate(names)}
    rows = toxicity.cell_rows(docs, number)
    x, of = plain_matrix(texts, names), np.array(positive)
    assert rows.agg(F.sum("u"), F.sum("p")).first()[:] == (len(texts), of.sum())
    monkeypatch.setattr(toxicity, "HELD_CELLS", 300)
    again = toxicity.cell_rows(docs.repartition(7), number)
    assert sorted((r.cells, r.p, r.u) for r in rows.collect()) == sorted((r.cells, r.p, r.u) for r in again.collect())

    n_p, n_u, mean_p = toxicity.means(rows, len(names))
    assert (n_p, n_u) == (of.sum(), len(texts)) and np.allclose(mean_p, x[of].mean(0), atol=1e-5)
    log_loss, sides = (lambda z, sign: np.log1p(np.exp(-sign * z))), set()
    thetas = [np.zeros(7), rng.normal(size=7), np.array([3, 1, 0, 2, 1, 0, -2.0]), np.array([-4, -4, -4, 0, 0, 0, 4.0]), np.array([6, 0, -6, 6, 0, -6, -1.0])]
    for prior, theta in [(q, w) for q in (0.3, 0.9) for w in thetas]:
        def parts(w):
            g = x @ w
            return prior * log_loss(g[of], 1).mean(), log_loss(g, -1).mean() - prior * log_loss(g[of], -1).mean()
        first, bracket = parts(theta)
        value, grad = toxicity.risk(rows, theta, prior, n_p, n_u, mean_p)
        assert abs(value - first - max(0, bracket)) < 1e-4
        steps = np.eye(7) * 1e-5
        slope = np.array([(sum(parts(theta + s)) - sum(parts(theta - s))) / 2e-5 if bracket >= 0 else -(parts(theta + s)[1] - parts(theta - s)[1]) / 2e-5 for s in steps])
        assert np.allclose(grad, slope, atol=1e-4)
        assert np.array_equal(grad, toxicity.risk(again, theta, prior, n_p, n_u, mean_p)[1])
        sides.add(bracket >= 0)
    assert sides == {True, False}


def test_non_negative_risk_keeps_unlabelled_positives_apart(frame):
    """One toxic document in three is labelled; the others are found among the unlabelled."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(4000):
        toxic = i % 10 < 3
        rows.append((" ".join([*rng.choice(["bad", "ugly", "vile"], 2 if toxic else 0), *rng.choice(["plain", "text", "bad"], 8, p=[0.495, 0.495, 0.01])]), toxic and i % 3 == 0, toxic))
    docs = frame(rows, "text string, positive boolean, toxic boolean")
    names = [b"bad ", b"ugly ", b"vile "]
    weights, bias = toxicity.nnpu(toxicity.cell_rows(docs, {f: i for i, f in enumerate(names)}).cache(), 3, 0.3)
    got = toxicity.score(docs, toxicity.Model(names, weights, bias)).agg(F.avg((F.col("toxic") == (F.col("score") >= 0.5)).cast("double"))).first()[0]
    assert got > 0.9


def test_toxicity_odd_rows(frame, odd, spark):
    labels = "doc_id long, quality int, toxic int"
    none = toxicity.toxicity_scores(odd, spark.createDataFrame([], labels))
    assert none.count() == odd.count() and none.where("score > 0.01").count() == 0
    some = spark.createDataFrame([(1, 0, None), (None, 0, 1), (2, 1, 1), (2, 0, 0), (3, 0, 0)], labels)
    assert toxicity.toxicity_scores(odd, some).where("score between 0 and 1").count() == odd.count()
    assert toxicity.toxicity_scores(frame([]), some).count() == 0


def test_plans_of_the_fit_hold_two_weights_a_feature(spark, monkeypatch):
    """The driver keeps the text of every step's plan; the sums are those of the margins."""
    k, texts, split = 40, [], toxicity.F.split
    monkeypatch.setattr(toxicity.F, "split", lambda c, *a: texts.append(str(c)) or split(c, *a))
    theta = np.random.default_rng(2).normal(0, 1, 2 * k + 1)
    rows = [([], 1, 2), ([0, 17, 39 * 16 + 15], 0, 3), ([5 * 16 + 7], 2, 2)]
    got = toxicity.sums(spark.createDataFrame(rows, "cells array<int>, p long, u long"), theta)
    flat, row = np.array([c for r in rows for c in r[0]]), np.repeat(np.arange(3), [len(r[0]) for r in rows])
    loss = np.log1p(np.exp(toxicity.margins(flat, row, 3, theta)))
    assert got[:, 0] == pytest.approx([loss @ [1, 0, 2], loss @ [2, 3, 2]], abs=1e-4)
    assert max(map(len, texts)) < 25 * len(theta) + 200
