import math
import re
from collections import Counter

import numpy as np
import pytest

from seisflow.llm import lexical

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, top=50):
    """Every document scored for every item."""
    terms = lambda t: PATTERN.findall((t or "").translate(FOLD))
    bags = [(i, Counter(w := terms(t)), len(w)) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for _, _, n in bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for doc, bag, n in bags:
            score = 0
            for t in set(terms(text)) & bag.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * (50 + (50 * n * n_docs) // n_terms)))
            if score > 0:
                scored.append((-score, doc is not None, doc or 0))
        out += [(item, k + 1, d if there else None, -s) for k, (s, there, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed, n=400):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "日本", "ABC", "x1"]
    weight = 1 / np.arange(1, len(words) + 1)
    texts = [" ".join(rng.choice(words, rng.integers(0, 40), p=weight / weight.sum())) for _ in range(n)]
    docs = [(int(i), texts[int(rng.integers(n // 2)) if rng.random() < 0.4 else k]) for k, i in enumerate(rng.permutation(n))]
    return docs, [(k, ", ".join(rng.choice(words, rng.integers(1, 9)))) for k in range(25)]


@pytest.mark.parametrize("cluster,top", [(128, 50), (4, 3), (1, 1)])
def test_search_equals_scoring_everything(spark, frame, monkeypatch, cluster, top):
    docs, items = corpus(cluster)
    monkeypatch.setattr(lexical.cluster_blocks, "__defaults__", (cluster,))
    got = lexical.search(frame(docs), frame(items, "item_id long, text string"), top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(got) == plain(docs, items, top)


def test_blocks_are_skipped_by_bounds_that_hold(spark, frame):
    """No document beats its block's bound, and with small blocks most need not be scored."""
    docs, items = corpus(5, 1500)
    queries = lexical.Queries([t.encode() for _, t in items])
    postings = lexical.frequencies(frame(docs), queries.vocabulary)
    w, n, total = lexical.weights(postings, len(queries.vocabulary))
    blocks = lexical.cluster_blocks(lexical.impacts(postings, w, n, total), 8).collect()
    skipped = seen = 0
    best = {(i, d): s for i, _, d, s in plain(docs, items, len(docs))}
    least = {i: sorted([s for (j, _), s in best.items() if j == i])[-10] for i, _ in items}
    for b in blocks:
        peak = dict(zip(b.terms, b.summary))
        for q, (item, _) in enumerate(items):
            bound = sum(peak.get(int(t), 0) * int(w[t]) for t in queries.terms[q])
            assert all(best.get((item, d), 0) <= bound for d in b.docs)
            seen += 1
            skipped += bound < least[item]
    assert sum(len(b.docs) for b in blocks) == len({d for _, d in best} | {d for b in blocks for d in b.docs})
    assert skipped > seen / 4


def test_queries_in_several_blocks(spark, frame, monkeypatch):
    docs, items = corpus(2, 150)
    monkeypatch.setattr(lexical.query_blocks, "__defaults__", (60,))
    assert rows(lexical.search(frame(docs), frame(items, "item_id long, text string"))) == plain(docs, items)


def test_odd_rows(spark, odd, frame):
    docs = [tuple(r)[:2] for r in odd.collect()]
    items = [(1, "A word"), (1, "A word"), (None, "text 日本語"), (2, None), (3, " .,"), (4, "é x"), (5, "missing")]
    table = frame([(*r, "x") for r in items], "item_id long, text string, score string")
    assert rows(lexical.search(odd, table)) == plain(docs, items)
    assert lexical.search(odd, table.limit(0)).count() == 0
    assert lexical.search(odd.limit(0), table).count() == 0


def test_whole_table(spark, docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows(lexical.search(docs, items)) == want
