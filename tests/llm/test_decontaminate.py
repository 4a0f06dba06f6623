import random

import numpy as np
from pyspark.sql import functions as F

from seisflow.llm import decontaminate as d


def plain_alignment(window, item):
    h = [[0] * (len(window) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(window) + 1):
            same = d.MATCH if item[i - 1] == window[j - 1] else d.MISMATCH
            h[i][j] = max(0, h[i - 1][j - 1] + same, h[i - 1][j] - d.GAP, h[i][j - 1] - d.GAP)
    return max(map(max, h))


def test_alignment_equals_the_plain_recurrence():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 25))] for _ in range(2))
        assert d.align(np.array(a), np.array(b))[0] == plain_alignment(a, b)


def edited(words, rate, rng):
    out = []
    for w in words:
        u = rng.random()
        out += [] if rate * .5 <= u < rate * .75 else ["zzq"] if u < rate * .5 else [w, "insx"] if u < rate else [w]
    return out


def test_planted_copies_are_found_and_clean_rows_are_not(spark, docs):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    rng = random.Random(3)
    base = [r.text for r in docs.orderBy("doc_id").limit(40).collect()]
    rows = []
    for k, it in enumerate(items.orderBy("item_id").collect()):
        w, b = it.text.split(), base[k].split()
        rows.append((k, it.item_id, " ".join(b[:len(b) // 2] + edited(w, [0, .1, .2, .25][k % 4], rng) + b[len(b) // 2:])))
    made = d.find_leaks(spark.createDataFrame(rows, "doc_id long, item long, text string"), items)
    assert made.where(F.exists("leaks", lambda x: x["item_id"] == F.col("item"))).count() == len(rows)
    # All pairs, aligned in full: the seeds lose none.
    got = {(r.doc_id, r.item_id) for r in d.leak_rows(docs, items).collect()}
    want, texts = set(), {r.doc_id: d.words_of(r.text.encode()) for r in docs.collect()}
    for it in items.collect():
        words = d.words_of(it.text.encode())
        code = {w: i for i, w in enumerate(dict.fromkeys(words))}
        for doc, t in texts.items():
            if len(code.keys() & set(t)) * 3 >= len(code):
                score, _ = d.align(np.array([code.get(w, -1) for w in t]), np.array([code[w] for w in words]))
                if score >= d.LEAST_SCORE * d.MATCH * len(words):
                    want.add((doc, it.item_id))
    assert got == want


def test_blocks_and_odd_rows(spark, frame, odd, docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one, many = (sorted((r.doc_id, sorted(x.item_id for x in r.leaks)) for r in d.find_leaks(docs, items, block_bytes=b).where("size(leaks) > 0").collect()) for b in (1 << 20, 3000))
    assert one == many
    none = spark.createDataFrame([], "item_id long, text string")
    few = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (None, "word word word word"), (5, "x y z"), (5, "x y z")], "item_id long, text string")
    assert d.find_leaks(odd, none).where("size(leaks) = 0").count() == odd.count()
    found = d.find_leaks(odd, few, out="spans").where("size(spans) > 0").collect()
    # "a", a zero byte, "b" are the two words of item 3.
    assert sorted(([x.item_id for x in r.spans] for r in found), key=str) == [[3], [None]]
    assert d.drop_leaks(odd, few).columns == odd.columns and d.drop_leaks(odd, few).count() == odd.count() - 2
    assert d.leak_rows(frame([]), items).count() == 0
    assert [len(r.leaks) for r in d.find_leaks(frame([(1, "q x y z q")]), few).collect()] == [2]


def spread(words, every, rng, how):
    """Every so many-th word edited, from a random place on."""
    out, shift = [], rng.randrange(every)
    for i, w in enumerate(words):
        if i % every == shift:
            out += {"change": [f"q{rng.randrange(10**6)}"], "drop": [], "insert": [w, f"q{rng.randrange(10**6)}"]}[how]
        else:
            out.append(w)
    return out


def test_no_copy_that_reaches_the_score_is_lost(spark, docs):
    """Every copy, however its edits lie, that the plain recurrence scores at the threshold or over: all are found."""
    rng = random.Random(8)
    pool = sorted({w.decode() for r in docs.limit(30).collect() for w in d.words_of(r.text.encode())})
    common = pool[:12]
    items = [" ".join(rng.choice(common if k % 3 == 0 else pool) for _ in range(rng.choice([3, 4, 5, 9, 15, 24, 40]))) for k in range(60)]
    rows, want = [], set()
    for k, text in enumerate(items):
        w = text.split()
        for every in (1, 2, 3, 4, 5):
            for how in ("change", "drop", "insert"):
                body = spread(w, every, rng, how)
                around = [rng.choice(pool) for _ in range(60)]
                rows.append((len(rows), " ".join(around[:30] + body + around[30:])))
    texts = [[x.decode() for x in d.words_of(t.encode())] for _, t in rows]
    for k, text in enumerate(items):
        w = text.split()
        code = {x: i for i, x in enumerate(dict.fromkeys(w))}
        for i, t in enumerate(texts):
            score, _ = d.align(np.array([code.get(x, -1) for x in t]), np.array([code[x] for x in w]))
            if score >= d.LEAST_SCORE * d.MATCH * len(w):
                want.add((i, k))
    third = {(15 * k + 6, k) for k, t in enumerate(items) if len(t.split()) % 3 == 0}
    assert third <= want and len(third) > 20
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.leak_rows(spark.createDataFrame(rows, "doc_id long, text string"), table).collect()}
    assert got == want


def test_alignment_of_candidates_equals_the_plain_recurrence(spark, docs):
    """Scores of the leaks found, against the plain recurrence over the whole document."""
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    words = {r.item_id: d.words_of(r.text.encode()) for r in items.collect()}
    texts = {r.doc_id: d.words_of(r.text.encode()) for r in docs.collect()}
    rows = d.leak_rows(docs, items).limit(12).collect()
    assert rows
    for r in rows:
        assert round(plain_alignment(texts[r.doc_id], words[r.item_id]) / (d.MATCH * len(words[r.item_id])), 6) == r.score


def test_short_items_and_scripts_without_blanks(frame, spark):
    items = spark.createDataFrame([(1, "Ja"), (2, "new york"), (3, "東京は日本の首都です"), (4, "กรุงเทพ"), (5, "...")], "item_id long, text string")
    rows = [(1, "they said ja."), (2, "in New-York now"), (3, "new in york"), (4, "以前、東京は日本の首都です。"), (5, "東京は、日本国の首都でした"), (6, "jab"), (7, "ไป กรุงเทพ วันนี้"), (8, "大阪")]
    got = {(r.doc_id, r.item_id) for r in d.leak_rows(frame(rows), items).collect()}
    assert got == {(1, 1), (2, 2), (4, 3), (5, 3), (7, 4)}


def test_blocks_are_written_one_by_one(frame, spark, monkeypatch):
    seen, kept = [], d.written
    monkeypatch.setattr(d, "written", lambda df, name: seen.append(name) or kept(df, name))
    items = spark.createDataFrame([(k, f"alpha{k} beta gamma delta{k} epsilon") for k in range(5)], "item_id long, text string")
    docs = frame([(k, f"x alpha{k} beta gamma delta{k} epsilon y") for k in range(5)] + [(9, None)])
    one = sorted(map(tuple, d.leak_rows(docs, items).collect()))
    assert not seen
    found = d.find_leaks(docs, items, block_bytes=60)
    assert seen == ["leaks"] * 4
    assert sorted((r.doc_id, x.item_id) for r in found.collect() for x in r.leaks) == [r[:2] for r in one]
