import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from seisflow.llm import bpe, decontaminate, secrets, simhash, toxicity
from seisflow.llm.queries import table, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def done(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append((name, docs))
    return out


def test_stages_decide_row_by_row(spark, done):
    """Each stage against a plain loop over the rows its predecessor kept."""
    before = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    columns = table(spark, SF, "documents").columns
    assert all(d.columns == columns for _, d in done[:-1])
    tox, near, clean, safe, tokens = ({r.doc_id: r for r in d.collect()} for _, d in done)

    model = toxicity.fit_on_training_rows(table(spark, SF, "documents"), table(spark, SF, "labels"))
    score = {r.doc_id: r.score for r in toxicity.score(table(spark, SF, "documents"), model).collect()}
    assert set(tox) == {i for i in before if score[i] < 0.5}

    prints = {i: simhash.fingerprint((r.text or "").encode()) for i, r in tox.items()}
    left, roots = sorted(prints), set()
    while left:
        group, front = set(), [left.pop(0)]
        while front:
            i = front.pop()
            group.add(i)
            close = [j for j in left if bin(prints[i] ^ prints[j]).count("1") <= 3]
            left = [j for j in left if j not in close]
            front += close
        roots.add(min(group))
    assert set(near) == roots

    leaks = {r.doc_id for r in decontaminate.leak_rows(table(spark, SF, "documents"), table(spark, SF, "benchmark")).collect()}
    assert set(clean) == set(near) - leaks
    assert set(safe) == set(clean)
    for i, r in safe.items():
        assert r.n_chars == len(r.text) and ("[SECRET]" in r.text) == (r.text != clean[i].text)
    again = spark.createDataFrame([(i, r.text) for i, r in safe.items()], "doc_id long, text string")
    assert secrets.secret_digests(again).where("spans <> ''").count() == 0
    want = {r.doc_id: r for r in bpe.token_digests(again, tokenizer_path()).collect()}
    assert tokens == want


def test_run_equals_the_stages(spark, done):
    rows = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, done[-1][1].collect()))


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_null_columns_pass_through(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "plain text here", None, None, None)], table(spark, SF, "documents").schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert {r.doc_id for r in docs.collect()} == {None, 1}
