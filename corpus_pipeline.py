"""Corpus pipeline: toxicity, near-duplicates, benchmark leaks, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from seisflow.llm import bpe, decontaminate, secrets, simhash, toxicity
from seisflow.llm.common import drop_written, written
from seisflow.llm.queries import table, tokenizer_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half stay; the model is learned from the labels of rows that are not held out."""
    model = toxicity.fit_on_training_rows(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, out="__score")
    return scored.where("__score < 0.5").select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints stays."""
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also an edited one, go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` follows the text."""
    clean = secrets.redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, and the digest of the text decoded from them."""
    return bpe.token_digests(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_duplicates_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secrets_stage),
    ("bpe_tokens", tokens_stage),
]

#: No SQL can express the learned and hashed stages; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each result is written and read again before the next.

    A stage's table is deleted once the next one's is written; the last one is read by the result.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            drop_written(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
