"""The registered queries of the corpus operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from seisflow.llm import (bpe, chat, decontaminate, langid, lexical, licenses, lzprint, prefixtrie, secrets, sharding, simhash, suffixdedup,
                          toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register("op1_license_scan", licenses.oracle())
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_rows(table(spark, sf_dir, "documents"))


@register("op2_benchmark_leaks")
def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op3_bpe_tokens")
def op3_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


@register("op4_lz_fingerprints")
def op4_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lzprint.compare_with_successor(table(spark, sf_dir, "documents"))


@register("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(table(spark, sf_dir, "documents"))


@register("op6_simhash_near_duplicates")
def op6_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_classes(table(spark, sf_dir, "documents"))


@register("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.repeat_digests(table(spark, sf_dir, "documents"))


@register("op8_chat_windows", chat.oracle())
def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digests(table(spark, sf_dir, "conversations"))


@register("op9_language_mixture")
def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_predictions(table(spark, sf_dir, "documents"))


@register("op10_toxicity_nnpu")
def op10_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op11_hash_tree_shards", sharding.oracle())
def op11_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digests(table(spark, sf_dir, "documents"))


@register("op12_prefix_trie", prefixtrie.oracle())
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie_rows(table(spark, sf_dir, "conversations"))


@register("op13_ranked_search", lexical.oracle())
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
