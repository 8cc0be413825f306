"""Registered queries of the training-data operators: key -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.nn_descent import near_vectors

    return near_vectors(_read(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.jaccard_join import jaccard_groups

    return jaccard_groups(_read(spark, sf_dir, "documents"), k=3, percent=90)


def op3_lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.sharding import shard

    return shard(_read(spark, sf_dir, "documents"), shards=40)


def op4_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.mixing import mix

    return mix(_read(spark, sf_dir, "documents"))


def op5_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.pii import personal_data

    return personal_data(_read(spark, sf_dir, "documents"))


def op6_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.decontam import contaminated

    return contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.hpylm import model_scores

    return model_scores(_read(spark, sf_dir, "documents"))


def op8_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.licences import licences

    return licences(_read(spark, sf_dir, "documents"))


def op9_bigru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.langid import languages

    return languages(_read(spark, sf_dir, "documents"))


def op10_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.quality import quality_scores

    return quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op11_document_fp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.fp_search import ranked

    return ranked(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), k=10)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.prefix_trie import prefix_trie

    return prefix_trie(_read(spark, sf_dir, "conversations"))


def op13_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from trolley.llm.bpe import encoded_digests

    return encoded_digests(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_nn_descent, op2_jaccard_join, op3_lpt_sharding, op4_pfair_mixing, op5_pii_anchors, op6_bm25_decontamination, op7_pitman_yor, op8_licence_rules, op9_bigru_language, op10_compression_quality, op11_document_fp_tree, op12_prefix_trie, op13_merge_rounds)}


def oracle_sql() -> dict[str, str]:
    from trolley.llm import oracles
    from trolley.llm.licences import oracle as licence_sql

    return {"op1_nn_descent": oracles.VECTORS, "op2_jaccard_join": oracles.JACCARD, "op8_licence_rules": licence_sql(), "op11_document_fp_tree": oracles.RANKED,
            "op12_prefix_trie": oracles.TRIE}
