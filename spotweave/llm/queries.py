"""The contract queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spotweave.llm.quality import score_documents

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spotweave.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spotweave.llm.ngram_join import ngram_jaccard_join

    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op5_shard_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spotweave.llm.sharding import shard_by_bytes

    return shard_by_bytes(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spotweave.llm.secrets import find_secrets

    return find_secrets(table(spark, sf_dir, "documents"))


def op9_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spotweave.llm.warc import archive_and_index

    return archive_and_index(table(spark, sf_dir, "pages"))


def op10_pack_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spotweave.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


def op4_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spotweave.llm.nearest import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op6_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spotweave.llm.token_counts import section_tokens

    return section_tokens(table(spark, sf_dir, "documents"))


def op8_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spotweave.llm.topk import top_products

    return top_products(table(spark, sf_dir, "embeddings"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spotweave.llm.fill_in_middle import digests

    return digests(table(spark, sf_dir, "documents"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spotweave.llm.personal_data import find_personal_data

    return find_personal_data(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spotweave.llm.periodic_runs import run_digests

    return run_digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in sorted(globals().items()) if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from spotweave.llm.oracles import all_sql

    return all_sql()
