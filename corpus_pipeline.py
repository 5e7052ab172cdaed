"""A training corpus from ``documents``: five stages, each written and read again as the next one's input.

quality: documents that the classifier rejects go; near_duplicates: one
document of each group stays; secrets: found spans are replaced by a mark;
mixing: each document as many times as the mix of sources takes it; packing:
one row a piece of a sequence.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spotweave.llm.common import written
from spotweave.llm.mixing import mixed_documents
from spotweave.llm.ngram_join import one_of_each
from spotweave.llm.packing import pack_documents
from spotweave.llm.quality import keep_good
from spotweave.llm.secrets import redact


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

#: Model fitting, connected components and tokenisation are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
