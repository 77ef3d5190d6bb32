"""A training corpus from ``documents`` in five stages, each written and reread.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns
what it keeps. All but the last return the columns of ``documents``; the last gives
doc_id, n_tokens, ids_sha256 and decoded_sha256 of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bookpipe.llm import bpe, decontaminate, language_id, minhash, quality
from bookpipe.llm.common import shared_path, table
from bookpipe.llm.queries import PATTERN, RANKS


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted(docs)


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(docs, RANKS, PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("quality", judge_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("byte_bpe", encode_tokens),
]

#: The language model, the quality model and BPE are beyond SQL; tests compare stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
