"""A corpus pipeline of the operators in ladderlake.llm: each stage works on what its predecessor wrote.

1. language ID: documents without a language, or with a spread of languages none of which has 0.35 of the words, go.
2. n-gram Jaccard join: of each class of near copies, the document of smallest id stays.
3. benchmark decontamination: documents that hold a copy of a test item, edited or not, go.
4. mixing: documents are sampled to target weights of sources, languages and topics (0.9 of the tokens are expected to stay, or as many as the targets allow).
5. sharding: every document left gets a shard and a place in it, and keeps its columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ladderlake.llm import decontamination, jaccard_join, language_id, mixing, sharding
from ladderlake.llm._scratch import delete, shared_dir, temporary


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted(docs, language_id.train(docs))


def join_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs, mixing.TARGETS, keep_share=0.9, exact=True)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs, carry=True)


STAGES = [("language_id", identify), ("ngram_jaccard_join", join_near), ("benchmark_decontamination", decontaminate), ("mixing", mix), ("sharding", shard)]
#: Learned models, whole-set comparisons and alignments are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        with temporary(spark):  # what a stage writes on its way goes when its result is there
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        if before:
            delete(spark, before)
        before = f"{folder}/{name}"
        docs = spark.read.parquet(before)
    return docs
