"""A training corpus from raw documents, stage by stage; each stage works on all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import decontaminate, mixing, nearcopies, tokens, toxicity
from plumbline.session import cut


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, Jaccard 0.8 or more) the smallest doc_id stays."""
    return nearcopies.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources at their target weights."""
    return mixing.mix(docs)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written in document order, and what reading them back gives: doc_id, start, n_tokens, ids_crc32."""
    return tokens.token_digest(docs, tokens.vocabulary_path())


STAGES = [("toxicity", reject_toxic), ("near_duplicates", one_of_each_group), ("decontaminate", without_benchmark), ("mixing", mixed), ("tokens", as_tokens)]

#: Learned scores, near copies, hashed draws and byte-pair merges have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs, f"pipeline-{name}")
    return docs
