"""A corpus pipeline of five stages over `documents`; each stage works on all that the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import bpe, jaccard_join, mixing, quality_rules, suffix_dedup
from tagloom.llm.common import shared_folder
from tagloom.llm.queries import tokenizer_path

#: SQL cannot express the learnt cutoffs; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest id stays; rows without an id come after all others."""
    return jaccard_join.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that also start earlier are cut out; n_chars follows the text."""
    cut = suffix_dedup.dedup_documents(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of the ids and of their decoding."""
    return bpe.bpe_round_trip(docs, tokenizer_path()).drop("decoded")


STAGES = [("quality rules", filter_quality), ("n-gram Jaccard join", drop_near_duplicates), ("suffix-array dedup", cut_repeats), ("mixing sources", mix_sources), ("BPE encoding", encode)]


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages over documents; what a stage returns is written to the shared folder and read again.

    A stage's output goes once the next one's is written. A run in a named folder that has ended early goes on after its
    last finished stage.
    """
    folder = folder or f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    done = max((k for k in range(len(STAGES)) if files.exists(at(f"{folder}/{k}/_SUCCESS"))), default=-1)
    docs = spark.read.parquet(f"{folder}/{done}" if done >= 0 else f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        if k > done:
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            files.delete(at(f"{folder}/{k - 1}"), True)
    return docs
