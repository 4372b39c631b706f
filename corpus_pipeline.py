"""A training corpus in five stages: languages, repeated lines, near copies, mixing, token ids.

Every stage takes (spark, docs, sf_dir) and gives the frame that is written and read again as the
next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustledger.llm import bpe, langid, linededup, mixing, ngramjoin
from gustledger.llm.common import stage


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (6): documents without a language that holds half of the letters go."""
    return langid.keep_identified(docs, langid.learn(docs))


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup (5): lines of 40 characters found in five documents stay in the last one."""
    return linededup.dedup_lines(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (8): of documents that link, the one with the smallest id stays."""
    return ngramjoin.keep_representatives(docs, words=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing (3): documents repeat so that the sources come near their targets."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE (1): the token ids of every document, and the digest of the text that they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    # Stored between the two, so that a task has one Python worker at a time and executors keep half as many.
    ids = stage(bpe.encode(docs, path, public_tokenizers.PATTERN).drop("text"), "token-ids")
    return bpe.decode(ids, path).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("language id", identified),
    ("line dedup", fresh_lines),
    ("n-gram jaccard join", one_of_each),
    ("mixing", mixed),
    ("byte-level bpe", token_ids),
]

# Training a language model has no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
