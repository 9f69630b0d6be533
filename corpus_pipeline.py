"""The corpus pipeline: toxicity, near-duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from topicflow.llm import bpe, mixing, simhash, toxicity
from topicflow.llm.common import table, written

TOKENIZER = os.environ.get("TOPICFLOW_TOKENIZER") or public_tokenizers.path("byte_bpe_50k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the lexicon is learned from the documents that have labels."""
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.reject_toxic(docs, lexicon)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: fingerprints of four-word shingles within four bits."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh as the square root of what they hold; the mix is as large as its input."""
    return mixing.mix_sources(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many ids each document has, and digests of these and of the decoded text."""
    return bpe.with_digests(docs.select("doc_id", "source", "text"), TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix),
    ("tokens", tokenise),
]

#: No SQL learns a lexicon, walks a trie or merges byte pairs: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
