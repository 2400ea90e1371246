"""The corpus pipeline: from the documents table to training tokens in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import bpe, gam, jaccard, mix, suffix
from gristmill.llm.common import discard, stored

#: Shingle length and similarity in percent of the near-copy stage.
WORDS, PERCENT = 5, 80
#: Shortest repeated passage, in bytes, that the suffix-array stage cuts: the least length of 51 words with a blank between them.
PASSAGE_BYTES = 101


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    return gam.keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return jaccard.drop_near_copies(docs, WORDS, PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document holds too; n_chars follows the text."""
    return suffix.cut_repeats(docs, PASSAGE_BYTES)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents sampled by their calibrated probabilities."""
    return mix.sample_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and their number."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", classify),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]
#: SQL can't express the classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each one's rows are written and read again for the next, then deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        after = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(docs)
        docs = after
    return docs
