"""A training-data pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again
as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from textloom.llm import bpe, mixing, simhash, substring, toxicity
from textloom.scratch import written
from textloom.sizes import spread


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; labels teach, the classifier decides."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: links have a Jaccard similarity of
    0.8 of their five-word shingles."""
    return simhash.keep_one(docs, shingle_words=5, jaccard=0.8)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller doc_id has are cut from the text."""
    return substring.remove_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights; a document taken n times has n rows."""
    return mixing.mix_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become ids; the decoded bytes and hashes of both go with them."""
    return bpe.encode_documents(docs, bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", simhash_stage),
    ("substring_dedup", substring_stage),
    ("mixing", mixing_stage),
    ("byte_level_bpe", bpe_stage),
]

#: A trained classifier and the mixing draws have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
