"""A training corpus from `documents`: what is toxic or said before goes, sources are mixed, texts packed.

Each stage reads what the one before it kept, written as Parquet; all but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plotwise.llm.exact import drop_exact_copies
from plotwise.llm.minhash import drop_near_copies
from plotwise.llm.mixing import mixed_documents
from plotwise.llm.packing import pack_documents
from plotwise.llm.spark import stored, table
from plotwise.llm.toxicity import drop_toxic

NEAR_SHINGLE = 5  # words; the similarity is 0.8


def drop_toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches 0.3 go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z the largest doc_id stays."""
    return drop_exact_copies(docs)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays."""
    return drop_near_copies(docs, shingle=NEAR_SHINGLE)


def mix_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: never, once or twice."""
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens, each with its place in a sequence."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic_documents),
    ("exact_dedup", keep_one_of_equal),
    ("near_dedup", keep_one_of_similar),
    ("source_mix", mix_by_source),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # a trained model and a tokenizer are beyond SQL; tests/llm holds a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
