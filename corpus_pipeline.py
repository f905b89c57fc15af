"""A training corpus from raw documents: toxic ones go, shared lines go, one of each group of near copies stays, sources
are mixed to their weights, and the rest is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns the columns of documents, the last one its sequences. `run` applies
them in turn to the documents table, by way of tables in the shared folder, so that no stage's work is done twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import jaccard, line_dedup, mixing, packing, toxicity
from tessella.llm.common import read, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_shared_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.remix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_shared_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Toxicity, near copies and tokens are beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if i == 0 else written(docs), sf_dir)
    return docs
