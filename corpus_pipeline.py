"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

1. quality      documents that the quality rules reject go
2. exact        one row of each group of equal texts stays
3. near         one document of each group of near copies stays (five-word
                shingles, Jaccard similarity 0.8 or more)
4. mix          each document is taken 0, 1 or 2 times, towards the source targets
5. pieces       texts are encoded to SentencePiece identifiers, and decoded to see that nothing is lost

A stage takes (spark, docs, sf_dir); all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import exact_dedup, jaccard_join, mixing, quality, sentencepieces
from tarmac.llm.common import materialise, read_table
from tarmac.llm.queries import PIECE_MODEL


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs, read_table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one_of_each(docs, width=5, percent=80)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepieces.encode_and_decode(docs, PIECE_MODEL)


STAGES = [("quality", quality_stage), ("exact", exact_stage), ("near", near_stage),
          ("mix", mix_stage), ("pieces", piece_stage)]

# Cutoffs from binomial bounds, balanced sampling and encoding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
