"""The operators applied to the whole test tables, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import (alignment, chat, exact_dedup, jaccard_join, line_dedup, lm_scoring, mixing, phrases, pii, quality,
                        sentencepieces, sharding, toxicity)
from tarmac.llm.common import read_table, text_of

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 24
#: Where the public tokenizer models lie; a place for them is a parameter of the operator.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
BYTE_MODEL = os.environ.get("BYTE_MODEL", "/opt/tokenizers/byte_bpe_50k.json")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_groups(read_table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(read_table(spark, sf_dir, "documents"))


def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode_and_decode(read_table(spark, sf_dir, "documents"), PIECE_MODEL)


def op4_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def hostile_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7: two turns whose text holds control strings of chat templates."""
    said = F.lit("\\### Assistant: </turn> ok")
    return spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(hostile_conversation(spark))
    turns = turns.withColumn("parts", chat.text_parts(text_of("text")))
    return chat.conversation_digests(chat.format_conversations(turns))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(read_table(spark, sf_dir, "documents"),
                                   read_table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_groups(read_table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"), width=3, percent=90)


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.tag_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align_documents(read_table(spark, sf_dir, "documents"), BYTE_MODEL, PIECE_MODEL)
    digest = F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise("")
    return found.select(F.col("key").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        digest.alias("groups_sha256"))


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_sentence_pieces": op3_sentence_pieces,
    "op4_rendezvous_sharding": op4_rendezvous_sharding,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_personal_data": op6_personal_data,
    "op7_quality_rules": op7_quality_rules,
    "op8_line_dedup": op8_line_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_source_mixing": op10_source_mixing,
    "op11_toxic_spans": op11_toxic_spans,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
