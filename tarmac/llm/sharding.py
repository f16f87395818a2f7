"""Sharding by weighted rendezvous hashing of record keys (operator 4).

Every (key, shard) pair gets a score that depends on nothing else; the
record goes to the shard with the greatest score.  Adding a shard adds one
score per record and leaves the others as they were, so a record either
stays or moves into the new shard.  A shard of weight ``w`` scores
``-w / ln(u)`` with ``u`` uniform in (0, 1), so it gets ``w`` parts in the
sum of all weights.

Slots number the records of a shard from 0 without gaps.  They are made
from counts of (shard, sub-bucket), a table of a fixed number of rows,
plus a row number inside each sub-bucket: a shard is never sorted in one
task.  A hot key value only reaches one sub-bucket with its own repeats;
``doc_id`` values are unique but for repeated rows.

Defined cases: a null key hashes as the empty key list (all null keys share
a shard); repeated rows share a shard and have different slots; an empty
table gives an empty result; other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import text_of

UNIT_BITS = (1 << 53) - 1
SUB_BUCKETS = 2048


def rendezvous_shard(key: Sequence[str | Column], weights: Sequence[float]) -> Column:
    """The shard (0 ... len(weights) - 1) that a record key goes to."""
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("weights must be positive, one per shard")
    scores = []
    for shard, weight in enumerate(weights):
        h = F.xxhash64(*key, F.lit(shard))
        u = (h.bitwiseAND(F.lit(UNIT_BITS)) + F.lit(0.5)) / F.lit(float(1 << 53))
        scores.append(F.struct((F.lit(-float(weight)) / F.ln(u)).alias("score"),
                               F.lit(shard).alias("shard")))
    return F.array_max(F.array(*scores))["shard"]


def with_slots(df: DataFrame, shard: str, order: Sequence[str], sub_buckets: int = SUB_BUCKETS,
               out: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in no task larger than a sub-bucket.

    ``order`` decides the order inside a sub-bucket; rows equal in all of it
    are interchangeable, so a rerun gives the same slots.
    """
    b, first = "_sub_bucket", "_first_slot"
    cut = df.withColumn(b, F.pmod(F.xxhash64(*order), F.lit(sub_buckets)))
    before = Window.partitionBy(shard).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = (cut.groupBy(shard, b).agg(F.count(F.lit(1)).alias("_n"))
              .select(F.col(shard).alias("_s"), F.col(b).alias("_b"),
                      F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(first)))
    inside = Window.partitionBy(shard, b).orderBy(*order)
    return (cut.withColumn("_row", F.row_number().over(inside) - 1)
            .join(starts, (F.col(shard) == F.col("_s")) & (F.col(b) == F.col("_b")))
            .withColumn(out, (F.col(first) + F.col("_row")).cast("long"))
            .drop(b, "_s", "_b", first, "_row"))


def shard_documents(docs: DataFrame, weights: Sequence[float], key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: its key, size, checksum, shard, slot, and the shard with one more.

    Size is the UTF-8 bytes of the text (null: none) plus 8; the checksum is
    the unsigned CRC-32 of those bytes.  ``grown_shard`` is the shard after a
    further shard of the mean weight has been added.
    """
    grown = [*weights, sum(weights) / len(weights)]
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(text_of(text)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text_of(text).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous_shard([key], weights).alias("shard"),
        rendezvous_shard([key], grown).alias("grown_shard"))
    return with_slots(rows, "shard", ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
