"""Late flights: counted, kept in a side table, and held back from the event-time questions.

Spark's watermark drops late rows inside the stateful operator, where only
partial groups are left to count.  So flights are routed before it: each
micro-batch is split by the watermark that its predecessors have reached (the
greatest event time so far, less the delay), with the operator's own rule (a
row is late when its day ended at or before the watermark).  On-time flights
go on to the question as a stream; late ones are a table.

A micro-batch is written once, metrics are observed in the same pass, and
then it is moved to its place whole.  Its watermark and the running counts
are kept by batch id, so a replayed batch splits as before and is not counted
twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tarmac.streaming.files import move_into_place, names, read_text, remove, write_text
from tarmac.streaming.pace import AS_IT_COMES, Pace
from tarmac.streaming.questions import DEFAULT_WATERMARK, SENTINEL
from tarmac.streaming.source import STREAM_SCHEMA

COUNTS = ["flights", "late", "undated"]
KEEP = 2


def _notes(spark: SparkSession, run_dir: str) -> list[int]:
    return sorted(int(n[:-5]) for n in names(spark, f"{run_dir}/notes") if n.endswith(".json"))


def _note(spark: SparkSession, run_dir: str, before: int | None = None) -> dict:
    """Watermark (microseconds) and counts after the last batch (``before`` a given one)."""
    known = [n for n in _notes(spark, run_dir) if before is None or n < before]
    return json.loads(read_text(spark, f"{run_dir}/notes/{known[-1]}.json")) if known else {
        "watermark": None, **dict.fromkeys(COUNTS, 0)}


def start_routing(spark: SparkSession, stream: DataFrame, run_dir: str, watermark: str = DEFAULT_WATERMARK,
                  pace: Pace = AS_IT_COMES) -> StreamingQuery:
    """Split a flight stream (with ``ts``) into on-time and late flights below ``run_dir``."""
    def route(batch: DataFrame, batch_id: int) -> None:
        prior = _note(spark, run_dir, batch_id)
        ends = F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY")
        passed = F.timestamp_micros(F.lit(prior["watermark"]).cast("long"))
        is_late = F.coalesce(ends <= passed, F.lit(False))
        seen, flight = Observation(), F.coalesce(F.col("slice") != SENTINEL, F.lit(True))
        routed = batch.select(*STREAM_SCHEMA.names, is_late.alias("late")).observe(
            seen, F.count_if(flight).alias("flights"), F.count_if(F.col("late")).alias("late"),
            F.count_if(F.col("ts").isNull()).alias("undated"),
            F.max(F.unix_micros(F.col("ts") - F.expr(f"INTERVAL {watermark}"))).alias("watermark"))
        aside = f"{run_dir}/incoming/{batch_id}"
        routed.write.mode("overwrite").partitionBy("late").parquet(aside)
        told = seen.get
        move_into_place(spark, aside, f"{run_dir}/routed/batch={batch_id}")
        reached = max((w for w in (prior["watermark"], told["watermark"]) if w is not None), default=None)
        write_text(spark, f"{run_dir}/notes/{batch_id}.json", json.dumps(
            {"watermark": reached, **{c: prior[c] + told[c] for c in COUNTS}}))
        for old in _notes(spark, run_dir)[:-KEEP]:
            remove(spark, f"{run_dir}/notes/{old}.json")

    return pace.writer(stream.writeStream.foreachBatch(route)
                       .option("checkpointLocation", f"{run_dir}/checkpoint")).start()


def counts(spark: SparkSession, run_dir: str) -> dict:
    """Flights, late flights and undated ones of all micro-batches so far."""
    return {c: n for c, n in _note(spark, run_dir).items() if c in COUNTS}


def on_time_stream(spark: SparkSession, run_dir: str, pace: Pace = AS_IT_COMES) -> DataFrame:
    reader = pace.reader(spark.readStream.schema(STREAM_SCHEMA).format("parquet"))
    return reader.load(f"{run_dir}/routed/*/late=false/*.parquet")


def late_flights(spark: SparkSession, run_dir: str) -> DataFrame:
    """The side table of late flights."""
    if not names(spark, f"{run_dir}/routed"):
        return spark.createDataFrame([], STREAM_SCHEMA)
    whole = StructType([*STREAM_SCHEMA.fields, StructField("batch", LongType()), StructField("late", BooleanType())])
    return spark.read.schema(whole).parquet(f"{run_dir}/routed").filter("late").select(*STREAM_SCHEMA.names)
