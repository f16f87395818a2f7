"""Running streaming questions to completion over a replayed flight table.

Each run gets its own folder under the shared checkpoint folder holding
the staged input, the query checkpoint and the sink table, so a restarted
run resumes from its checkpoint and the sinks stay exactly-once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tarmac.plans import base
from tarmac.schema import result_key
from tarmac.session import scratch_dir
from tarmac.streaming import late, sinks
from tarmac.streaming.folder import all_questions_sink
from tarmac.streaming.pace import AS_IT_COMES, Pace, state_partitions
from tarmac.streaming.progress import Progress
from tarmac.streaming.questions import (DEFAULT_WATERMARK, best_legs_stream,
                                        question_stream, trips_stream)
from tarmac.streaming.source import Replay, read_stream


def _drive(replay: Replay, start: Callable[[], StreamingQuery], sentinel: bool) -> dict:
    """Feed the slices one by one to a running query; return summed progress counters.

    With a sentinel, the query is one of event time, whose state holds what a whole slice brings.
    """
    at_once = max(replay.sizes(), default=0) if sentinel else 0
    if replay.keys:
        replay.write_slice(replay.keys[0])
    else:
        replay.write_empty()
    with state_partitions(replay.frame.sparkSession, at_once):
        q = start()
    progress = Progress()
    try:
        for key in replay.keys[1:]:
            q.processAllAvailable()
            progress.collect(q)
            replay.write_slice(key)
        if sentinel:
            # the first sentinel moves the watermark past every day at the end of its batch;
            # the second one runs a batch under that watermark, which closes the last days
            for _ in range(2):
                q.processAllAvailable()
                replay.write_sentinel()
        q.processAllAvailable()
        progress.collect(q)
        if q.exception() is not None:
            raise q.exception()
        return progress.totals()
    finally:
        q.stop()


def run_question(spark: SparkSession, flights: DataFrame, name: str, mode: str = "update",
                 slice_by: str = "year", run_dir: str | None = None,
                 resume: bool = False, pace: Pace = AS_IT_COMES) -> DataFrame:
    """Stream q1.1 ... q2.4 over ``flights``; returns the final sink table."""
    if mode not in ("update", "complete"):
        raise ValueError(mode)
    run_dir = run_dir or scratch_dir(spark, f"stream-{name}")
    table, keys = f"{run_dir}/table", result_key(name)
    replay = Replay(flights, f"{run_dir}/stage", slice_by, resume=resume)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if mode == "update":
                sinks.upsert(batch, batch_id, table, keys)
            else:
                sinks.replace(batch, batch_id, table)
        finally:
            batch.unpersist()

    def start() -> StreamingQuery:
        out = question_stream(read_stream(spark, replay.stage_dir, pace), name)
        return pace.writer(out.writeStream.outputMode(mode).foreachBatch(sink)
                           .option("checkpointLocation", f"{run_dir}/checkpoint")).start()

    _drive(replay, start, sentinel=False)
    return sinks.read_table(spark, table)


def _append_run(spark: SparkSession, flights: DataFrame, build, run_dir: str,
                slice_by: str, shuffled: bool = False, resume: bool = False
                ) -> tuple[DataFrame, dict]:
    replay = Replay(flights, f"{run_dir}/stage", slice_by, shuffled=shuffled,
                    resume=resume)
    out_path = f"{run_dir}/table"

    def start() -> StreamingQuery:
        return (build(read_stream(spark, replay.stage_dir)).writeStream.outputMode("append")
                .format("parquet").option("path", out_path)
                .option("checkpointLocation", f"{run_dir}/checkpoint").start())

    counters = _drive(replay, start, sentinel=True)
    return spark.read.parquet(out_path), counters


def run_best_legs(spark: SparkSession, flights: DataFrame, slice_by: str = "year",
                  watermark: str = DEFAULT_WATERMARK, run_dir: str | None = None,
                  resume: bool = False) -> DataFrame:
    run_dir = run_dir or scratch_dir(spark, "stream-legs")
    df, _ = _append_run(spark, flights, lambda s: best_legs_stream(s, watermark), run_dir,
                        slice_by, resume=resume)
    return df


def run_trips(spark: SparkSession, flights: DataFrame, slice_by: str = "year",
              watermark: str = DEFAULT_WATERMARK, run_dir: str | None = None,
              resume: bool = False) -> DataFrame:
    run_dir = run_dir or scratch_dir(spark, "stream-trips")
    df, _ = _append_run(spark, flights, lambda s: trips_stream(s, watermark), run_dir, slice_by,
                        resume=resume)
    return df


def run_late_data(spark: SparkSession, flights: DataFrame, slice_by: str = "year",
                  watermark: str = DEFAULT_WATERMARK, run_dir: str | None = None) -> DataFrame:
    """Best legs over slices staged out of date order: what the watermark lets through.

    A slice that comes after a later one is behind the watermark, so only the
    slices that are later than all before them reach the result.
    """
    run_dir = run_dir or scratch_dir(spark, "stream-late")
    legs, _ = _append_run(spark, flights, lambda s: best_legs_stream(s, watermark), run_dir,
                          slice_by, shuffled=True)
    return legs


def run_late_flights(spark: SparkSession, flights: DataFrame, slice_by: str = "year",
                     watermark: str = DEFAULT_WATERMARK, run_dir: str | None = None,
                     pace: Pace = AS_IT_COMES) -> tuple[DataFrame, DataFrame, dict]:
    """Slices out of date order, late flights routed aside: best legs, the late flights, and counts.

    The counts are of flights, over all micro-batches: ``flights``, ``late``, ``undated``.
    """
    run_dir = run_dir or scratch_dir(spark, "stream-late-flights")
    replay = Replay(flights, f"{run_dir}/stage", slice_by, shuffled=True)
    routed, total = f"{run_dir}/route", sum(replay.sizes())  # all on-time flights may be one micro-batch
    _drive(replay, lambda: late.start_routing(spark, read_stream(spark, replay.stage_dir), routed, watermark),
           sentinel=True)
    # all on-time flights are there, the sentinels among them: one run to the end closes every day
    ends = Pace(available_now=True, max_files=pace.max_files, max_bytes=pace.max_bytes)
    legs = best_legs_stream(late.on_time_stream(spark, routed, ends), watermark)
    with state_partitions(spark, total):
        query = ends.writer(legs.writeStream.outputMode("append").format("parquet").option("path", f"{run_dir}/table")
                            .option("checkpointLocation", f"{run_dir}/checkpoint")).start()
    query.awaitTermination()
    table = spark.read.schema(legs.schema).parquet(f"{run_dir}/table")
    return table, late.late_flights(spark, routed), late.counts(spark, routed)


def run_all_questions(spark: SparkSession, flights: DataFrame, slice_by: str = "year",
                      run_dir: str | None = None, resume: bool = False, mode: str = "update",
                      pace: Pace = AS_IT_COMES) -> dict[str, DataFrame]:
    """Seven questions from one streaming scan; returns the final table of each.

    Each micro-batch is one base aggregate, merged into one state table;
    ``update`` publishes the answers after each of them, ``complete`` at the end.
    """
    run_dir = run_dir or scratch_dir(spark, "stream-all")
    replay = Replay(flights, f"{run_dir}/stage", slice_by, resume=resume)

    def start() -> StreamingQuery:
        stream = read_stream(spark, replay.stage_dir, pace)
        return pace.writer(stream.writeStream.foreachBatch(all_questions_sink(run_dir, mode))
                           .option("checkpointLocation", f"{run_dir}/checkpoint")).start()

    _drive(replay, start, sentinel=False)
    state = sinks.read_table(spark, f"{run_dir}/state")
    return {n: base.answer_from_base(state, n) for n in base.COVERED}
