"""Questions over a folder of files that is added to while they run.

A job reads clean (';') or raw files, keeps its checkpoint and its table in
``run_dir``, and can be stopped and started again: it goes on after the last
committed micro-batch and reads no file twice.  ``Pace`` sets trigger and
bounds; with ``available_now`` a job ends when the folder is worked through,
which is the way to run it from a scheduler.

    job = start_question(spark, "hdfs:///ontime/clean/*", "q2.4", "hdfs:///runs/q24",
                         pace=Pace(interval="10 seconds", max_bytes="1g"))
    job.table().show()      # what the micro-batches so far amount to
    job.stop()
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tarmac.plans import base
from tarmac.schema import RESULTS, result_key
from tarmac.streaming import sinks
from tarmac.streaming.pace import AS_IT_COMES, Pace, state_partitions
from tarmac.streaming.progress import Progress
from tarmac.streaming.questions import (DEFAULT_WATERMARK, best_legs_stream, data_rows, question_stream,
                                        trips_stream)
from tarmac.streaming.source import read_clean_stream, read_raw_stream

READERS = {"clean": read_clean_stream, "raw": read_raw_stream}


@dataclass
class Job:
    """A running question: its query, the table so far, and counters over all its micro-batches."""

    query: StreamingQuery
    read: Callable[[], DataFrame]
    progress: Progress = field(default_factory=Progress)

    def table(self) -> DataFrame:
        return self.read()

    def counters(self) -> dict:
        self.progress.collect(self.query)
        return self.progress.totals()

    def wait(self) -> DataFrame:
        """Until what is in the folder now is worked through; with ``available_now``, until the end."""
        while self.query.isActive and not self._idle():
            self.progress.collect(self.query)
            time.sleep(0.1)
        if self.query.isActive:
            self.query.processAllAvailable()
        self.progress.collect(self.query)
        if self.query.exception() is not None:
            raise self.query.exception()
        return self.table()

    def _idle(self) -> bool:
        s = self.query.status
        return not s["isTriggerActive"] and not s["isDataAvailable"] and bool(self.query.recentProgress)

    def stop(self) -> None:
        self.query.stop()


def _stream(spark: SparkSession, folder: str, kind: str, pace: Pace, source: dict) -> DataFrame:
    return READERS[kind](spark, folder, pace, **source)


def start_question(spark: SparkSession, folder: str, name: str, run_dir: str, mode: str = "update",
                   pace: Pace = AS_IT_COMES, kind: str = "clean", buckets: int = sinks.BUCKETS, **source) -> Job:
    """q1.1 ... q2.4 over a folder; ``update`` upserts touched keys, ``complete`` replaces the table.

    ``source`` is passed to the reader: ``path_glob``, ``archive_dir``, ``delete``.
    """
    if mode not in ("update", "complete"):
        raise ValueError(mode)
    table = f"{run_dir}/table"

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if mode == "update":
                sinks.upsert(batch, batch_id, table, result_key(name), buckets)
            else:
                sinks.replace(batch, batch_id, table)
        finally:
            batch.unpersist()

    out = question_stream(_stream(spark, folder, kind, pace, source), name)
    with state_partitions(spark):
        query = pace.writer(out.writeStream.outputMode(mode).foreachBatch(sink)
                            .option("checkpointLocation", f"{run_dir}/checkpoint")).start()
    return Job(query, lambda: sinks.read_table(spark, table, RESULTS[name][0]))


def all_questions_sink(run_dir: str, mode: str, buckets: int = sinks.BUCKETS) -> Callable[[DataFrame, int], None]:
    """Merge each micro-batch's base aggregate into one state table; ``update`` also publishes the answers."""
    if mode not in ("update", "complete"):
        raise ValueError(mode)

    def sink(batch: DataFrame, batch_id: int) -> None:
        new = base.base_aggregate(data_rows(batch)).persist()
        try:
            sinks.merge(new, batch_id, f"{run_dir}/state", base.BASE_KEYS,
                        lambda old, fresh: base.merge_base(old.unionByName(fresh)), buckets)
            if mode == "update":
                publish(batch.sparkSession, run_dir, batch_id)
        finally:
            new.unpersist()
    return sink


def publish(spark: SparkSession, run_dir: str, batch_id: int) -> None:
    """Answers of all questions from the state table, as one table (``base.answers``)."""
    sinks.replace(base.answers(sinks.read_table(spark, f"{run_dir}/state")), batch_id, f"{run_dir}/answers")


def published(spark: SparkSession, run_dir: str) -> DataFrame:
    """The answers: those published after each micro-batch or, of a ``complete`` run, of the state now."""
    if not sinks.versions(spark, f"{run_dir}/answers"):
        publish(spark, run_dir, sinks.versions(spark, f"{run_dir}/state")[-1])
    return sinks.read_table(spark, f"{run_dir}/answers")


def start_all_questions(spark: SparkSession, folder: str, run_dir: str, mode: str = "update",
                        pace: Pace = AS_IT_COMES, kind: str = "clean", **source) -> Job:
    """Seven questions from one scan of the stream and one state table.

    ``update`` publishes the answers after each micro-batch, ``complete`` when they are asked for.
    """
    stream = _stream(spark, folder, kind, pace, source)
    with state_partitions(spark):
        query = pace.writer(stream.writeStream.foreachBatch(all_questions_sink(run_dir, mode))
                            .option("checkpointLocation", f"{run_dir}/checkpoint")).start()
    return Job(query, lambda: published(spark, run_dir))


def _append(spark: SparkSession, out: DataFrame, run_dir: str, pace: Pace) -> Job:
    query = pace.writer(out.writeStream.outputMode("append").format("parquet").option("path", f"{run_dir}/table")
                        .option("checkpointLocation", f"{run_dir}/checkpoint")).start()
    return Job(query, lambda: spark.read.schema(out.schema).parquet(f"{run_dir}/table"))


def start_best_legs(spark: SparkSession, folder: str, run_dir: str, watermark: str = DEFAULT_WATERMARK,
                    pace: Pace = AS_IT_COMES, kind: str = "clean", **source) -> Job:
    """Best legs of the days that the watermark has passed; later days stay in the state."""
    return _append(spark, best_legs_stream(_stream(spark, folder, kind, pace, source), watermark), run_dir, pace)


def start_trips(spark: SparkSession, folder: str, run_dir: str, watermark: str = DEFAULT_WATERMARK,
                pace: Pace = AS_IT_COMES, kind: str = "clean", offset_days: int = 2, **source) -> Job:
    """Two-leg trips whose days the watermark has passed."""
    stream = _stream(spark, folder, kind, pace, source)
    return _append(spark, trips_stream(stream, watermark, offset_days), run_dir, pace)
