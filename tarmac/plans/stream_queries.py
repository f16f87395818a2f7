"""Registered streaming queries: each replays the curated flights of the
given tables as a file stream, runs the streaming question to completion
and returns its sink table as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schema import result_key
from tarmac.session import apply_runtime_conf, scratch_dir
from tarmac.sources.curated import curated_flights
from tarmac.sources.raw import write_clean_text
from tarmac.streaming import folder, runner
from tarmac.streaming.pace import Pace


def _fl(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_runtime_conf(spark)
    return curated_flights(spark, sf_dir)


def _question(name: str, mode: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return runner.run_question(spark, _fl(spark, sf_dir), name, mode)
    return run


def best_leg_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runner.run_best_legs(spark, _fl(spark, sf_dir))


def trips_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runner.run_trips(spark, _fl(spark, sf_dir))


def late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year slices in shuffled order: the best legs of those that are not late."""
    return runner.run_late_data(spark, _fl(spark, sf_dir), slice_by="year")


def undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q1.1 over a stream in which every seventh order's flights have lost their date."""
    order = F.split("flight_num", "-")[0].cast("long")
    fl = _fl(spark, sf_dir).withColumn("flight_date", F.when(order % 7 != 0, F.col("flight_date")))
    return runner.run_question(spark, fl, "q1.1", "update")


def late_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year slices in shuffled order: the flights behind the watermark, counted by year from the side table."""
    _, late, _ = runner.run_late_flights(spark, _fl(spark, sf_dir), slice_by="year")
    return late.groupBy(F.year("flight_date").alias("year")).agg(F.count(F.lit(1)).alias("late_flights"))


def clean_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q2.2 over a folder of ';' files that is added to while the stream runs, stopped and started again."""
    flights, run = _fl(spark, sf_dir), scratch_dir(spark, "stream-folder")
    lots = [flights.filter(F.coalesce(F.pmod(F.year("flight_date"), F.lit(3)) == k, F.lit(k == 0)))
            for k in range(3)]
    start = lambda pace: folder.start_question(spark, f"{run}/files/*", "q2.2", f"{run}/job", pace=pace)
    write_clean_text(lots[0], f"{run}/files/a")
    job = start(Pace(interval="1 second", max_files=8))
    job.wait()
    write_clean_text(lots[1], f"{run}/files/b")
    job.wait()
    job.stop()
    write_clean_text(lots[2], f"{run}/files/c")
    return start(Pace(available_now=True, max_files=8)).wait()


LONG_COLUMNS = ["question", "key1", "key2", "key3", "delay", "n_flights"]


def to_long(name: str, table: DataFrame) -> DataFrame:
    keys = result_key(name)
    ks = [F.col(k).cast("string") for k in keys] + [F.lit(None).cast("string")] * (3 - len(keys))
    if name == "q1.1":
        measure = [F.lit(None).cast("double").alias("delay"), F.col("cnt").alias("n_flights")]
    else:
        measure = [F.col("delay"), F.col("n_flights")]
    return table.select(F.lit(name).alias("question"), *[k.alias(f"key{i + 1}")
                                                          for i, k in enumerate(ks)], *measure)


def all_questions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q1.1 ... q2.4 from one streaming scan, as one long table."""
    tables = runner.run_all_questions(spark, _fl(spark, sf_dir))
    out = None
    for name, t in tables.items():
        long = to_long(name, t)
        out = long if out is None else out.unionByName(long)
    return out


QUERIES = {
    "stream_q1_1_update": _question("q1.1", "update"),
    "stream_q1_2_update": _question("q1.2", "update"),
    "stream_q1_2_complete": _question("q1.2", "complete"),
    "stream_q1_3_update": _question("q1.3", "update"),
    "stream_q2_1_update": _question("q2.1", "update"),
    "stream_q2_2_complete": _question("q2.2", "complete"),
    "stream_q2_3_update": _question("q2.3", "update"),
    "sink_upsert_latest": _question("q2.4", "update"),
    "stream_all_questions": all_questions_stream,
    "stream_best_leg": best_leg_stream,
    "stream_q3_two_leg_trips": trips_stream,
    "stream_late_data": late_data,
    "stream_undated": undated,
    "stream_late_flights": late_flights,
    "stream_clean_files": clean_files,
}

NO_ORACLE: set[str] = set()
