"""User-facing jobs: ingest, run one or all batch questions, answer lookups.

    spark = tarmac.get_session()
    flights = ingest_raw(spark, "hdfs:///ontime/raw/*.csv.gz", "hdfs:///ontime/flights")
    run_batch(flights, "hdfs:///ontime/results")          # every question -> keyed tables
    lookup_many(spark.read.parquet(".../results/q2.1_top"), ["origin"], [("CMI",), ("JFK",)])
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.plans.base import COVERED, answer_from_base, base_aggregate
from tarmac.plans.questions import QUESTIONS, answer, ranking
from tarmac.schema import result_key
from tarmac.sinks.tables import write_flights, write_result
from tarmac.sources.archives import read_archives
from tarmac.sources.curated import read_flights
from tarmac.sources.raw import curate_raw, read_raw


def ingest_raw(spark: SparkSession, raw_paths: str | list[str], out_path: str) -> DataFrame:
    """Raw CSV (plain or gzip) -> curated Parquet table; returns the table."""
    write_flights(curate_raw(read_raw(spark, raw_paths)), out_path)
    return read_flights(spark, out_path).drop("year")


def ingest_archives(spark: SparkSession, zip_root: str, out_path: str) -> DataFrame:
    """Folder tree of zip archives -> curated Parquet table; returns the table."""
    write_flights(curate_raw(read_archives(spark, zip_root)), out_path)
    return read_flights(spark, out_path).drop("year")


def _store(spark: SparkSession, result: DataFrame, name: str, out_dir: str) -> str:
    q = QUESTIONS[name]
    path = f"{out_dir.rstrip('/')}/{name}"
    write_result(result, path, result_key(name), q.sort_by)
    if q.sort_by is not None:
        write_result(ranking(spark.read.parquet(path), name), f"{path}_top", q.rank_within or result_key(name),
                     q.sort_by)
    return path


def run_question(flights: DataFrame, name: str, out_dir: str, trip_offset_days: int = 2,
                 year: int | None = None) -> str:
    """Compute one question and store its keyed result table (and its ranking, if any).

    ``year`` reads that year's flights only; on the curated table the others'
    directories are skipped, if ``flights`` has its ``year`` column.
    """
    if year is not None:
        flights = flights.filter((F.col("year") if "year" in flights.columns else F.year("flight_date")) == year)
    return _store(flights.sparkSession, answer(flights, name, trip_offset_days=trip_offset_days), name, out_dir)


def run_batch(flights: DataFrame, out_dir: str, questions: list[str] | None = None) -> dict:
    """Every question (or the listed ones); returns name -> table path.

    q1.1 to q2.4 come from one base aggregate, stored beside the results, so the
    flights are read once for all of them (and once for the trips).
    """
    names, spark = list(questions or QUESTIONS), flights.sparkSession
    base = None
    if len([n for n in names if n in COVERED]) > 1:
        path = f"{out_dir.rstrip('/')}/base"
        base_aggregate(flights).write.mode("overwrite").parquet(path)
        base = spark.read.parquet(path)
    return {n: _store(spark, answer_from_base(base, n), n, out_dir) if base is not None and n in COVERED
            else run_question(flights, n, out_dir) for n in names}
