"""Registered queries for sources, sinks, curation rules and lookups.

Each one starts from the curated flights of the given test tables and,
where the operator is a file format, first has Spark write the flights in
that format under the shared checkpoint folder and then reads them back
through the operator under test — so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.columns import route_key
from tarmac.operators.aggregate import merge_means, partial_means
from tarmac.operators.curate import complete_rows, quality_counts, require, with_period
from tarmac.operators.lookup import lookup_many, lookup_question
from tarmac.operators.trips import best_legs, both_periods, trips_of_offsets, two_leg_trips
from tarmac.plans.questions import QUESTIONS, answer, question_input, ranking
from tarmac.schema import FLIGHT_COLUMNS
from tarmac.session import apply_runtime_conf, scratch_dir
from tarmac.sinks.export import export_results, read_export
from tarmac.sinks.lookups import open_lookup, write_lookup
from tarmac.sinks.tables import write_partitioned
from tarmac.sources.archives import read_archives, write_archives
from tarmac.sources.curated import curated_flights, curated_flights_path
from tarmac.sources.raw import (curate_clean, curate_raw, raw_rows, read_clean, read_raw,
                                write_clean_text, write_raw_csv)
from tarmac.sources.selection import flights_of_years, year_sorted

# The year the trip question reads (the reference used its
# data set's last year; the test tables span 1995-2001).
TRIP_YEAR = 1998

# Request keys of the lookup queries (airport names of the test tables).
LOOKUP_ROUTE = {"origin": "NATION_1", "dest": "NATION_2"}
LOOKUP_TRIP = {"date1": "1998-01-01", "origin": "NATION_11", "dest1": "NATION_22",
               "dest2": "NATION_12"}
LOOKUP_ORIGINS = ["NATION_0", "NATION_5", "NATION_10", "NATION_15", "NATION_20"]


def _flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_runtime_conf(spark)
    return curated_flights(spark, sf_dir)


def curate_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV round trip: write flights as raw CSV, scan + curate, apply q2.3's rule."""
    path = write_raw_csv(_flights(spark, sf_dir), scratch_dir(spark, "raw-csv"))
    return question_input(curate_raw(read_raw(spark, path)), "q2.3")


def complete_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean-file round trip: write ';' lines, scan, keep rows with every field present."""
    path = write_clean_text(_flights(spark, sf_dir), scratch_dir(spark, "clean"))
    return curate_clean(complete_rows(read_clean(spark, path)))


def _faulty_raw_text(flights: DataFrame, path: str) -> str:
    """Raw lines of flights, some short (line number 7) or with a word as arrival delay (cancelled, 3)."""
    rows = raw_rows(flights).withColumn("ArrDelay", F.when(
        F.col("FlightNum").endswith("-3") & (F.col("ArrDelay") == ""), F.lit("cancelled")).otherwise(F.col("ArrDelay")))
    line = F.to_csv(F.struct(*rows.columns))
    rows.select(F.when(F.col("FlightNum").endswith("-7"), F.substring_index(line, ",", 10)).otherwise(line)
                .alias("value")).write.mode("overwrite").text(path)
    return path


def curate_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text round trip: rows read and, per curated column, rows where it is missing or unparsable."""
    path = _faulty_raw_text(_flights(spark, sf_dir), scratch_dir(spark, "raw-quality"))
    fl = curate_raw(read_raw(spark, path, corrupt="corrupt"), faults="faults", keep=["corrupt"])
    return quality_counts(fl, FLIGHT_COLUMNS, faults="faults", corrupt="corrupt")


def archive_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive round trip: zip the flights as raw CSV, cut, inflate and curate every member."""
    path = write_archives(_flights(spark, sf_dir), scratch_dir(spark, "archives"))
    return curate_raw(read_archives(spark, path, pattern="part-*"))


def export_results_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven aggregate questions exported with exact decimal means, read back as text."""
    return read_export(spark, export_results(_flights(spark, sf_dir), scratch_dir(spark, "export")))


def time_of_day_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    fl = require(_flights(spark, sf_dir), ["crs_dep_time"])
    return with_period(fl).select("flight_date", "flight_num", "crs_dep_time",
                                  "minute_of_day", "period")


def route_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    q24 = answer(_flights(spark, sf_dir), "q2.4")
    return q24.select(route_key("origin", "dest").alias("route"), "origin", "dest", "delay",
                      "n_flights")


def mean_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-year partial (mean, count) tables merged into q1.2."""
    fl = _flights(spark, sf_dir)
    inp = require(fl.select("unique_carrier", "arr_delay", F.year("flight_date").alias("year")),
                  QUESTIONS["q1.2"].required)
    partials = partial_means(inp, ["year", "unique_carrier"], "arr_delay")
    return merge_means(partials, ["unique_carrier"])


def scan_year_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of one year, read through partition pruning of the curated table."""
    apply_runtime_conf(spark)
    fl = flights_of_years(spark, curated_flights_path(spark, sf_dir), [TRIP_YEAR])
    return two_leg_trips(both_periods(fl))


def extract_year_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_runtime_conf(spark)
    return year_sorted(spark, curated_flights_path(spark, sf_dir), TRIP_YEAR)


def partitioned_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best legs written under one directory per (date, period), read back."""
    legs = best_legs(_flights(spark, sf_dir))
    path = write_partitioned(legs, scratch_dir(spark, "legs"), ["flight_date", "period"])
    return spark.read.schema(legs.schema).parquet(path).select(*legs.columns)


def trip_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips whose second leg leaves one, two or three days later, in one join."""
    return trips_of_offsets(both_periods(_flights(spark, sf_dir)), [1, 2, 3])


def _stored(spark: SparkSession, sf_dir: str, name: str, rank: bool = False) -> DataFrame:
    """A question's stored result table (or its ranking), as a reader of the results opens it."""
    flights = _flights(spark, sf_dir)
    result = answer(flights, name)
    path = write_lookup(ranking(result, name) if rank else result, scratch_dir(spark, "lookup"),
                        QUESTIONS[name].params, QUESTIONS[name].sort_by)
    return open_lookup(spark, path)


def lookup_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean delay of one route, from the stored table."""
    return lookup_question(_stored(spark, sf_dir, "q2.4"), "q2.4", **LOOKUP_ROUTE)


def lookup_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip, from the stored table."""
    return lookup_question(_stored(spark, sf_dir, "q3"), "q3", **LOOKUP_TRIP)


def lookup_many_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-10 carriers for several origins in one job, from the stored ranking (q2.1 batch lookup)."""
    return lookup_many(_stored(spark, sf_dir, "q2.1", rank=True), ["origin"], [(o,) for o in LOOKUP_ORIGINS])


QUERIES = {
    "curate_required": curate_required,
    "complete_rows": complete_rows_query,
    "curate_quality": curate_quality,
    "archive_ingest": archive_ingest,
    "export_results": export_results_query,
    "time_of_day_split": time_of_day_split,
    "route_key": route_key_query,
    "mean_merge": mean_merge,
    "scan_year_prune": scan_year_prune,
    "extract_year_sorted": extract_year_sorted,
    "partitioned_legs": partitioned_legs,
    "trip_offsets": trip_offsets,
    "lookup_route": lookup_route,
    "lookup_trip": lookup_trip,
    "lookup_many": lookup_many_query,
}
