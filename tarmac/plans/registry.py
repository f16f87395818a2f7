"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracle SQL.

Every query reads the whole test tables (through the ``flights`` view)
or data Spark derives from them; none runs on fixed input alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarmac.plans import oracle, source_queries, stream_queries
from tarmac.plans.base import answers, base_aggregate
from tarmac.plans.questions import answer, ranking
from tarmac.operators.trips import best_legs
from tarmac.session import apply_runtime_conf
from tarmac.sources.curated import curated_flights

Query = Callable[[SparkSession, str], DataFrame]


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_runtime_conf(spark)
    return curated_flights(spark, sf_dir)


def _answer(name: str) -> Query:
    return lambda spark, sf_dir: answer(flights(spark, sf_dir), name)


def _ranking(name: str) -> Query:
    return lambda spark, sf_dir: ranking(answer(flights(spark, sf_dir), name), name)


def _trips(offset: int) -> Query:
    return lambda spark, sf_dir: answer(flights(spark, sf_dir), "q3", trip_offset_days=offset)


QUERIES: dict[str, Query] = {
    "q1_1_airport_popularity": _answer("q1.1"),
    "q1_2_carrier_arrival": _answer("q1.2"),
    "q1_3_weekday_arrival": _answer("q1.3"),
    "q2_1_carrier_departure_by_origin": _answer("q2.1"),
    "q2_2_dest_departure_by_origin": _answer("q2.2"),
    "q2_3_carrier_arrival_by_route": _answer("q2.3"),
    "q2_4_route_arrival": _answer("q2.4"),
    "q3_two_leg_trips": _answer("q3"),
    "q1_1_top10": _ranking("q1.1"),
    "q1_2_top10": _ranking("q1.2"),
    "q1_3_ranked": _ranking("q1.3"),
    "q2_1_top10": _ranking("q2.1"),
    "q2_2_top10": _ranking("q2.2"),
    "q2_3_top10": _ranking("q2.3"),
    "best_leg_per_day_period": lambda spark, sf_dir: best_legs(flights(spark, sf_dir)),
    "trip_offset_days_1": _trips(1),
    "trip_offset_days_3": _trips(3),
    "batch_all_questions": lambda spark, sf_dir: answers(base_aggregate(flights(spark, sf_dir))),
    **source_queries.QUERIES,
    **stream_queries.QUERIES,
}

# Registered queries no SQL states (reported as rows-only checks).
NO_ORACLE = set(stream_queries.NO_ORACLE)

ORACLE: dict[str, str] = {
    "q1_1_airport_popularity": oracle.Q11,
    "q1_2_carrier_arrival": oracle.Q12,
    "q1_3_weekday_arrival": oracle.Q13,
    "q2_1_carrier_departure_by_origin": oracle.Q21,
    "q2_2_dest_departure_by_origin": oracle.Q22,
    "q2_3_carrier_arrival_by_route": oracle.Q23,
    "q2_4_route_arrival": oracle.Q24,
    "q3_two_leg_trips": oracle.Q3,
    "q1_1_top10": oracle.ranked_sql(oracle.Q11, ["airport", "cnt"], "cnt DESC, airport", k=10),
    "q1_2_top10": oracle.ranked_sql(oracle.Q12, ["unique_carrier", "delay", "n_flights"],
                                    "delay, unique_carrier", k=10),
    "q1_3_ranked": oracle.ranked_sql(oracle.Q13, ["weekday", "delay", "n_flights"],
                                     "delay, weekday"),
    "q2_1_top10": oracle.ranked_sql(oracle.Q21, ["origin", "unique_carrier", "delay", "n_flights"],
                                    "delay, unique_carrier", ["origin"], 10),
    "q2_2_top10": oracle.ranked_sql(oracle.Q22, ["origin", "dest", "delay", "n_flights"],
                                    "delay, dest", ["origin"], 10),
    "q2_3_top10": oracle.ranked_sql(oracle.Q23, ["origin", "dest", "unique_carrier", "delay",
                                                 "n_flights"],
                                    "delay, unique_carrier", ["origin", "dest"], 10),
    "best_leg_per_day_period": oracle.BEST_LEGS,
    "trip_offset_days_1": oracle.trips_sql(1),
    "trip_offset_days_3": oracle.trips_sql(3),
    "trip_offsets": oracle.trips_of_offsets_sql([1, 2, 3]),
    "curate_required": oracle.CURATE_REQUIRED,
    "complete_rows": oracle.COMPLETE_ROWS,
    "curate_quality": oracle.QUALITY,
    "archive_ingest": oracle.ALL_FLIGHTS,
    "export_results": oracle.export_sql(),
    "time_of_day_split": oracle.TIME_OF_DAY,
    "route_key": oracle.ROUTE_KEY,
    "mean_merge": oracle.Q12,
    "scan_year_prune": oracle.YEAR_TRIPS,
    "extract_year_sorted": oracle.YEAR_EXTRACT,
    "partitioned_legs": oracle.BEST_LEGS,
    "lookup_route": oracle.where(oracle.Q24, "origin = 'NATION_1' AND dest = 'NATION_2'"),
    "lookup_trip": oracle.where(oracle.Q3, "date1 = DATE '1998-01-01' AND origin = 'NATION_11' "
                                "AND dest1 = 'NATION_22' AND dest2 = 'NATION_12'"),
    "lookup_many": oracle.where(
        oracle.ranked_sql(oracle.Q21, ["origin", "unique_carrier", "delay", "n_flights"],
                          "delay, unique_carrier", ["origin"], 10),
        "origin IN ('NATION_0', 'NATION_5', 'NATION_10', 'NATION_15', 'NATION_20')"),
    "stream_q1_1_update": oracle.Q11,
    "stream_q1_2_update": oracle.Q12,
    "stream_q1_2_complete": oracle.Q12,
    "stream_q1_3_update": oracle.Q13,
    "stream_q2_1_update": oracle.Q21,
    "stream_q2_2_complete": oracle.Q22,
    "stream_q2_3_update": oracle.Q23,
    "sink_upsert_latest": oracle.Q24,
    "stream_all_questions": oracle.long_sql(),
    "stream_best_leg": oracle.BEST_LEGS,
    "stream_q3_two_leg_trips": oracle.Q3,
    "stream_late_data": oracle.late_legs_sql(),
    "stream_undated": oracle.Q11,
    "stream_late_flights": oracle.late_flights_sql(),
    "stream_clean_files": oracle.Q22,
    "batch_all_questions": oracle.long_sql(),
}
