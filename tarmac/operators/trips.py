"""Two-leg trips: X -> Y in the morning of day d, Y -> Z in the afternoon
of day d + 2, least total arrival delay for every (d, X, Y, Z).

Plan (per side: one aggregation shuffle, one join shuffle; no cartesian
product):

1. ``best_legs`` — one row per (date, period, origin, dest): the flight of
   least arrival delay, as ``min(struct(...))``.  Partial aggregation runs
   before the shuffle, so a hub or a busy day is pre-reduced in every map
   task and each key leaves at most one row per task.
2. ``two_leg_trips`` — every leg gets its stop-over key: the airport and
   date where the traveller changes planes (first leg: its destination and
   date + offset; second leg: its origin and date), and the two periods are
   equi-joined on it.  With ``both_periods`` the two sides hold the same
   aggregation, so flights are scanned and aggregated once and the exchange
   is reused.  After step 1 a stop-over key has at most one first leg per
   origin airport and one second leg per destination airport, so the join
   input per key is bounded by the number of airports whatever the raw skew
   was; its output is exactly the result rows.  AQE turns the join into a
   broadcast join when a side is measured small, and splits skewed join
   partitions otherwise.  Several offsets are one join, too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import AFTERNOON, MORNING, leg_label
from tarmac.operators.curate import require, with_period

# Columns a flight needs to take part in the trip question.
TRIP_REQUIRED = ["flight_date", "origin", "dest", "arr_delay", "crs_dep_time",
                 "unique_carrier", "flight_num"]


def best_legs(flights: DataFrame) -> DataFrame:
    """Least-delay flight per (flight_date, period, origin, dest).

    Ties on the delay go to the earlier departure, then carrier, then
    flight number (deterministic, unlike first-seen).
    """
    legs = with_period(require(flights.select(*TRIP_REQUIRED), TRIP_REQUIRED))
    best = F.min(F.struct("arr_delay", "minute_of_day", "unique_carrier", "flight_num",
                          "crs_dep_time")).alias("best")
    return (legs.groupBy("flight_date", "period", "origin", "dest").agg(best)
            .select("flight_date", "period", "origin", "dest",
                    F.col("best.arr_delay").alias("arr_delay"),
                    F.col("best.crs_dep_time").alias("crs_dep_time"),
                    F.col("best.unique_carrier").alias("unique_carrier"),
                    F.col("best.flight_num").alias("flight_num")))


def both_periods(flights: DataFrame, first: str = MORNING, second: str = AFTERNOON) -> DataFrame:
    """Best legs of two periods, found in one aggregation: one row per (flight_date, origin, dest, period).

    The period is a column of the output, not a key of the aggregation, so a
    filter on it stays above: both sides of a trip join then hold the same
    aggregation, which Spark runs once and reuses.
    """
    legs = with_period(require(flights.select(*TRIP_REQUIRED), TRIP_REQUIRED))
    leg = F.struct("arr_delay", "minute_of_day", "unique_carrier", "flight_num", "crs_dep_time")
    best = legs.groupBy("flight_date", "origin", "dest").agg(
        *[F.min(F.when(F.col("period") == p, leg)).alias(p) for p in (first, second)])
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("period"), F.col(p).alias("best")) for p in (first, second)]))
    return (best.select("flight_date", "origin", "dest", each.alias("leg")).filter("leg.best is not null")
            .select("flight_date", "origin", "dest", F.col("leg.period").alias("period"),
                    *[F.col(f"leg.best.{c}").alias(c)
                      for c in ("arr_delay", "crs_dep_time", "unique_carrier", "flight_num")]))


def two_leg_trips(legs: DataFrame, offset_days: int = 2, first: str = MORNING,
                  second: str = AFTERNOON) -> DataFrame:
    """Join best first legs of day d with best second legs of day d + offset.

    Output (result table q3): date1, origin, dest1, dest2, total_delay,
    datetime1, flight1, datetime2, flight2.
    """
    return trips_of_offsets(legs, [offset_days], first, second).drop("offset_days")


def trips_of_offsets(legs: DataFrame, offsets: list[int], first: str = MORNING,
                     second: str = AFTERNOON) -> DataFrame:
    """Trips of several offsets in one equi-join; ``offset_days`` tells them apart.

    A first leg is given a stop-over date for each offset, so legs are found
    and second legs shuffled once, however many offsets are asked for.
    """
    if first == second:
        raise ValueError("first and second period must differ")
    if len(set(offsets)) != len(offsets):
        raise ValueError(f"offsets must differ: {offsets}")
    a = (legs.filter(F.col("period") == F.lit(first))
         .withColumn("offset_days", F.explode(F.array(*[F.lit(int(d)) for d in offsets])))
         .withColumn("stop_date", F.date_add("flight_date", F.col("offset_days")))).alias("a")
    b = legs.filter(F.col("period") == F.lit(second)).alias("b")
    joined = a.join(b, (F.col("a.dest") == F.col("b.origin")) & (F.col("a.stop_date") == F.col("b.flight_date")))
    return joined.select(
        F.col("a.flight_date").alias("date1"),
        F.col("a.origin").alias("origin"),
        F.col("a.dest").alias("dest1"),
        F.col("b.dest").alias("dest2"),
        (F.col("a.arr_delay") + F.col("b.arr_delay")).alias("total_delay"),
        leg_label(F.col("a.flight_date").cast("string"), F.col("a.crs_dep_time")).alias("datetime1"),
        leg_label(F.col("a.unique_carrier"), F.col("a.flight_num")).alias("flight1"),
        leg_label(F.col("b.flight_date").cast("string"), F.col("b.crs_dep_time")).alias("datetime2"),
        leg_label(F.col("b.unique_carrier"), F.col("b.flight_num")).alias("flight2"),
        F.col("a.offset_days").alias("offset_days"),
    )
