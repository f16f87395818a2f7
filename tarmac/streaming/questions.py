"""The questions as Structured Streaming queries.

q1.x / q2.x reuse the batch plan builders unchanged (``answer``): a
streaming ``groupBy().agg()`` keeps (sum, count) or count per key in the
state store, and ``update`` output emits the keys a micro-batch touched
(the reference's per-row emit) while ``complete`` output emits every key
(its end-of-input dump).  Both agree with the batch table at the end.

Trips run on event time: each leg's stop-over time (morning legs:
departure + 2 days; afternoon legs: departure) is watermarked, best legs
are daily ``window`` aggregates in append mode, and the two aggregates
are joined on (stop-over airport, window).  The window is an event-time
join key on both sides, so join state is dropped as the watermark
passes, and a day's trips are emitted once both of its leg days closed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import AFTERNOON, MORNING, day_period, leg_label, minute_of_day
from tarmac.operators.curate import require
from tarmac.operators.trips import TRIP_REQUIRED
from tarmac.plans.questions import answer

SENTINEL = "sentinel"
DEFAULT_WATERMARK = "1 hour"


def data_rows(stream: DataFrame) -> DataFrame:
    """Drop the replay sentinel (it only moves the watermark)."""
    return stream.filter(F.col("slice").isNull() | (F.col("slice") != F.lit(SENTINEL)))


def question_stream(stream: DataFrame, name: str) -> DataFrame:
    """Running result of q1.1 ... q2.4 over a flight stream."""
    if name == "q3":
        raise ValueError("q3 is an event-time question: use trips_stream")
    return answer(data_rows(stream), name)


def _best(df: DataFrame, time_col: str, keys: list[str]) -> DataFrame:
    best = F.min(F.struct("arr_delay", "minute_of_day", "unique_carrier", "flight_num",
                          "crs_dep_time")).alias("best")
    return (df.groupBy(F.window(time_col, "1 day").alias("window"), *keys).agg(best)
            .select("window", *keys,
                    F.col("best.arr_delay").alias("arr_delay"),
                    F.col("best.crs_dep_time").alias("crs_dep_time"),
                    F.col("best.unique_carrier").alias("unique_carrier"),
                    F.col("best.flight_num").alias("flight_num")))


def _timed(stream: DataFrame) -> DataFrame:
    return (stream.withColumn("minute_of_day", minute_of_day("crs_dep_time"))
            .withColumn("period", day_period("minute_of_day")))


def _trip_rows(df: DataFrame) -> DataFrame:
    # the sentinel is not filtered here: it must reach the watermark node, and its
    # window (year 9999) never closes, so it never leaves the aggregation state
    return require(df, TRIP_REQUIRED).filter(F.col("minute_of_day").isNotNull())


def best_legs_stream(stream: DataFrame, watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Best leg per (day, period, origin, dest); a day is emitted once the watermark passes it."""
    rows = _trip_rows(_timed(stream).withWatermark("ts", watermark))
    legs = _best(rows, "ts", ["flight_date", "period", "origin", "dest"])
    return legs.drop("window")


def trips_stream(stream: DataFrame, watermark: str = DEFAULT_WATERMARK,
                 offset_days: int = 2) -> DataFrame:
    """Best two-leg trips (result table q3) over a flight stream."""
    timed = _timed(stream)
    first = (timed.withColumn("stop_ts", F.col("ts") + F.expr(f"INTERVAL {int(offset_days)} DAYS"))
             .withWatermark("stop_ts", watermark))
    first = _trip_rows(first).filter(F.col("period") == F.lit(MORNING))
    second = timed.withColumn("stop_ts", F.col("ts")).withWatermark("stop_ts", watermark)
    second = _trip_rows(second).filter(F.col("period") == F.lit(AFTERNOON))
    a = _best(first, "stop_ts", ["flight_date", "origin", "dest"]).alias("a")
    b = _best(second, "stop_ts", ["flight_date", "origin", "dest"]).alias("b")
    joined = a.join(b, (F.col("a.dest") == F.col("b.origin"))
                    & (F.col("a.window") == F.col("b.window")))
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
    )
