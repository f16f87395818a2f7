"""One base aggregate behind questions q1.1 to q2.4.

All seven group flights by some of origin, destination, carrier and weekday,
and take counts and means.  So one pass over the flights, grouped by all
four, with sums and counts of both delays, holds the answers of all: its rows
number the combinations that occur, whatever the number of flights, and they
merge by adding.  Each answer is an aggregation of that table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import weekday_name
from tarmac.operators.curate import present
from tarmac.plans.questions import QUESTIONS
from tarmac.schema import result_key

BASE_KEYS = ["origin", "dest", "unique_carrier", "day_of_week"]
MEASURES = ["arr_delay", "dep_delay"]
SUMS = ["n_flights", *[f"{p}_{m}" for m in MEASURES for p in ("sum", "n")]]
#: Questions that the base aggregate answers.
COVERED = ["q1.1", "q1.2", "q1.3", "q2.1", "q2.2", "q2.3", "q2.4"]
LONG_KEYS = ["question", "key1", "key2", "key3"]


def base_aggregate(flights: DataFrame) -> DataFrame:
    """Flights, and sums and numbers of their known delays, by BASE_KEYS (null is a key)."""
    sums = [x for m in MEASURES for x in (F.sum(m).alias(f"sum_{m}"), F.count(m).alias(f"n_{m}"))]
    return flights.select(*BASE_KEYS, *MEASURES).groupBy(*BASE_KEYS).agg(
        F.count(F.lit(1)).alias("n_flights"), *sums)


def merge_base(bases: DataFrame) -> DataFrame:
    """Base rows of several loads or micro-batches -> one row per key."""
    return bases.groupBy(*BASE_KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])


def _parts(base: DataFrame, name: str) -> list:
    """What a base row adds to a question: structs of its key, a sum and a number; null if nothing."""
    q = QUESTIONS[name]
    text = [c for c in q.required if c in BASE_KEYS and c != "day_of_week"]
    there = reduce(lambda a, b: a & b, [present(base, c) for c in text], F.lit(True))
    if name == "q1.1":
        none = F.lit(None).cast(base.schema["sum_arr_delay"].dataType)
        return [F.when(there, F.struct(F.array(F.col(end)).alias("key"), none.alias("total"),
                                       F.col("n_flights").alias("n"))) for end in ("origin", "dest")]
    keys = [weekday_name("day_of_week") if k == "weekday" else F.col(k) for k in result_key(name)]
    there = there & (F.col(f"n_{q.measure}") > 0)
    if name == "q1.3":
        there = there & keys[0].isNotNull()
    return [F.when(there, F.struct(F.array(*keys).alias("key"), F.col(f"sum_{q.measure}").alias("total"),
                                   F.col(f"n_{q.measure}").alias("n")))]


def totals(base: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The questions' sums in one, from one plan: LONG_KEYS, total (null: a count) and n_flights.

    Each base row is handed to every question at once and all are summed in
    one aggregation, so a base read from flights costs one scan of them.
    """
    each = []
    for name in names or COVERED:
        for part in _parts(base, name):
            key = lambda i: F.get(part["key"], i)  # noqa: E731,B023
            each.append(F.when(part.isNotNull(), F.struct(
                F.lit(name).alias("question"), key(0).alias("key1"), key(1).alias("key2"), key(2).alias("key3"),
                part["total"].alias("total"), part["n"].alias("n"))))
    rows = base.select(F.explode(F.array(*each)).alias("r")).filter("r is not null").select("r.*")
    return rows.groupBy(*LONG_KEYS).agg(F.sum("total").alias("total"), F.sum("n").alias("n_flights"))


def answers(base: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The questions' result tables in one: LONG_KEYS, delay (null: a count) and n_flights."""
    return totals(base, names).select(
        *LONG_KEYS, (F.col("total") / F.col("n_flights")).alias("delay"), "n_flights")


def exact_answers(flights: DataFrame, names: list[str] | None = None, digits: int = 3) -> DataFrame:
    """As ``answers``, with delay as a decimal that does not hang on the order of summation.

    Delays are added as decimals of ``digits`` places, and the mean is rounded
    once, from the whole quotient, halves away from zero.
    """
    exact = {m: F.col(m).cast(f"decimal(18,{digits})") for m in MEASURES}
    sums = totals(base_aggregate(flights.withColumns(exact)), names)
    units = (F.col("total") * F.lit(10 ** digits)).cast("decimal(38,0)")
    half_up = F.expr("(2 * abs(units) + n_flights) div (2 * n_flights)")
    mean = F.when(F.col("units") < 0, -half_up).otherwise(half_up)
    return sums.withColumn("units", units).select(
        *LONG_KEYS, (mean.cast("decimal(38,0)") / F.lit(10 ** digits)).cast(f"decimal(18,{digits})").alias("delay"),
        "n_flights")


def answer_from_base(base: DataFrame, name: str) -> DataFrame:
    """The full result table of one question."""
    long = answers(base, [name])
    keys = [F.col(f"key{i + 1}").alias(k) for i, k in enumerate(result_key(name))]
    if name == "q1.1":
        return long.select(*keys, F.col("n_flights").alias("cnt"))
    return long.select(*keys, "delay", "n_flights")
