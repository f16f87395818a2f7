"""Counts and means by key.

Everything is a plain ``groupBy().agg()`` so Spark plans partial
aggregation before the shuffle (the reference's combiner) and a final
aggregation after it.  A hot key therefore costs one partial row per
map task, not a third of the input in one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def airport_popularity(flights: DataFrame) -> DataFrame:
    """Flights to or from each airport; a flight with origin = dest counts twice."""
    return (flights
            .select(F.explode(F.array("origin", "dest")).alias("airport"))
            .groupBy("airport")
            .agg(F.count(F.lit(1)).alias("cnt")))


def mean_by(df: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Mean of ``measure`` per key, with the count beside it (mergeable)."""
    return (df.groupBy(*keys)
              .agg(F.avg(measure).alias("delay"),
                   F.count(F.lit(1)).alias("n_flights")))


def partial_means(df: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Mergeable partial state per key: exact sum and count of ``measure``."""
    return (df.groupBy(*keys)
              .agg(F.sum(measure).alias("sum_delay"), F.count(F.lit(1)).alias("n_flights")))


def merge_means(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Merge partial (sum_delay, n_flights) tables into one mean per key.

    ``partials`` may hold several rows per key (e.g. one per monthly load);
    the result equals the mean over all underlying flights, since the
    state carried is the sum, not the rounded mean.
    """
    return (partials.groupBy(*keys)
            .agg(F.sum("sum_delay").alias("_s"), F.sum("n_flights").alias("n_flights"))
            .select(*keys, (F.col("_s") / F.col("n_flights")).alias("delay"), "n_flights"))
