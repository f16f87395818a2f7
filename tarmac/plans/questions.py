"""The question catalog and the batch plan of each question.

``QUESTIONS`` is the single declarative description of the eight
questions: text, request parameters with their defaults, required
columns, grouping keys, measure and ranking.  Batch jobs, streaming
queries and lookups are all driven from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import weekday_name
from tarmac.operators.aggregate import airport_popularity, mean_by
from tarmac.operators.curate import require
from tarmac.operators.ranking import ranked_within, top_k, top_k_per_key
from tarmac.operators.trips import TRIP_REQUIRED, both_periods, two_leg_trips


@dataclass(frozen=True)
class Question:
    text: str
    required: list[str]            # curated columns that must be present
    keys: list[str]                # result-table group key
    measure: str | None = None     # mean of this column (None: count / trips)
    params: list[str] = field(default_factory=list)  # lookup parameters
    defaults: list[str] = field(default_factory=list)
    sort_by: str | None = None     # ranking column
    descending: bool = False
    top: int | None = None         # k of the ranking (None: full ranking)
    rank_within: list[str] = field(default_factory=list)  # ranking inside these keys


# Parameter names and default codes of the question catalog.
QUESTIONS: dict[str, Question] = {
    "q1.1": Question("The ten busiest airports, counting departures and arrivals.",
                     ["origin", "dest"], ["airport"], None,
                     sort_by="cnt", descending=True, top=10),
    "q1.2": Question("The ten carriers with the least mean arrival delay.",
                     ["unique_carrier", "arr_delay"], ["unique_carrier"], "arr_delay",
                     sort_by="delay", top=10),
    "q1.3": Question("Weekdays in order of mean arrival delay.",
                     ["day_of_week", "arr_delay"], ["weekday"], "arr_delay",
                     sort_by="delay"),
    "q2.1": Question("Out of {origin}: the ten carriers with the least mean departure delay.",
                     ["origin", "unique_carrier", "dep_delay"], ["origin", "unique_carrier"],
                     "dep_delay", ["origin"], ["CMI"], sort_by="delay", top=10,
                     rank_within=["origin"]),
    "q2.2": Question("Out of {origin}: the ten destinations with the least mean departure delay.",
                     ["origin", "dest", "dep_delay"], ["origin", "dest"], "dep_delay",
                     ["origin"], ["CMI"], sort_by="delay", top=10, rank_within=["origin"]),
    "q2.3": Question("Between {origin} and {dest}: the ten carriers with the least mean arrival delay.",
                     ["origin", "dest", "unique_carrier", "arr_delay"],
                     ["origin", "dest", "unique_carrier"], "arr_delay",
                     ["origin", "dest"], ["CMI", "ORD"], sort_by="delay", top=10,
                     rank_within=["origin", "dest"]),
    "q2.4": Question("How late flights from {origin} reach {dest} in the mean.",
                     ["origin", "dest", "arr_delay"], ["origin", "dest"], "arr_delay",
                     ["origin", "dest"], ["CMI", "ORD"]),
    "q3": Question("Least delayed pair of flights: {origin} to {dest1} on {date1}, then on to {dest2} two days later.",
                   TRIP_REQUIRED, ["date1", "origin", "dest1", "dest2"], "arr_delay",
                   ["date1", "origin", "dest1", "dest2"], ["2008-03-04", "CMI", "ORD", "LAX"]),
}


def question_input(flights: DataFrame, name: str) -> DataFrame:
    """The rows and columns question ``name`` reads (pruned + filtered)."""
    q = QUESTIONS[name]
    df = require(flights.select(*q.required), q.required)
    if name == "q1.3":
        df = (df.withColumn("weekday", weekday_name("day_of_week"))
                .filter(F.col("weekday").isNotNull()))
    return df


def answer(flights: DataFrame, name: str, trip_offset_days: int = 2) -> DataFrame:
    """The full result table of one question (schema ``tarmac.schema.RESULTS``)."""
    q = QUESTIONS[name]
    if name == "q1.1":
        return airport_popularity(question_input(flights, name))
    if name == "q3":
        return two_leg_trips(both_periods(flights), offset_days=trip_offset_days)
    return mean_by(question_input(flights, name), q.keys, q.measure)


def ranking(result: DataFrame, name: str) -> DataFrame:
    """The ranking a reader of question ``name`` sees (top-k, per key or global)."""
    q = QUESTIONS[name]
    if q.sort_by is None:
        return result
    tiebreak = [k for k in q.keys if k not in q.rank_within]
    if q.rank_within:
        return top_k_per_key(result, q.rank_within, [q.sort_by], q.top, q.descending, tiebreak)
    if q.top is None:
        # full ranking (q1.3): its key has at most 7 values
        return ranked_within(result, [], [q.sort_by], q.descending, tiebreak)
    return top_k(result, [q.sort_by], q.top, q.descending, tiebreak)
