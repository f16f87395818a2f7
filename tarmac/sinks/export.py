"""Result tables as text files for readers outside Spark.

One folder per question, CSV with a header, delays as decimals with a fixed
number of places: the same flights give the same bytes of every value,
however they were split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.plans.base import LONG_KEYS, exact_answers

EXPORT_SCHEMA = "key1 string, key2 string, key3 string, delay string, n_flights long, question string"
CSV = {"header": True, "quote": '"', "escape": '"'}


def export_results(flights: DataFrame, path: str, names: list[str] | None = None, digits: int = 3) -> str:
    """Write the questions that the base aggregate covers (one scan of the flights); returns ``path``.

    A key or delay that a question has not is an empty field.
    """
    told = exact_answers(flights, names, digits).withColumn("delay", F.col("delay").cast("string"))
    (told.hint("rebalance", F.col("question")).sortWithinPartitions(*LONG_KEYS)
     .write.mode("overwrite").partitionBy("question").options(**CSV).csv(path))
    return path


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """The exported tables in one: question, key1 to key3, delay (text), n_flights."""
    return spark.read.schema(EXPORT_SCHEMA).options(**CSV).csv(path).select(*LONG_KEYS, "delay", "n_flights")
