"""Table writers: the curated flight table and the keyed result tables.

The curated table is what every question reads: Parquet, partitioned by
``year`` (so a one-year question prunes whole directories, as a
file-name glob on the year would) and sorted on ``flight_date`` inside
each file (so row-group min/max statistics prune date filters).
Result tables are clustered by key and, inside a key, by the ranking
column, so a point lookup reads one small range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.schema import FLIGHT_COLUMNS


def write_flights(flights: DataFrame, path: str) -> str:
    """Write the curated flight table (overwrite).  Returns ``path``.

    No shuffle: each task sorts its own rows by (year, flight_date) and
    writes one date-ordered file per year it holds, so row-group min/max
    statistics prune date filters and a hot date or year cannot pile up
    in one writer.
    """
    (flights.select(*FLIGHT_COLUMNS)
     .withColumn("year", F.year("flight_date"))
     .sortWithinPartitions("year", "flight_date")
     .write.mode("overwrite").partitionBy("year").parquet(path))
    return path


def write_result(result: DataFrame, path: str, keys: list[str], sort_by: str | None = None,
                 partition_by: list[str] | None = None) -> str:
    """Write one result table, clustered by key (and ranking column inside a key).

    Ranges are over the whole order, so a first key that holds a third of the
    rows is spread over several files, each a stretch of its order.
    """
    order = list(keys[:1]) + ([sort_by] if sort_by else []) + list(keys[1:])
    writer = (result.repartitionByRange(*order) if order else result)
    writer = writer.sortWithinPartitions(*order) if order else writer
    w = writer.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> str:
    """One directory per value of ``by`` (the key leaves the rows).

    Rows are dealt by ``by`` with a ``REBALANCE`` hint: from the measured sizes,
    adaptive execution puts small directories together in one task, a file
    each, and splits a directory of more than
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` over several tasks and
    files, so one hot date holds no task up.
    """
    (df.hint("rebalance", *[F.col(b) for b in by])
     .write.mode("overwrite").partitionBy(*by).parquet(path))
    return path
