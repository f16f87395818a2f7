"""File-set selection and the year extract.

The questions read every year; the trip question of the reference reads
one year.  On the curated table a year is a partition directory, so the
filter prunes directories before any file is opened (``PartitionFilters``
in the plan).  The year extract feeds the streaming questions, which must
see flights in date order: it is a range-partitioned sort, so a year is
sorted by many tasks at once and a busy date is split by the tie-break
columns instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tarmac.sources.curated import read_flights

# Total order of the extract: date first, then a tie-break that makes it stable.
SORT_ORDER = ["flight_date", "crs_dep_time", "unique_carrier", "flight_num", "origin", "dest"]


def flights_of_years(spark, curated_path: str, years: list[int]) -> DataFrame:
    """Curated flights of the given years (partition pruning)."""
    return read_flights(spark, curated_path, years).drop("year")


def year_sorted(spark, curated_path: str, year: int) -> DataFrame:
    """Flights of one year in date order (stable, total order); other years' directories are skipped."""
    return (flights_of_years(spark, curated_path, [year])
            .repartitionByRange(*SORT_ORDER)
            .sortWithinPartitions(*SORT_ORDER))
