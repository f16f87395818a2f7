"""Row-quality rules (they are semantics, not hygiene).

* a question only sees rows whose *requested* columns are all present
  (NULL or blank text drops the row) — each question has its own set, so
  q1.1 keeps cancelled flights while the delay questions drop them;
* streaming q3 needs every field of the row;
* a departure time that does not parse drops the row from the trip
  question only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.columns import day_period, minute_of_day


def present(df: DataFrame, name: str) -> Column:
    """NOT NULL, and for text also not blank."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return c.isNotNull() & (F.trim(c) != F.lit(""))
    return c.isNotNull()


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep rows whose listed columns are all present (pushed to the scan)."""
    if not columns:
        return df
    return df.filter(reduce(lambda a, b: a & b, [present(df, c) for c in columns]))


def complete_rows(df: DataFrame) -> DataFrame:
    """Keep rows where every column is present."""
    return require(df, df.columns)


def with_period(df: DataFrame, time_col: str = "crs_dep_time") -> DataFrame:
    """Add ``minute_of_day`` and ``period`` (AM/PM); drop rows whose time does not parse."""
    return (df.withColumn("minute_of_day", minute_of_day(time_col))
              .filter(F.col("minute_of_day").isNotNull())
              .withColumn("period", day_period("minute_of_day")))


def quality_counts(df: DataFrame, columns: list[str], faults: str | None = None,
                   corrupt: str | None = None) -> DataFrame:
    """One row: total rows and, per column, rows where it is missing.

    With ``faults`` (see ``curate_raw``), a field that is there but cannot be
    read is not missing: it counts in ``unparsable_<column>``.  With ``corrupt``
    (see ``read_raw``), ``corrupt_lines`` counts the lines with a wrong number of
    fields.  A single aggregate pass (partial + final), so it is cheap at any scale.
    """
    count = lambda cond, name: F.count(F.when(cond, 1)).alias(name)
    bad = lambda c: F.exists(faults, lambda f: f["column"] == c) if faults else F.lit(False)
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [count(~present(df, c) & ~bad(c), f"missing_{c}") for c in columns]
    aggs += [count(bad(c), f"unparsable_{c}") for c in columns if faults]
    aggs += [count(F.col(corrupt).isNotNull(), "corrupt_lines")] if corrupt else []
    return df.agg(*aggs)
