"""Lookups over result tables: one key, or many keys in one job.

A lookup is a filter on the key columns (pushed to the Parquet scan of a
stored result table).  Many lookups are one semi join with the table of
requested keys instead of one job per key; how it is run is left to the
planner, which knows both sides' sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.plans.questions import QUESTIONS

def lookup(result: DataFrame, **key_values) -> DataFrame:
    """Rows of ``result`` whose columns equal the given values."""
    if not key_values:
        return result
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in key_values.items()])
    return result.filter(cond)


def lookup_question(result: DataFrame, question: str, *values, **params) -> DataFrame:
    """Lookup with the catalog's parameters; missing values take the catalog defaults."""
    q = QUESTIONS[question]
    unknown = set(params) - set(q.params)
    if unknown or len(values) > len(q.params):
        raise ValueError(f"{question} takes {q.params}; not {sorted(unknown) or list(values)}")
    merged = dict(zip(q.params, q.defaults))
    merged.update(zip(q.params, values))
    merged.update(params)
    return lookup(result, **{k: merged[k] for k in q.params})


def keys_frame(spark: SparkSession, key_cols: list[str], keys: list[tuple]) -> DataFrame:
    schema = ", ".join(f"{c} string" for c in key_cols)
    return spark.createDataFrame([tuple(str(v) for v in k) for k in keys], schema)


def lookup_many(result: DataFrame, key_cols: list[str], keys: list[tuple]) -> DataFrame:
    """All rows of ``result`` for a list of keys, in one join.

    The output carries every requested key; keys without rows are absent
    (inner join), as in a point lookup that finds nothing.
    """
    wanted = keys_frame(result.sparkSession, key_cols, keys).dropDuplicates()
    typed = wanted.select(*[F.col(c).cast(result.schema[c].dataType).alias(c) for c in key_cols])
    return result.join(typed, key_cols, "left_semi").select(*result.columns)
