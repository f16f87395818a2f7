"""Rankings: global top-k and top-k inside each key.

Ties are broken by the listed tie-break columns ascending, so results are
deterministic.  ``top_k`` plans as ``TakeOrderedAndProject`` (each task
keeps k rows, the driver merges k per task); ``top_k_per_key`` plans as a
``row_number`` window whose ``rank <= k`` filter Spark turns into a
``WindowGroupLimit`` before and after the shuffle, so a key with many
rows never moves more than k of them per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(by: list[str], descending: bool, tiebreak: list[str]) -> list[Column]:
    main = [F.col(c).desc() if descending else F.col(c).asc() for c in by]
    return main + [F.col(c).asc() for c in tiebreak]


def top_k(df: DataFrame, by: list[str], k: int, descending: bool = False,
          tiebreak: list[str] | None = None) -> DataFrame:
    """The k first rows in order of ``by``, ranked 1..k in column ``rank``."""
    order = _order(by, descending, tiebreak or [])
    return ranked_within(df.orderBy(*order).limit(k), [], by, descending, tiebreak or [])


def ranked_within(df: DataFrame, keys: list[str], by: list[str], descending: bool = False,
                  tiebreak: list[str] | None = None) -> DataFrame:
    """Add ``rank`` (1 = best) inside each key."""
    w = Window.partitionBy(*keys).orderBy(*_order(by, descending, tiebreak or []))
    return df.withColumn("rank", F.row_number().over(w))


def top_k_per_key(df: DataFrame, keys: list[str], by: list[str], k: int,
                  descending: bool = False, tiebreak: list[str] | None = None) -> DataFrame:
    """The k best rows of each key, with their ``rank``."""
    return ranked_within(df, keys, by, descending, tiebreak).filter(F.col("rank") <= k)
