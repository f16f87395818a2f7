"""What several operators share: reading tables, words, intermediate tables."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import scratch_dir

# ASCII white space, and a word between it.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Spark's setting that a statement's shuffle files are removed at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    """The text, null counted as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of Parquet, and a
    frame used twice is computed once.  The shuffle files of the write go with
    it (nothing reads them again), so that disk holds those of one step only.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch between the JVM and Python holds, in rows and in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def kept_by_worker(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once by each Python worker and kept over its tasks.

    Functions travel with the job by value, so each task has module globals of
    its own; ``sys.modules`` is the worker's.  One value is kept under a name's
    first word, the last one, so that a worker holds a bounded number of them.
    """
    held = sys.modules.setdefault("_tarmac_kept", ModuleType("_tarmac_kept")).__dict__
    kind = name.split()[0]
    if held.get(kind, (None,))[0] != name:
        held[kind] = (name, make())
    return held[kind][1]


def free_name(wanted: str, taken: list[str]) -> str:
    """A column name that no column of ``taken`` has (names compare without case)."""
    low, name = {t.lower() for t in taken}, wanted
    while name.lower() in low:
        name = f"_{name}"
    return name
