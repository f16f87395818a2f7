"""Streaming sinks: keyed tables that live for months.

A table's rows are dealt to a fixed number of buckets by a hash of the key.
A micro-batch rewrites only the buckets that its keys touch, as
``data/v=<batchId>/_bucket=<b>``, and then commits a manifest
(``manifest/<batchId>.json``: the version of each bucket, and the schema) by
writing it aside and renaming it.  Readers follow the newest manifest, so a
micro-batch is seen whole or not at all.  A replayed batch starts from the
newest manifest before its own and rewrites the same version: idempotent per
``batchId``.

The last ``KEEP`` manifests stay; versions that none of them names are
removed after the commit.  So a table holds at most its buckets' versions
plus a few, and the listings stay that short, after any number of batches.

``merge`` is the general form: ``combine(old, new)`` gives the touched
buckets' new rows.  ``upsert`` replaces rows of the same key, ``replace``
takes the batch as the whole table (complete output).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarmac.streaming.files import names, read_text, remove, write_text

BUCKETS = 16
#: Manifests kept: the newest, and what a replay of its batch starts from.
KEEP = 2
BUCKET = "_bucket"


def versions(spark: SparkSession, table_dir: str) -> list[int]:
    """Batch ids of the manifests that are kept, ascending."""
    return sorted(int(n[:-5]) for n in names(spark, f"{table_dir}/manifest") if n.endswith(".json"))


def _manifest(spark: SparkSession, table_dir: str, version: int) -> dict:
    return json.loads(read_text(spark, f"{table_dir}/manifest/{version}.json"))


def _commit(spark: SparkSession, table_dir: str, batch_id: int, schema: StructType, buckets: dict[str, int]) -> None:
    write_text(spark, f"{table_dir}/manifest/{batch_id}.json",
               json.dumps({"schema": schema.jsonValue(), "buckets": buckets}))
    _sweep(spark, table_dir, batch_id)


def _sweep(spark: SparkSession, table_dir: str, batch_id: int) -> None:
    """Remove manifests before the last ``KEEP``, and versions that the kept ones do not name."""
    known = [v for v in versions(spark, table_dir) if v <= batch_id]
    kept, old = known[-KEEP:], known[:-KEEP]
    named = {f"v={v}" for k in kept for v in _manifest(spark, table_dir, k)["buckets"].values()}
    for v in old:
        remove(spark, f"{table_dir}/manifest/{v}.json")
    for name in names(spark, f"{table_dir}/data"):
        if name not in named:
            remove(spark, f"{table_dir}/data/{name}")


def _rows(spark: SparkSession, table_dir: str, schema: StructType, buckets: dict[str, int]) -> DataFrame:
    paths = [f"{table_dir}/data/v={v}/{BUCKET}={b}" for b, v in buckets.items()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, table_dir: str, schema: StructType | None = None) -> DataFrame:
    """The newest version of a sink table (an empty frame of ``schema`` when there is none)."""
    known = versions(spark, table_dir)
    if not known:
        if schema is None:
            raise FileNotFoundError(table_dir)
        return spark.createDataFrame([], schema)
    found = _manifest(spark, table_dir, known[-1])
    return _rows(spark, table_dir, StructType.fromJson(found["schema"]), found["buckets"])


def _write(rows: DataFrame, table_dir: str, batch_id: int) -> None:
    # a bucket is one task and one file; buckets are as many as the table's size asks for
    rows.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{table_dir}/data/v={batch_id}")


def merge(batch: DataFrame, batch_id: int, table_dir: str, keys: list[str],
          combine: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = BUCKETS) -> None:
    """Put ``combine(old rows, batch)`` in place of the buckets that the batch's keys touch."""
    spark = batch.sparkSession
    at = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    touched = sorted(r[0] for r in batch.select(at.alias("b")).distinct().collect())  # at most ``buckets`` rows
    prior = [v for v in versions(spark, table_dir) if v < batch_id]
    held = _manifest(spark, table_dir, prior[-1])["buckets"] if prior else {}
    if touched:
        old = _rows(spark, table_dir, batch.schema, {str(b): held[str(b)] for b in touched if str(b) in held})
        _write(combine(old, batch).withColumn(BUCKET, at), table_dir, batch_id)
    _commit(spark, table_dir, batch_id, batch.schema, {**held, **{str(b): batch_id for b in touched}})


def upsert(batch: DataFrame, batch_id: int, table_dir: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Later rows replace earlier rows of the same key (nulls equal)."""
    def newer(old: DataFrame, new: DataFrame) -> DataFrame:
        seen = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
        return old.join(seen, same, "left_anti").unionByName(new)
    merge(batch, batch_id, table_dir, keys, newer, buckets)


def replace(batch: DataFrame, batch_id: int, table_dir: str) -> None:
    """Complete output: the batch is the whole table."""
    _write(batch.withColumn(BUCKET, F.lit(0)), table_dir, batch_id)
    written = names(batch.sparkSession, f"{table_dir}/data/v={batch_id}")
    _commit(batch.sparkSession, table_dir, batch_id, batch.schema,
            {"0": batch_id} if f"{BUCKET}=0" in written else {})
