"""Result tables stored for lookups by key.

Rows are dealt to buckets by the first lookup column and sorted by all of
them, with Parquet bloom filters on the text ones.  A lookup then opens one
bucket (several for many keys), and within it row-group statistics and bloom
filters skip what cannot match.  Spark prunes buckets of tables only, so a
reader opens the folder as a table of its session; the layout is kept beside
the data and the folder can be opened from any session.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tarmac.streaming.files import read_text, write_text

BUCKETS = 16


def _name(path: str) -> str:
    return "tarmac_lookup_" + "".join(c if c.isalnum() else "_" for c in path.rstrip("/").lower())[-90:]


def _quoted(columns: list[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def write_lookup(result: DataFrame, path: str, keys: list[str], sort_by: str | None = None,
                 buckets: int = BUCKETS) -> str:
    """Store ``result`` for lookups by ``keys``; returns ``path``."""
    spark, name = result.sparkSession, _name(path)
    order = list(dict.fromkeys([*keys, *([sort_by] if sort_by else [])]))
    # a task writes one file for each bucket it holds rows of; by key and a spread of the rest, a hot
    # first key is not one task
    rest = [c for c in order[1:] if c in result.columns]
    spread = F.pmod(F.xxhash64(*rest), F.lit(4)) if rest else F.lit(0)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = (result.repartition(F.col(keys[0]), spread).write.mode("overwrite").format("parquet")
              .bucketBy(buckets, keys[0]).sortBy(*order).option("path", path))
    for k in keys:
        if isinstance(result.schema[k].dataType, StringType):
            writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
    writer.saveAsTable(name)
    write_text(spark, f"{path.rstrip('/')}-layout.json", json.dumps(
        {"schema": result.schema.jsonValue(), "keys": keys, "order": order, "buckets": buckets}))
    return path


def open_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A stored table, as a table of this session that knows its buckets."""
    name, layout = _name(path), json.loads(read_text(spark, f"{path.rstrip('/')}-layout.json"))
    schema = StructType.fromJson(layout["schema"])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}' "
                  f"CLUSTERED BY (`{layout['keys'][0]}`) SORTED BY ({_quoted(layout['order'])}) "
                  f"INTO {layout['buckets']} BUCKETS")
    return spark.table(name)
