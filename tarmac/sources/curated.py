"""Reading the curated flight table, and the per-session table cache.

``curated_flights(spark, sf_dir)`` turns the test tables into the curated
table once per session and data directory (a Spark job writing Parquet
under the shared checkpoint folder), then every question reads that
table.  This cuts the lineage of the fixture joins: a lost executor
costs a re-read of Parquet, not a re-run of four joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schema import FLIGHT_COLUMNS
from tarmac.session import scratch_dir
from tarmac.sinks.tables import write_flights
from tarmac.sources.testdata import flights_from_tables

_CURATED: dict[tuple[str, str, tuple], str] = {}


def read_flights(spark: SparkSession, path: str, years: list[int] | None = None) -> DataFrame:
    """The curated table; ``years`` prunes partitions (directories are skipped)."""
    df = spark.read.parquet(path)
    if years:
        df = df.filter(F.col("year").isin(*years))
    return df.select(*FLIGHT_COLUMNS, "year")


def _signature(spark: SparkSession, sf_dir: str) -> tuple:
    """Sizes and times of the tables, from whatever file system they lie on."""
    sig = []
    for name in ("lineitem", "orders", "customer", "supplier", "part", "nation"):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        sig.append((name, fs.getContentSummary(path).getLength(),
                    fs.getFileStatus(path).getModificationTime()))
    return tuple(sig)


def curated_flights_path(spark: SparkSession, sf_dir: str) -> str:
    """Path of the curated table for the test tables under ``sf_dir`` (built once per session)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _signature(spark, sf_dir))
    path = _CURATED.get(key)
    if path is None:
        path = write_flights(flights_from_tables(spark, sf_dir), scratch_dir(spark, "flights"))
        _CURATED[key] = path
    return path


def curated_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated flights for the test tables under ``sf_dir``."""
    return read_flights(spark, curated_flights_path(spark, sf_dir)).drop("year")
