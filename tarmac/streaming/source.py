"""Streaming input: flights as a file stream with an event time.

A stream reads a folder of clean or raw files, or the slices of a replay.
The event time ``ts`` is flight_date + scheduled departure (UTC).  ``Replay``
stages a bounded flight table as a sequence of slices (one Spark write for
all, which are then moved into the folder one by one) that a running query
picks up one after the other, and ends with a sentinel row far in the
future so every event-time window closes.  The sentinel never reaches a
result of an event-time question: its own window stays open.  Questions
without event time never see it (it is only staged for those with one).
"""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.columns import minute_of_day
from tarmac.schema import FLIGHTS, FLIGHT_COLUMNS, RAW, RAW_COLUMNS
from tarmac.sources.raw import CSV_OPTIONS, curate_clean, curate_raw, is_header, parse_clean
from tarmac.streaming.pace import AS_IT_COMES, Pace

STREAM_SCHEMA = T.StructType(FLIGHTS.fields + [
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("slice", T.StringType(), True),
])
#: What is staged: the event time follows from the other columns.
STAGED = T.StructType([f for f in STREAM_SCHEMA.fields if f.name != "ts"])
SENTINEL_DATE = dt.date(9999, 1, 1)
UNDATED = "undated"
#: Slices that a task of the staging pass writes side by side, and Spark's setting for it.
OPEN_FILES = 16
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Bytes of a staged row group: a micro-batch is cut between them, however few files a slice has.
GROUP_BYTES = 8_000_000


def with_event_time(flights: DataFrame) -> DataFrame:
    """Add ``ts``: flight_date + departure minute (2400 stays on its own date)."""
    m = F.least(F.coalesce(minute_of_day("crs_dep_time"), F.lit(0)), F.lit(1439))
    return flights.withColumn(
        "ts", F.timestamp_add("MINUTE", m, F.col("flight_date").cast("timestamp")))


def read_stream(spark: SparkSession, stage_dir: str, pace: Pace = AS_IT_COMES) -> DataFrame:
    """The slices of a ``Replay`` as a stream; the event time is taken on reading, by queries that ask for it."""
    reader = spark.readStream.schema(STAGED).format("parquet")
    # folders, not files: Spark lists more than a few paths by a job of a task each, for every look at the folder
    stream = pace.reader(reader).load(f"{stage_dir}/*")
    return with_event_time(stream).select(*STREAM_SCHEMA.fieldNames())


def _flights(stream: DataFrame) -> DataFrame:
    return with_event_time(stream).withColumn("slice", F.lit(None).cast("string"))


def _done_with(reader, archive_dir: str | None, delete: bool):
    if archive_dir and delete:
        raise ValueError("files that are done with are archived or deleted, not both")
    if archive_dir:
        return reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.option("cleanSource", "delete") if delete else reader


def read_clean_stream(spark: SparkSession, folder: str, pace: Pace = AS_IT_COMES, path_glob: str | None = None,
                      archive_dir: str | None = None, delete: bool = False) -> DataFrame:
    """A folder of ';' files, plain or gzip, as a stream of flights with event time.

    Files that come while the stream runs are read once each, oldest first;
    a file must be moved into the folder whole.  The query's checkpoint knows
    which files were read, so a stopped stream goes on where it was.  Files
    that are done with are moved below ``archive_dir`` or deleted, if asked.
    """
    reader = pace.reader(_done_with(spark.readStream.format("text"), archive_dir, delete))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return _flights(curate_clean(parse_clean(reader.load(folder))))


def read_raw_stream(spark: SparkSession, folder: str, pace: Pace = AS_IT_COMES, path_glob: str | None = None,
                    archive_dir: str | None = None, delete: bool = False) -> DataFrame:
    """A folder of raw on-time CSV files as a stream of flights with event time; else as ``read_clean_stream``."""
    reader = spark.readStream.schema(RAW).option("header", False).options(**CSV_OPTIONS)
    reader = pace.reader(_done_with(reader, archive_dir, delete))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return _flights(curate_raw(reader.csv(folder).filter(~is_header(F.col(RAW_COLUMNS[0])))))


class Replay:
    """Stage ``flights`` as ordered slices (years or months) for a file stream.

    Flights without a date are a slice of their own, the last one.  All slices
    are written beside the watched folder in one pass over the flights; each is
    then renamed into it, so a micro-batch sees a whole slice or none of it.  A folder that already
    holds slices is added to; with ``resume`` the slices it holds are not
    staged again, which continues a replay that was stopped.
    """

    def __init__(self, flights: DataFrame, stage_dir: str, slice_by: str = "year",
                 shuffled: bool = False, seed: int = 7, resume: bool = False):
        fmt = {"year": "yyyy", "month": "yyyy-MM"}[slice_by]
        name = F.coalesce(F.date_format("flight_date", fmt), F.lit(UNDATED))
        self.frame = flights.select(*FLIGHT_COLUMNS).withColumn("slice", name)
        self.stage_dir = stage_dir
        self.tmp_dir = stage_dir.rstrip("/") + "-incoming"
        # the slice keys are few (one per year or month): listing them on the driver is bounded
        dates = flights.select("flight_date").distinct()
        self.keys = sorted(r[0] for r in dates.select(name).distinct().collect())
        if shuffled:
            random.Random(seed).shuffle(self.keys)
        staged = self._staged()
        self._n = 1 + max((int(n.partition("-")[0]) for n in staged), default=-1)
        if resume:
            held = {n.partition("-")[2] for n in staged}
            if held.intersection(self.keys):
                self.keys = [k for k in self.keys if k not in held]
                self.frame = self.frame.filter(F.col("slice").isin(self.keys))
        self._aside: str | None = None

    def _staged(self) -> list[str]:
        """Names (number-slice) of the slices that the watched folder holds."""
        sc = self.frame.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.stage_dir)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _write(self, df: DataFrame, key: str) -> None:
        source = f"{self.tmp_dir}/{self._n:05d}-{key}"
        df.write.mode("overwrite").parquet(source)
        self._move(source, key)

    def _move(self, source: str, key: str) -> None:
        sc = self.frame.sparkSession.sparkContext
        src = sc._jvm.org.apache.hadoop.fs.Path(source)
        dst = sc._jvm.org.apache.hadoop.fs.Path(f"{self.stage_dir}/{self._n:05d}-{key}")
        fs = src.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(dst.getParent())
        if fs.exists(dst):
            raise FileExistsError(str(dst))
        if not fs.rename(src, dst):
            raise OSError(f"could not move {src} to {dst}")
        self._n += 1

    def stage(self) -> str:
        """Write all slices beside the watched folder, once: one pass, a directory for each.

        A task keeps a file open for each slice it meets; only rows of slices
        beyond ``OPEN_FILES`` are sorted, so the others are not held in memory.
        """
        if self._aside is None:
            path, conf = f"{self.tmp_dir}/slices-{self._n:05d}", self.frame.sparkSession.conf
            held = conf.get(WRITERS)
            conf.set(WRITERS, str(OPEN_FILES))
            try:
                (self.frame.withColumn("at", F.col("slice")).write.mode("overwrite")
                 .option("parquet.block.size", GROUP_BYTES).partitionBy("at").parquet(path))
            finally:
                conf.set(WRITERS, held)
            self._aside = path
        return self._aside

    def sizes(self) -> list[int]:
        """Bytes of each slice."""
        sc = self.frame.sparkSession.sparkContext
        paths = [sc._jvm.org.apache.hadoop.fs.Path(f"{self.stage()}/at={key}") for key in self.keys]
        conf = sc._jsc.hadoopConfiguration()
        return [p.getFileSystem(conf).getContentSummary(p).getLength() for p in paths]

    def write_slice(self, key: str) -> None:
        self._move(f"{self.stage()}/at={key}", key)

    def write_empty(self) -> None:
        """A slice without rows, so that a stream without flights has its (empty) result."""
        self._write(self.frame.limit(0), "empty")

    def write_sentinel(self) -> None:
        spark = self.frame.sparkSession
        # complete rows, so no filter of a question removes them before the watermark
        # node (Catalyst may push filters below it); their own day never closes, so it
        # never reaches a result; one morning and one afternoon row, so both
        # branches of a period split see it
        rows = [(SENTINEL_DATE, 1, "~", "~", "~", "~", hhmm, 0.0, 0.0,
                 "sentinel") for hhmm in ("0000", "1200")]
        self._write(spark.createDataFrame(rows, STAGED), "sentinel")
