"""How fast a stream is fed: its trigger and the size of a micro-batch.

``available_now`` works through what is there in bounded micro-batches and
ends; an interval ("10 seconds") starts a micro-batch that often until the
query is stopped.  ``max_files`` and ``max_bytes`` bound a micro-batch, so an
interval and a bound together are a rate limit: at most ``max_bytes`` an
interval, however much lies in the folder.  The bounds hold for every
trigger; without them a micro-batch takes all that is new.

``state_partitions`` sets over how many partitions a query's state is dealt.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamReader, DataStreamWriter


@dataclass(frozen=True)
class Pace:
    interval: str | None = None
    available_now: bool = False
    max_files: int | None = None
    max_bytes: int | str | None = None

    def __post_init__(self):
        if self.interval and self.available_now:
            raise ValueError("a stream has an interval or ends with what is there, not both")
        if self.max_files is not None and self.max_bytes is not None:
            raise ValueError("a micro-batch is bounded by files or by bytes, not both")

    def reader(self, reader: DataStreamReader) -> DataStreamReader:
        if self.max_files is not None:
            reader = reader.option("maxFilesPerTrigger", int(self.max_files))
        if self.max_bytes is not None:
            reader = reader.option("maxBytesPerTrigger", str(self.max_bytes))
        return reader

    def writer(self, writer: DataStreamWriter) -> DataStreamWriter:
        if self.available_now:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=self.interval) if self.interval else writer


AS_IT_COMES = Pace()

PARTITIONS = "spark.sql.shuffle.partitions"
#: Bytes of input that one partition of an event-time state should take in at once.
STATE_BYTES = 8_000_000


@contextmanager
def state_partitions(spark: SparkSession, at_once: int = 0) -> Iterator[None]:
    """Queries started inside deal their state to one partition a core, or more for much input at once.

    Each micro-batch opens and commits a state store for each partition and
    stateful operator, so partitions beyond the cores cost time and hold next
    to nothing, unless their state is large: ``at_once`` is the size in bytes
    of the largest micro-batch whose rows all stay in the state.  A query takes
    its settings when it starts, and one that goes on from a checkpoint keeps
    the number that it began with.
    """
    asked = spark.conf.get(PARTITIONS)
    n = max(min(int(asked), spark.sparkContext.defaultParallelism), -(-at_once // STATE_BYTES), 1)
    spark.conf.set(PARTITIONS, str(n))
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, asked)
