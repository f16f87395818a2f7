"""Zip archives: a folder tree of ``.zip`` files -> raw flight rows, and back.

Reading is a Spark job in two steps.

1.  ``archive_members``: ``binaryFile`` gives one row per archive, and
    ``mapInPandas`` reads its central directory and cuts out each member's
    compressed bytes by their range, without inflating them.  ``.html``
    members and folders are left out.
2.  ``archive_lines``: members are dealt out evenly by measured bytes
    (``REBALANCE``), so a large archive is inflated by as many tasks as it has
    members.  Lines leave in batches of ``BATCH_LINES`` and checksums are
    verified; ``from_csv`` parses the lines with the raw schema.

Every row keeps the archive path and member name, so two archives of the same
base name in different folders never overwrite each other.

Limits: an archive is held by one task while it is cut, so it has at most 2 GB
(the limit of ``binaryFile``); a member is inflated by one task, as a stream.
An encrypted member, an unknown compression or a wrong checksum fails the job.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schema import RAW, RAW_COLUMNS
from tarmac.sources.raw import CSV_OPTIONS, is_header, raw_rows

BATCH_LINES = 50_000
# Archive members with these suffixes are not data.
SKIP_SUFFIXES = (".html", ".htm")
# A local header's size, and where the lengths of its two variable fields stand.
LOCAL_HEADER, NAME_LENGTH, EXTRA_LENGTH = 30, 26, 28
ENCRYPTED = 0x1

MEMBERS_SCHEMA = "source_file string, member string, method int, crc long, size long, body binary"
LINES_SCHEMA = "source_file string, member string, line string"


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as zf:
                infos = zf.infolist()
            for info in infos:
                if info.is_dir() or info.filename.lower().endswith(SKIP_SUFFIXES):
                    continue
                if info.flag_bits & ENCRYPTED:
                    raise ValueError(f"{path}: member {info.filename} is encrypted")
                at = info.header_offset
                skip = [int.from_bytes(content[at + p:at + p + 2], "little") for p in (NAME_LENGTH, EXTRA_LENGTH)]
                start = at + LOCAL_HEADER + sum(skip)
                yield pd.DataFrame({"source_file": [path], "member": [info.filename],
                                    "method": [info.compress_type], "crc": [info.CRC], "size": [info.file_size],
                                    "body": [content[start:start + info.compress_size]]})


def archive_members(spark: SparkSession, root: str, pattern: str = "*.zip") -> DataFrame:
    """One row per member, still compressed, of every archive under ``root`` whose name fits ``pattern``."""
    blobs = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true").load(root).select("path", "content"))
    return blobs.mapInPandas(_members, MEMBERS_SCHEMA)


def _lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            info = zipfile.ZipInfo(row.member)
            info.compress_type, info.CRC = row.method, row.crc
            info.file_size, info.compress_size = row.size, len(row.body)
            batch: list[str] = []
            with zipfile.ZipExtFile(io.BytesIO(row.body), "r", info) as inflated:
                for line in io.TextIOWrapper(inflated, encoding="utf-8", errors="replace"):
                    batch.append(line.rstrip("\r\n"))
                    if len(batch) >= BATCH_LINES:
                        yield pd.DataFrame({"source_file": row.source_file, "member": row.member, "line": batch})
                        batch = []
            if batch:
                yield pd.DataFrame({"source_file": row.source_file, "member": row.member, "line": batch})


def archive_lines(spark: SparkSession, root: str, pattern: str = "*.zip") -> DataFrame:
    """One row per text line of every non-HTML member of every archive under ``root``."""
    return archive_members(spark, root, pattern).hint("rebalance").mapInPandas(_lines, LINES_SCHEMA)


def read_archives(spark: SparkSession, root: str, pattern: str = "*.zip") -> DataFrame:
    """Raw flight rows (55 text columns + tail) with ``source_file`` and ``member``."""
    lines = archive_lines(spark, root, pattern).filter(F.length("line") > 0)
    parsed = lines.select("source_file", "member",
                          F.from_csv("line", RAW.simpleString(), CSV_OPTIONS).alias("r"))
    return parsed.filter(~is_header(F.col("r")[RAW_COLUMNS[0]])).select("r.*", "source_file", "member")


def _zipped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out, header = io.BytesIO(), ",".join(RAW_COLUMNS) + ",\n"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for i, pdf in enumerate(batches):
            zf.writestr(f"flights_{i}.csv", header + "".join(line + "\n" for line in pdf["line"]))
        zf.writestr("readme.html", "<html>not data</html>")
        # the text writer ends each file with a line feed: it is the archive's comment, of one byte
        zf.comment = b"\n"
    yield pd.DataFrame({"value": [out.getvalue()[:-1]]})


def write_archives(flights: DataFrame, path: str) -> str:
    """Write flights in the raw layout, one archive a task (file names ``part-*``), a member an Arrow batch.

    An archive holds what one task reads, so tasks should read less than 2 GB of flights.
    """
    lines = raw_rows(flights).select(F.to_csv(F.struct("*"), {"quote": '"', "escape": '"'}).alias("line"))
    (lines.mapInPandas(_zipped, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.mode("overwrite").text(path))
    return path
