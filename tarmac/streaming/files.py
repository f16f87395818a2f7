"""Small files beside a stream: notes, and folders that appear whole."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file: aside first, then renamed, so it is whole or not there."""
    folder, _, name = path.rpartition("/")
    fs, aside = _path(spark, f"{folder}/.{name}.new")
    target = _path(spark, path)[1]
    fs.mkdirs(target.getParent())
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(aside, target):
        raise OSError(f"could not write {path}")


def move_into_place(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder its final name, unless an earlier attempt has."""
    fs, src = _path(spark, source)
    dst = _path(spark, target)[1]
    fs.mkdirs(dst.getParent())
    if fs.exists(dst):
        fs.delete(src, True)
    elif not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")
