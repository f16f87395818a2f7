"""Exact deduplication by content sort (operator 1).

Normalised texts are range-partitioned by splitters that Spark samples,
and sorted (spilling to disk) inside each partition.  The order is that of
the text's first characters, then its digest, then the identifier: sampled
splitters, which pass through the driver, stay short however long the
texts are.  Equal texts are then neighbours; each row is compared in full
with the row before it.  As the identifier is part of the order, a text
with very many copies is dealt over several partitions, and the first row
of a run holds the smallest identifier.

A run can cross partitions.  Each partition therefore reports its first
and last text; neighbouring partitions' texts are compared in full, in a
join of one row per partition, and the runs at the edges are put together
from those answers.  Nothing larger than one row per partition meets in
one place, and no text goes to the driver.

Defined cases: null text counts as empty; all empty texts are one group;
repeated identifiers each keep their row, and the smallest identifier's
first row stays (one row of each group is kept); a null identifier sorts
first; an empty table gives an empty result; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import SPACE, free_name, materialise, text_of

RUNS = ("doc_id long, text_sha256 string, part int, run long, place long, run_first long, "
        "run_rows long, first_run boolean, last_run boolean, edge_text string")


#: How much of a text splitters hold.
HEAD_CHARS = 32


def normalise(text: Column) -> Column:
    """Each run of white space replaced by one space."""
    return F.regexp_replace(text, SPACE, " ")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mark the runs of equal texts in one sorted partition.

    Rows of a run are held back (identifiers and digests, never texts)
    until the run ends.  The texts of the partition's first and last rows
    are reported once each.
    """
    part = TaskContext.get().partitionId()
    last_text: str | None = None
    held: list[tuple[pa.Array, pa.Array]] = []
    run = -1

    def emit(ids: pa.Array, shas: pa.Array, runs: np.ndarray, starts: np.ndarray,
             lengths: np.ndarray, first: np.ndarray, last: np.ndarray, texts: list) -> pa.RecordBatch:
        n = len(ids)
        begin = np.repeat(starts, lengths)
        run_first = pc.take(ids, pa.array(begin))
        return pa.RecordBatch.from_arrays([
            ids, shas, pa.array(np.full(n, part, np.int32)), pa.array(np.repeat(runs, lengths)),
            pa.array(np.arange(n, dtype=np.int64) - begin), run_first,
            pa.array(np.repeat(lengths, lengths)), pa.array(np.repeat(first, lengths)),
            pa.array(np.repeat(last, lengths)), pa.array(texts, pa.string())], names=NAMES)

    def close(is_last: bool, text: str | None) -> pa.RecordBatch:
        ids = pa.concat_arrays([h[0] for h in held])
        shas = pa.concat_arrays([h[1] for h in held])
        n = len(ids)
        texts = [None] * n
        if run == 0:
            texts[0] = text
        if is_last:
            texts[n - 1] = text
        return emit(ids, shas, np.array([run]), np.array([0]), np.array([n]),
                    np.array([run == 0]), np.array([is_last]), texts)

    for batch in batches:
        ids, texts, shas = batch.column(0), batch.column(1), batch.column(2)
        n = batch.num_rows
        if n == 0:
            continue
        new = np.ones(n, bool)
        if n > 1:
            new[1:] = ~np.asarray(pc.equal(texts.slice(1), texts.slice(0, n - 1)))
        if last_text is not None:
            new[0] = texts[0].as_py() != last_text
        starts = np.flatnonzero(new)
        head = starts[0] if len(starts) else n
        if head:  # rows that go on with the held run
            held.append((ids.slice(0, head), shas.slice(0, head)))
        if len(starts):
            if held:
                yield close(False, last_text)
            run += 1
            ends = np.append(starts[1:], n)
            inner = len(starts) - 1  # runs that begin and end in this batch
            if inner:
                lo, hi = starts[0], starts[-1]
                words = [None] * (hi - lo)
                if run == 0:
                    words[0] = texts[int(lo)].as_py()
                yield emit(ids.slice(lo, hi - lo), shas.slice(lo, hi - lo),
                           run + np.arange(inner), starts[:-1] - lo, (ends - starts)[:-1],
                           (run + np.arange(inner)) == 0, np.zeros(inner, bool), words)
            run += inner
            held = [(ids.slice(starts[-1]), shas.slice(starts[-1]))]
        last_text = texts[n - 1].as_py()
    if held:
        yield close(True, last_text)


NAMES = [f.split()[0] for f in RUNS.split(", ")]


def _edges(runs: DataFrame) -> DataFrame:
    """One row per partition: which whole run its first and its last run belong to.

    ``joins`` tells whether a partition's first text equals the last text of
    the partition before it.  A chain of joined edge runs is one whole run.
    """
    ends = (runs.filter("first_run or last_run").groupBy("part").agg(
        F.max(F.when(F.col("first_run") & (F.col("place") == 0), F.col("edge_text"))).alias("first_text"),
        F.max(F.when(F.col("last_run") & (F.col("place") == F.col("run_rows") - 1),
                     F.col("edge_text"))).alias("last_text"),
        F.max("run").alias("last_run_no"),
        F.min(F.when(F.col("first_run"), F.struct("run_first", "run_rows"))).alias("f"),
        F.min(F.when(F.col("last_run"), F.struct("run_first", "run_rows"))).alias("l")))
    numbered = ends.select("part", F.row_number().over(Window.orderBy("part")).alias("at"))
    ends = ends.join(numbered, "part")
    before = ends.select((F.col("at") + 1).alias("at"), F.col("last_text").alias("text_before"))
    chained = ends.join(before, "at", "left").select(
        "part", "at", "last_run_no", "f", "l",
        F.coalesce(F.col("first_text") == F.col("text_before"), F.lit(False)).alias("joins"))
    edge = chained.select("part", "at", F.explode(F.when(
        F.col("last_run_no") == 0, F.array(F.struct(F.lit(0).cast("long").alias("run"), "joins",
                                                    F.col("f").alias("v")))).otherwise(
        F.array(F.struct(F.lit(0).cast("long").alias("run"), "joins", F.col("f").alias("v")),
                F.struct(F.col("last_run_no").alias("run"), F.lit(False).alias("joins"),
                         F.col("l").alias("v"))))).alias("e")).select("part", "at", "e.*")
    order = Window.orderBy("at", "run")
    whole = edge.withColumn("chain", F.sum(F.when(F.col("joins"), 0).otherwise(1)).over(order))
    by = Window.partitionBy("chain")
    return whole.select(
        "part", "run", F.first(F.col("v.run_first")).over(by.orderBy("at", "run")).alias("whole_first"),
        F.sum("v.run_rows").over(by).alias("whole_rows"),
        F.coalesce(F.sum("v.run_rows").over(by.orderBy("at", "run").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("rows_before"))


def dedup_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: keep_id, group_size, kept, and the digest of its normalised text.

    Equal documents are those whose normalised texts are identical; the row
    with the smallest identifier stays.
    """
    norm = docs.select(F.col(key).cast("long").alias("doc_id"),
                       normalise(text_of(text)).alias("norm"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["head", "sha", "doc_id"]
    told = norm.withColumn("sha", F.sha2(F.col("norm"), 256)).withColumn(
        "head", F.substring("norm", 1, HEAD_CHARS))
    told = told.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "norm", "sha")
    runs = materialise(told.mapInArrow(_runs, RUNS), "dedup-runs")
    edges = _edges(runs)
    at_edge = F.col("first_run") | F.col("last_run")
    inner = runs.filter(~at_edge).select(
        "doc_id", F.col("run_first").alias("keep_id"), F.col("run_rows").alias("group_size"),
        (F.col("place") == 0).alias("kept"), "text_sha256")
    outer = runs.filter(at_edge).join(edges, ["part", "run"]).select(
        "doc_id", F.col("whole_first").alias("keep_id"), F.col("whole_rows").alias("group_size"),
        ((F.col("place") == 0) & (F.col("rows_before") == 0)).alias("kept"), "text_sha256")
    return inner.unionByName(outer)


def _starts(columns: int, names: list[str]) -> Callable:
    """Rows of a sorted partition that begin a run of equal texts, whole; and its last row, marked.

    The texts of the first and last rows come along for the comparison with
    neighbouring partitions.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, begun = TaskContext.get().partitionId(), None, False

        def told(rows: pa.RecordBatch, start: bool, first: bool, edge: list) -> pa.RecordBatch:
            n = rows.num_rows
            return pa.RecordBatch.from_arrays([
                *rows.columns[:columns], pa.array(np.full(n, part, np.int32)), pa.array([start] * n),
                pa.array([first] + [False] * (n - 1)), pa.array(edge + [None] * (n - len(edge)), pa.string())],
                names=names)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            texts = batch.column(columns)
            new = np.ones(n, bool)
            new[1:] = ~np.asarray(pc.equal(texts.slice(1), texts.slice(0, n - 1)))
            if last is not None:
                new[0] = texts[0].as_py() != last.column(columns)[0].as_py()
            if new.any():
                rows = batch.filter(pa.array(new))
                yield told(rows, True, not begun, [] if begun else [texts[0].as_py()])
                begun = True
            last = batch.slice(n - 1)
        if last is not None:
            yield told(last, False, False, [last.column(columns)[0].as_py()])
    return run


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without repeats of an equal text, columns as before.

    Whole rows go through the content sort once; of equal texts the first
    row in order of identifier stays.
    """
    norm, head, sha, part, start, first, edge = (free_name(x, docs.columns) for x in (
        "_norm", "_head", "_sha", "_part", "_start", "_first", "_edge"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(head), F.col(sha), F.col(key).cast("long")]
    told = docs.withColumn(norm, normalise(text_of(text))).withColumn(sha, F.sha2(F.col(norm), 256)).withColumn(
        head, F.substring(norm, 1, HEAD_CHARS))
    told = told.repartitionByRange(n, *order).sortWithinPartitions(*order).select(*docs.columns, norm)
    schema = T.StructType([*docs.schema.fields, T.StructField(part, T.IntegerType()),
                           T.StructField(start, T.BooleanType()), T.StructField(first, T.BooleanType()),
                           T.StructField(edge, T.StringType())])
    rows = materialise(told.mapInArrow(_starts(len(docs.columns), schema.fieldNames()), schema), "dedup-firsts")
    ends = rows.filter(F.col(first) | ~F.col(start)).groupBy(F.col(part).alias("p")).agg(
        F.max(F.when(F.col(first), F.col(edge))).alias("first_text"),
        F.max(F.when(~F.col(start), F.col(edge))).alias("last_text"))
    places = ends.select("p", F.row_number().over(Window.orderBy("p")).alias("at"))
    ends = ends.join(places, "p")
    before = ends.select((F.col("at") + 1).alias("at"), F.col("last_text").alias("text_before"))
    again = ends.join(before, "at").filter("first_text = text_before").select("p")
    return rows.filter(F.col(start)).join(
        again, F.col(first) & (F.col(part) == F.col("p")), "left_anti").select(*docs.columns)
