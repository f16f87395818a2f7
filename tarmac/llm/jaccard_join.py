"""Exact n-gram Jaccard join by signature trees (operator 9).

Two documents link when their sets of distinct shingles (runs of ``width``
words) have a Jaccard similarity of ``percent`` / 100 or more.  The result
is each document's connected component.

1.  *Classes.* Documents with the same set are one class; its smallest
    identifier stands for it.
2.  *Keys.* Sets are put into one order of all shingles (frequent ones last,
    then by hash).  A linked pair shares a shingle within short prefixes of
    both sets, a shorter one for the smaller document, so documents only
    meet under prefix shingles.  The list of frequent shingles has a fixed
    length and changes nothing but the order.
3.  *Sizes.* A row stays only if under its key there is a document near
    enough in size.  The rows of a key, in order of size, are cut into
    blocks; block pairs whose size ranges are too far apart are dropped.
    That is the top level of the tree, in joins; no task holds more than
    two blocks.
4.  *Trees.* For each block pair, a signature tree (``signature_tree``) is
    traversed against itself.  In the first round a pair of documents that
    the round has joined already is skipped, so a group of copies gives a
    forest and not all its pairs.
5.  *Exact check.* Candidate pairs are compared on their whole sets.
6.  *Second round.* Links give components; the trees are traversed again
    for pairs of different components that were not compared yet.  So no
    link between components is lost, and pairs within one are not listed.

Sets hold 64-bit hashes of shingles.  Defined cases: null text has no
words; a document without words has an empty set and no links; one with
fewer words than ``width`` has one shingle, the whole sequence; repeated
rows are in the class of their set; a row with a null identifier has no
links and a null component; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import bound_batches, materialise
from tarmac.llm.components import connected_components
from tarmac.llm.signature_tree import SignatureTree, least_overlap, signature
from tarmac.llm.words import chunks, shingle_sets

#: A prefix shingle of this many documents is frequent; the list is as long as this at most.
FREQUENT = 16
MOST_FREQUENT = 200_000
BLOCK_ROWS = 1024
CHUNK_BYTES = 1_000_000


def prefix_lengths(n: int, percent: int) -> tuple[int, int]:
    """How much of an ordered set of n is read: as the smaller of a pair, and as the larger."""
    if n == 0:
        return 0, 0
    return (n - least_overlap(n, n, percent) + 1, n - -(-percent * n // 100) + 1)


def ordered_prefix(hashes: np.ndarray, length: int, last: np.ndarray) -> np.ndarray:
    """The first shingles of a set, those of ``last`` (ascending) after all others."""
    head = hashes[:length]
    if not len(last) or not _in(head, last).any():
        return head
    late = _in(hashes, last)
    return np.concatenate([hashes[~late], hashes[late]])[:length]


def _in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for lo, hi in chunks(texts, CHUNK_BYTES):
            yield ids.slice(lo, hi - lo), shingle_sets(texts.slice(lo, hi - lo).to_pylist(), width)


def _long_lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.append(0, np.cumsum([len(a) for a in arrays]))
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _head_keys(width: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, width):
            heads = [s[:prefix_lengths(len(s), percent)[1]] for s in sets]
            keys = np.concatenate([*heads, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys)], names=["key"])
    return run


def _described(width: int, percent: int, frequent: "Broadcast") -> Callable:  # noqa: F821
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = frequent.value
        for ids, sets in _sets(batches, width):
            short, long_ = zip(*(prefix_lengths(len(s), percent) for s in sets))
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                _long_lists([ordered_prefix(s, p, last) for s, p in zip(sets, long_)]),
                pa.array(short, pa.int32()),
                pa.array([signature(s) for s in sets], pa.binary())],
                names=["doc_id", "n", "digest", "keys", "short", "bitmap"])
    return run


def _whole_sets(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches, width):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([s.tobytes() for s in sets], pa.binary())], names=["rep", "hashes"])
    return run


def _frequent_keys(docs: DataFrame, width: int, percent: int) -> np.ndarray:
    """The most frequent prefix shingles: a list of bounded length."""
    counts = docs.mapInArrow(_head_keys(width, percent), "key long").groupBy("key").count()
    top = counts.filter(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "key").limit(MOST_FREQUENT)
    return np.sort(np.array([r[0] for r in top.select("key").collect()], np.int64).view(np.uint64))


def _near_sizes(rows: DataFrame, percent: int) -> DataFrame:
    """Rows under whose key a document of fitting size meets; the smaller of the two must be ``short``."""
    order = Window.partitionBy("key").orderBy("n", "rep")
    before = F.max(F.when(F.col("short"), F.col("n"))).over(
        order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.lead("n").over(order)
    return (rows.withColumn("_before", before).withColumn("_after", after)
            .filter((F.col("short") & (F.lit(percent) * F.col("_after") <= 100 * F.col("n")))
                    | (100 * F.col("_before") >= F.lit(percent) * F.col("n")))
            .drop("_before", "_after"))


def _block_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Rows (key, rep, n, short, label) dealt to the block pairs (key, b1, b2) they take part in."""
    order = Window.partitionBy("key").orderBy("n", "rep")
    rows = rows.withColumn("block", F.floor((F.row_number().over(order) - 1) / BLOCK_ROWS).cast("int"))
    blocks = rows.groupBy("key", "block").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("short").alias("short"),
        F.min("label").alias("l1"), F.max("label").alias("l2"))
    a, b = blocks.alias("a"), blocks.alias("b")
    fits = ((F.col("a.key") == F.col("b.key")) & (F.col("a.block") <= F.col("b.block"))
            & F.col("a.short") & (F.lit(percent) * F.col("b.lo") <= 100 * F.col("a.hi"))
            & ~((F.col("a.l1") == F.col("a.l2")) & (F.col("b.l1") == F.col("b.l2"))
                & (F.col("a.l1") == F.col("b.l1"))))
    met = a.join(b, fits).select(F.col("a.key").alias("key"), F.col("a.block").alias("b1"),
                                 F.col("b.block").alias("b2"))
    dealt = met.select("key", "b1", "b2", F.explode(F.array_distinct(F.array("b1", "b2"))).alias("block"))
    return rows.join(dealt, ["key", "block"]).drop("block")


def _traverse(percent: int, forest: bool) -> Callable:
    """Candidate pairs of each block pair; rows of one come one after another, by size."""
    def candidates(rows: dict[str, list]) -> Iterator[tuple[int, int]]:
        reps = rows["rep"]
        tree = SignatureTree(np.array(rows["n"]), rows["bitmap"], np.array(rows["short"]),
                             np.array(rows["label"]), percent)
        above = list(range(len(reps)))

        def root(i: int) -> int:
            while above[i] != i:
                above[i] = i = above[above[i]]
            return i

        for i, j in tree.pairs(root if forest else None):
            if forest:
                x, y = root(i), root(j)
                if x == y:
                    continue
                above[max(x, y)] = min(x, y)
            yield reps[i], reps[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, {}

        def told() -> pa.RecordBatch:
            pairs = list(candidates(held)) if len(held["rep"]) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())],
                names=["a", "b"])

        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in ("rep", "n", "short", "label", "bitmap")}
            at = np.stack([batch.column(c).to_numpy() for c in ("key", "b1", "b2")], 1)
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1).tolist(), len(at)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                now = tuple(at[lo])
                if now != task:
                    if task is not None:
                        yield told()
                    task, held = now, {c: [] for c in cols}
                for c in cols:
                    held[c] += cols[c][lo:hi]
        if task is not None:
            yield told()
    return run


def _candidates(rows: DataFrame, bitmaps: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Distinct pairs (a, b) that the trees cannot rule out."""
    dealt = _block_pairs(rows, percent).join(bitmaps, "rep")
    grouped = dealt.select("key", "b1", "b2", "rep", "n", "short", "label", "bitmap").repartition(
        "key", "b1", "b2").sortWithinPartitions("key", "b1", "b2", "n", "rep")
    return grouped.mapInArrow(_traverse(percent, forest), "a long, b long").distinct()


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with ``linked``, from their whole sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(common >= least_overlap(len(a), len(b), percent))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())],
                names=["a", "b", "linked"])

    x = sets.select(F.col("rep").alias("a"), F.col("hashes").alias("x"))
    y = sets.select(F.col("rep").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(
        run, "a long, b long, linked boolean")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest identifier reachable)."""
    spark = docs.sparkSession
    bound_batches(spark)
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    frequent = spark.sparkContext.broadcast(
        _frequent_keys(plain.filter("doc_id is not null").select("doc_id", "text"), width, percent))
    described = materialise(plain.mapInArrow(
        _described(width, percent, frequent),
        "doc_id long, n long, digest binary, keys array<long>, short int, bitmap binary"), "jaccard-docs")
    classes = materialise(described.filter("n > 0 and doc_id is not null").groupBy("digest", "n").agg(
        F.min("doc_id").alias("rep")), "jaccard-classes")
    # one row of each class is read on; repeated identifiers have equal keys only if they are one row
    reps = described.join(classes.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"]
                          ).dropDuplicates(["doc_id", "digest"])
    labels = classes.select("rep", F.col("rep").alias("component"))
    reps = materialise(reps.select(F.col("doc_id").alias("rep"), "n", "keys", "short", "bitmap"),
                       "jaccard-reps")
    posted = reps.select("rep", "n", F.posexplode("keys").alias("pos", "key"), F.col("short").alias("s")
                         ).select("key", "rep", "n", (F.col("pos") < F.col("s")).alias("short"))
    rows = materialise(_near_sizes(posted, percent), "jaccard-rows")
    bitmaps = reps.select("rep", "bitmap")
    pairs = materialise(_candidates(rows.withColumn("label", F.col("rep")), bitmaps, percent, True),
                        "jaccard-pairs")
    ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    needed = materialise(ends, "jaccard-needed")
    chosen = plain.join(needed, plain["doc_id"] == needed["rep"], "left_semi").select("doc_id", "text")
    sets = materialise(chosen.mapInArrow(_whole_sets(width), "rep long, hashes binary")
                       .dropDuplicates(["rep"]), "jaccard-sets")
    first = materialise(_compared(pairs, sets, percent), "jaccard-compared")
    links = first.filter("linked").select("a", "b")
    found = materialise(connected_components(links), "jaccard-components")
    if first.filter("not linked").limit(1).count():
        # other pairs of different components under the same keys
        known = rows.join(needed, "rep").join(
            found.select(F.col("v").alias("rep"), "component"), "rep", "left").select(
            "key", "rep", "n", "short", F.coalesce("component", "rep").alias("label"))
        several = known.groupBy("key").agg(F.min("label").alias("l1"), F.max("label").alias("l2")).filter(
            "l1 != l2").select("key")
        more = _candidates(known.join(several, "key"), bitmaps, percent, False)
        more = materialise(more.join(first.select("a", "b"), ["a", "b"], "left_anti"), "jaccard-pairs")
        second = _compared(more, sets, percent).filter("linked").select("a", "b")
        found = materialise(connected_components(links.unionByName(second)), "jaccard-components")
    labels = labels.drop("component").join(found.withColumnRenamed("v", "rep"), "rep", "left").select(
        "rep", F.coalesce("component", "rep").alias("component"))
    classes = classes.join(labels, "rep").select("digest", "n", "component")
    return described.select("doc_id", "n", "digest").join(classes, ["digest", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The documents whose identifier is their component's smallest, columns as before.

    Rows that share the kept identifier all stay; so do rows with a null identifier.
    """
    kept = (jaccard_components(docs, key=key, **options)
            .filter("doc_id = component_id").select(F.col("doc_id").alias("_kept_id")).distinct())
    same = docs[key].cast("long") == kept["_kept_id"]
    return docs.filter(F.col(key).isNull()).unionByName(docs.join(kept, same, "left_semi"))
