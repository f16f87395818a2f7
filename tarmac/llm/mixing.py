"""Mixing sources to target weights by balanced sampling (operator 10).

Each source gets a target number of words; a document of a source is taken
``target / source_size`` times in the mean: that many whole copies, and
one more with the fractional probability that remains.  The cube method
turns those probabilities into 0 or 1: it moves the vector of probabilities
inside the unit cube along directions that change neither the sum of the
probabilities (documents) nor the sum of probability times size (words),
until at most two documents are left fractional.  A landing phase then
drops the document total first and settles those two.

It runs as a tree.  Documents of a source are dealt by hash into blocks of
about ``block_rows`` rows; each block is balanced by itself and hands its
two or fewer open documents to the next level, where they are dealt into
blocks again.  A source that holds a third of all rows is just more blocks.
The number of levels is a logarithm of the row count, and the same rows
give the same mix: blocks and random draws depend on identifiers only.

Defined cases: null text has size 0; a null source is a source of its own
and comes last; documents of size 0 take 0 words; a source of size 0 has
target 0; repeated rows are separate documents; an empty table gives an
empty result; other columns are carried along.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import WORD, free_name, materialise, text_of

BLOCK_ROWS = 4096
WINDOW = 32
EPS = 1e-9


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """Targets per source: ``share`` of all words dealt by weight, ``most`` times a source's size at most.

    What a full source leaves is dealt again by weight, until none is above
    its limit.  That end is ``min(most * size, level * weight)`` for one
    level; with sources ordered by limit / weight, the full ones are a
    prefix, so running sums over the table of sources give the level.
    Sources are ordered by code point, null last, and take ``weights`` in turn.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"),
                                      F.count(F.lit(1)).alias("source_rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("place", place).withColumn(
        "weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
    per = per.withColumn("limit", F.lit(float(most)) * F.col("source_size"))
    every = Window.partitionBy(F.lit(0))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(every))
           .withColumn("full", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
           .withColumn("open", F.sum("weight").over(every)
                       - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the level as it would be if exactly the sources before this one were full
    per = per.withColumn("here", (F.col("budget") - F.col("full")) / F.col("open"))
    fits = F.col("here") * F.col("weight") <= F.col("limit")
    level = F.min(F.when(fits, F.struct(F.col("limit") / F.col("weight"), "place", "here"))
                  ).over(every)["here"]
    target = F.least("limit", F.coalesce(level * F.col("weight"), F.col("limit")))
    return per.select("source", "source_size", "source_rows", target.alias("target"))


def direction(size: np.ndarray) -> np.ndarray | None:
    """A vector that changes neither the document nor the word total, or None.

    The first (largest) document moves by 1 and the others make up for it
    together, so it is settled while there are still smaller ones to balance it.
    """
    first, rest = size[0], size[1:]
    spread = rest - rest.mean()
    norm = float(spread @ spread)
    if norm > 0:
        return np.append(1.0, -(1 / len(rest) + (first - rest.mean()) * spread / norm))
    if first == rest[0]:
        return np.append(1.0, np.full(len(rest), -1 / len(rest)))
    if len(rest) > 1:
        return np.append([0.0, 1.0, -1.0], np.zeros(len(rest) - 2))
    return None


def _step(p: np.ndarray, at: np.ndarray, u: np.ndarray, draw: float) -> None:
    """Go as far as the cube allows along ``u`` or against it, the means unchanged."""
    x, moves = p[at], np.abs(u) > 1e-12
    v = u[moves]
    up, down = (1 - x[moves]) / np.abs(v), x[moves] / np.abs(v)
    ahead = np.where(v > 0, up, down).min()
    back = np.where(v > 0, down, up).min()
    x[moves] += (ahead if draw * (ahead + back) < back else -back) * v
    p[at] = np.where(x < EPS, 0.0, np.where(x > 1 - EPS, 1.0, x))


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities to 0 or 1, keeping their sum and the sum of p * size; two or fewer stay open.

    Documents come in the order given (largest first) through a window.
    """
    p = p.astype(float).copy()
    size = size.astype(float)
    todo = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    held, next_ = todo[:WINDOW], WINDOW
    while len(held) > 1 and (u := direction(size[held])) is not None:
        _step(p, held, u, rng.random())
        held = held[(p[held] > EPS) & (p[held] < 1 - EPS)]
        more = WINDOW - len(held)
        held = np.append(held, todo[next_:next_ + more])
        next_ += more
    return p


def landing(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Settle the open rest: keep only the sum of p * size, then draw the last one."""
    p = p.copy()
    open_ = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    while len(open_) > 1:
        a, b = open_[:2]
        u = np.array([size[b], -size[a]], float) if size[a] or size[b] else np.array([1.0, -1.0])
        _step(p, np.array([a, b]), u / np.abs(u).max(), rng.random())
        open_ = open_[(p[open_] > EPS) & (p[open_] < 1 - EPS)]
    for i in open_:
        p[i] = float(rng.random() < p[i])
    return np.where(p > 0.5, 1.0, 0.0)


def _balance(last: bool, level: int, seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def block(rows: pd.DataFrame) -> pd.DataFrame:
        # large documents first, so that what stays open in the end is small
        rows = rows.sort_values(["_size", "_order", "_id"], ascending=[False, True, True],
                                kind="stable").reset_index(drop=True)
        name = f"{seed}:{level}:{rows['_source'].iloc[0]}:{rows['_block'].iloc[0]}"
        rng = np.random.default_rng(zlib.crc32(name.encode()))
        p, size = rows["_p"].to_numpy(float), rows["_size"].to_numpy()
        p = flight(p, size, rng)
        if last:
            p = landing(p, size, rng)
        rows["_p"] = p
        return rows
    return block


def mix_plan(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), share: float = 1.5,
             most: float = 2.0, key: str = "doc_id", source: str = "source", text: str = "text",
             block_rows: int = BLOCK_ROWS, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    rows = materialise(docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"),
        F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("size")), "mix-sizes")
    targets = materialise(source_targets(rows, weights, share, most), "mix-targets")
    times = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    open_ = rows.join(targets.withColumnRenamed("source", "_s"),
                      F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"),
        "source_size", "target", "source_rows",
        F.floor(times + EPS).cast("double").alias("_whole"), times.alias("_times"))
    open_ = open_.select(
        "_id", "_source", "_size", "source_size", "target", "_whole",
        F.when((F.col("_times") - F.col("_whole")) > EPS, F.col("_times") - F.col("_whole"))
        .otherwise(0.0).alias("_p"),
        F.xxhash64(F.lit(seed), "_id").alias("_order"),
        F.col("source_rows").alias("_rows"))
    is_open = (F.col("_p") > EPS) & (F.col("_p") < 1 - EPS)
    done = [open_.filter(~is_open).drop("_rows", "_order")]
    left, level = open_.filter(is_open), 0
    while True:
        blocks = F.ceil(F.col("_rows") / F.lit(block_rows))
        dealt = left.withColumn("_block", F.pmod(F.xxhash64(F.lit(level), "_order"), blocks)
                                ).drop("_rows")
        most_rows = left.agg(F.max("_rows")).first()[0] or 0
        last = most_rows <= block_rows
        out = materialise(dealt.groupBy("_source", "_block").applyInPandas(
            _balance(last, level, seed), dealt.schema), f"mix-level{level}")
        done.append(out.filter(~is_open).drop("_block", "_order"))
        if last:
            break
        still = out.filter(is_open).drop("_block")
        counts = still.groupBy(F.col("_source").alias("_s")).agg(F.count(F.lit(1)).alias("_rows"))
        left = still.join(counts, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
        level += 1
    mixed = done[0]
    for d in done[1:]:
        mixed = mixed.unionByName(d)
    copies = (F.col("_whole") + F.round("_p")).cast("long")
    return mixed.select(F.col("_id").alias("doc_id"), F.col("_source").alias("source"),
                        F.col("_size").alias("size"), "source_size", "target",
                        copies.alias("copies"), (copies * F.col("_size")).alias("taken"))


def mix_documents(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The mixed documents themselves: each row as often as the mix takes it, columns as before.

    Rows that share an identifier are all taken as often as the most taken of them.
    """
    n, mix_id, again = (free_name(x, docs.columns) for x in ("_copies", "_mix_id", "_copy"))
    plan = (mix_plan(docs, key=key, **options).groupBy(F.col("doc_id").alias(mix_id))
            .agg(F.max("copies").alias(n)).filter(F.col(n) > 0))
    return (docs.join(plan, F.col(key).eqNullSafe(F.col(mix_id)))
            .withColumn(again, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))))
            .drop(n, mix_id, again))
