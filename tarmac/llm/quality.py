"""Quality rules with risk-controlled cutoffs (operator 7).

Base rules are fixed: a text with under 20 words, or in which more than
30 % of the words lie in 8-word windows that occur twice or more, fails.

Beyond them, each rule compares a share (of symbols, capitals, repeated
lines ...) with a cutoff that is chosen per stratum (language) from
labelled documents.  A cutoff may be used only if it is shown to reject
few good documents: the labelled good documents of the stratum are a
holdout, and the exact (Clopper-Pearson) binomial upper bound on the rate
at which the cutoff rejects them must not exceed ``risk / rules``, so that
all rules together stay within ``risk``.  Cutoffs lie on a grid fixed
beforehand and are tested from the laxest on, up to the first that fails
(fixed-sequence testing); the error level of each sequence is ``error``
divided by rules times strata (Bonferroni).  With probability
``1 - error`` every cutoff in use keeps its promise in every stratum.
Among the proven cutoffs the one is taken that catches most labelled bad
documents, good ones weighing ``good_weight`` times; ties go to the laxer.
A stratum with too few labels proves nothing, so its rules reject nothing.

The counts behind the cutoffs are one row per (stratum, rule, grid step)
over all labelled documents.

Defined cases: null or empty text has no words and fails; a null language
is a stratum; a document labelled twice counts once, with its best label;
labels of unknown documents and null labels are left out; without labels
only the base rules reject; repeated rows are judged alike; an empty table
gives an empty result; other columns pass through ``filter_documents``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import bound_batches, free_name, materialise

WINDOW = 8
CHUNK_CHARS = 4_000_000

# The characters that count as symbols, capitals and shouting, and white space.
SYMBOLS = "#*$%&|<>"
CAPITALS = bytes(range(65, 91))
SPACES = " \t\n\x0b\x0c\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Rules: name -> how far a text goes against it, from 0 to 1.
RULES = ["symbols", "capitals", "exclaim", "dup_lines", "repeat_words", "short_words", "few_distinct"]
STEPS = 50


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def repeated_words(ids: np.ndarray, doc: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which words lie in a window of ``window`` words that its document has twice or more.

    ``ids`` are word numbers, ``doc`` the document of each word (ascending).
    Windows meet by a 64-bit hash; those that meet are compared word by word.
    """
    covered = np.zeros(len(ids), bool)
    n = len(ids) - window + 1
    if n < 2:
        return covered
    inside = np.flatnonzero(doc[:n] == doc[window - 1:])
    mixed = _mix(ids.astype(np.uint64))
    h = _mix(doc[:n].astype(np.uint64))
    for k in range(window):
        h = h * np.uint64(0x2545F4914F6CDD1D) + mixed[k:k + n]
    at = inside[np.argsort(h[inside], kind="stable")]
    met = np.flatnonzero(h[at[1:]] == h[at[:-1]])
    a, b = at[met], at[met + 1]
    same = doc[a] == doc[b]
    for k in range(window):
        same &= ids[a + k] == ids[b + k]
    starts = np.zeros(len(ids) + 1, np.int64)
    for s in (a[same], b[same]):
        starts[s] = 1
    marks = np.flatnonzero(starts)
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, marks, 1)
    np.add.at(change, marks + window, -1)
    return np.cumsum(change)[:-1] > 0


def measure(texts: list[str]) -> dict[str, np.ndarray]:
    """Counts and shares of some texts."""
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    ids, lengths = [], []
    rows = []
    for t in texts:
        raw = t.encode("utf-8", "surrogatepass")
        words = raw.split()
        ids.extend([number(w, len(numbers)) for w in words])
        lengths.append(len(words))
        chars = len(t) - sum(map(t.count, SPACES))
        lines = [x for x in t.split("\n") if x.strip(SPACES)]
        exclaimed = t.count("!")
        rows.append((chars, sum(map(t.count, SYMBOLS)), len(lines) - len(set(lines)), len(lines),
                     len(raw) - len(raw.translate(None, CAPITALS)), exclaimed))
    n_words = np.array(lengths, np.int64)
    doc = np.repeat(np.arange(len(texts)), n_words)
    word = np.array(ids, np.int64)
    repeated = np.bincount(doc, repeated_words(word, doc), len(texts)).astype(np.int64)
    pairs = np.unique(doc * (len(numbers) + 1) + word) // (len(numbers) + 1)
    distinct = np.bincount(pairs, minlength=len(texts))
    chars, symbols, dup, lines, capitals, exclaimed = np.array(rows, np.int64).reshape(-1, 6).T
    per = lambda a, b: np.clip(a / np.maximum(b, 1), 0, 1)
    mean_word = chars / np.maximum(n_words, 1)
    # a vocabulary grows about as the power 0.8 of the text, so long texts are not "few distinct"
    usual = np.maximum(n_words, 1) ** 0.8
    shares = [per(symbols, chars), per(capitals, chars), per(exclaimed, n_words), per(dup, lines),
              per(repeated, n_words), np.clip(1 - mean_word / 8, 0, 1),
              np.clip(1 - distinct / usual, 0, 1)]
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup,
            "n_repeat_words": repeated,
            "steps": np.floor(np.array(shares) * STEPS).astype(np.int32).T}


def _measured(text_at: int, keep: list[int], schema: T.StructType) -> Callable:
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at)
            for lo, hi in chunks(texts):
                m = measure(["" if x is None else x for x in texts.slice(lo, hi - lo).to_pylist()])
                rest = [batch.column(i).slice(lo, hi - lo) for i in keep]
                counts = [pa.array(m[c]) for c in COUNTS]
                flat = pa.array(m["steps"].reshape(-1), pa.int32())
                ends = pa.array(np.arange(0, flat.__len__() + 1, len(RULES)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*rest, *counts, pa.ListArray.from_arrays(ends, flat)], names=names)
    return run


def chunks(texts: pa.Array, chars: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch that hold about ``chars`` bytes of text (one row at least)."""
    sizes = np.nan_to_num(np.asarray(pc.binary_length(texts).to_pandas(), float))
    lo, total = 0, 0.0
    for i, s in enumerate(sizes):
        if i > lo and total + s > chars:
            yield lo, i
            lo, total = i, 0.0
        total += s
    if lo < len(sizes):
        yield lo, len(sizes)


def with_measures(docs: DataFrame, text: str, keep: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """Columns ``keep`` with the counts and the rules' grid steps added; names of the new columns."""
    names = {c: free_name(f"_{c}", keep) for c in [*COUNTS, "steps"]}
    kept = [docs.schema[c] for c in keep]
    extra = [T.StructField(names[c], T.LongType()) for c in COUNTS]
    extra.append(T.StructField(names["steps"], T.ArrayType(T.IntegerType())))
    schema = T.StructType([*kept, *extra])
    source = docs.select(*dict.fromkeys([*keep, text]))
    at = source.columns
    bound_batches(docs.sparkSession)
    return source.mapInArrow(_measured(at.index(text), [at.index(c) for c in keep], schema),
                             schema), names


def at_most(hits: int, n: int, p: float) -> float:
    """Probability that a binomial count of ``n`` trials with rate ``p`` is ``hits`` or less."""
    k = np.arange(1, hits + 1)
    logs = np.append(0.0, np.cumsum(np.log((n - k + 1) / k) + math.log(p) - math.log1p(-p)))
    logs += n * math.log1p(-p)
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def upper_bound(hits: int, n: int, error: float) -> float:
    """Exact (Clopper-Pearson) upper confidence bound for a rate after ``hits`` of ``n``."""
    if n == 0 or hits >= n:
        return 1.0
    lo, hi = hits / n, 1.0
    for _ in range(40):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if at_most(hits, n, mid) > error else (lo, mid)
    return hi


def proven_cutoff(good: np.ndarray, bad: np.ndarray, risk: float, error: float,
                  good_weight: float) -> int | None:
    """The grid step from which a rule rejects, or None.

    ``good`` and ``bad`` count the labelled documents at each step 0 ... STEPS.
    """
    n_good, n_bad = int(good.sum()), max(int(bad.sum()), 1)
    best, at = 0.0, None
    for step in range(STEPS, 0, -1):
        lost = int(good[step:].sum())
        # the upper bound is at most ``risk`` just when this tail is at most ``error``
        if lost > risk * n_good or at_most(lost, n_good, risk) > error:
            break
        gain = bad[step:].sum() / n_bad - good_weight * lost / max(n_good, 1)
        if gain > best + 1e-12:
            best, at = gain, step
    return at


def choose_cutoffs(measured: DataFrame, labels: DataFrame, names: dict[str, str], key: str,
                   stratum: str, risk: float = 0.05, error: float = 0.05,
                   good_weight: float = 50.0) -> DataFrame:
    """One row per stratum: ``cutoffs``, a grid step per rule (above the grid: never rejects)."""
    marked = (labels.select(F.col("doc_id").alias("_label_id"), F.col("quality").alias("_quality"))
              .filter("_label_id is not null and _quality is not null")
              .groupBy("_label_id").agg(F.max("_quality").alias("_quality")))
    seen = (measured.filter(~base_failed(names)).select(
        F.col(key).alias("_key"), F.col(stratum).alias("stratum"), F.col(names["steps"]).alias("steps"))
        .join(marked, F.col("_key") == F.col("_label_id")))
    good = F.sum(F.when(F.col("_quality") > 0, 1).otherwise(0)).alias("good")
    bad = F.sum(F.when(F.col("_quality") > 0, 0).otherwise(1)).alias("bad")
    counts = materialise(seen.select("stratum", "_quality", F.posexplode("steps").alias("rule", "step"))
                         .groupBy("stratum", "rule", "step").agg(good, bad), "quality-counts")
    strata = max(counts.agg(F.countDistinct(F.coalesce("stratum", F.lit("")))).first()[0], 1)
    level = error / (len(RULES) * strata)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        cutoffs = []
        for rule in range(len(RULES)):
            own = rows[rows["rule"] == rule]
            table = np.zeros((2, STEPS + 1))
            for row, column in enumerate(("good", "bad")):
                np.add.at(table[row], own["step"].to_numpy(int), own[column].to_numpy())
            step = proven_cutoff(*table, risk / len(RULES), level, good_weight)
            cutoffs.append(STEPS + 1 if step is None else step)
        return pd.DataFrame({"stratum": rows["stratum"].iloc[:1], "cutoffs": [cutoffs]})

    return counts.groupBy("stratum").applyInPandas(choose, "stratum string, cutoffs array<int>")


def base_failed(names: dict[str, str]) -> Column:
    words, repeated = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    return (words < 20) | (F.lit(100) * repeated > F.lit(30) * words)


def _judged(measured: DataFrame, cutoffs: DataFrame, names: dict[str, str], stratum: str,
            ) -> tuple[DataFrame, str, str]:
    """Adds the verdicts; also gives the names of the base_failed and kept columns."""
    of, limit, failed, kept = (free_name(x, measured.columns)
                               for x in ("_of", "_limit", "_failed", "_kept"))
    limits = cutoffs.select(F.col("stratum").alias(of), F.col("cutoffs").alias(limit))
    above = F.exists(F.zip_with(names["steps"], limit, lambda s, c: s >= c), lambda x: x)
    judged = (measured.join(limits, F.col(stratum).eqNullSafe(F.col(of)), "left")
              .withColumn(failed, base_failed(names))
              .withColumn(kept, ~F.col(failed) & ~F.coalesce(above, F.lit(False))))
    return judged, failed, kept


def judge_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                    stratum: str = "lang", **risk) -> DataFrame:
    """One row per document: its counts, base_failed, kept."""
    plain = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"),
                        F.col(stratum).alias("stratum"))
    measured, names = with_measures(plain, "text", ["doc_id", "stratum"])
    measured = materialise(measured, "quality-measures")
    cutoffs = materialise(choose_cutoffs(measured, labels, names, "doc_id", "stratum", **risk),
                          "quality-cutoffs")
    judged, failed, kept = _judged(measured, cutoffs, names, "stratum")
    return judged.select("doc_id", *[F.col(names[c]).alias(c) for c in COUNTS],
                         F.col(failed).alias("base_failed"), F.col(kept).alias("kept"))


def filter_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                     stratum: str = "lang", **risk) -> DataFrame:
    """The documents that the rules keep, columns as before.

    Texts are measured twice (for the cutoffs, then for the verdict) and never shuffled.
    """
    narrow, names = with_measures(docs, text, list(dict.fromkeys([key, stratum])))
    cutoffs = materialise(choose_cutoffs(narrow, labels, names, key, stratum, **risk),
                          "quality-cutoffs")
    whole, names = with_measures(docs, text, docs.columns)
    judged, _, kept = _judged(whole, cutoffs, names, stratum)
    return judged.filter(F.col(kept)).select(*docs.columns)
