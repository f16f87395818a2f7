"""Toxic spans and document scores from a linear-chain conditional random field (operator 11).

1.  *Sample.* The field is fitted on a bounded sample of labelled documents:
    the ``fit_toxic`` toxic and ``fit_clean`` clean ones of least hash, texts
    of up to ``fit_chars`` characters, none of them held out.
2.  *Labelled tokens.* Labels come by document.  A token of a toxic document
    is labelled toxic when its word, or one of its prefixes, occurs in more
    toxic than clean documents of the sample than chance explains (log-
    likelihood ratio, at a level divided by the number of features tested),
    at least ``TIMES`` as often; all other tokens are clean.
3.  *Field.* Weights of words, prefixes, suffixes and neighbouring words, and
    of the tags' transitions, are fitted to the tags (``chain_field``).
4.  *Scores.* Forward-backward over each whole text gives every token's
    probability.  A document's score is a logistic function of their sum, of
    the greatest, and of the text's length.  It is fitted on the marginals of
    fields that did not see the document (two halves), classes weighed as
    they occur among all training labels.
5.  *Spans.* Runs of tokens of probability 1/2 or more, as code points.

Scores read the text only.

Defined cases: null or empty text has no tokens and no spans, and the score
that a text without tokens gets; a null identifier is held out; labels that
are null, or of unknown documents, are left out (the latter count towards
the sample's bound); of several labels of a document the toxic one counts;
of rows that share an identifier the least text is fitted; without a
training document of each kind every score is 0; repeated rows are scored
alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm import chain_field
from tarmac.llm.chain_field import Field, Layout, feature_table, number_tokens
from tarmac.llm.words import chunks

FIT_TOXIC, FIT_CLEAN, FIT_CHARS = 800, 2_400, 100_000
TIMES = 3.0
LEVEL = 0.05
CHUNK_BYTES = 3_000_000
#: Words whose emissions a task keeps, before it starts anew.
KNOWN_WORDS = 500_000
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                     T.StructField("probability", T.DoubleType())])


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, fit_toxic: int, fit_clean: int,
               fit_chars: int) -> DataFrame:
    """``text`` and ``toxic`` of the documents to fit on; at most ``fit_toxic + fit_clean`` rows."""
    marked = (labels.select(F.col("doc_id").alias("id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
              .filter(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
              .groupBy("id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64(F.col("id").cast("string"))
    some = lambda kind, n: marked.filter(F.col("toxic") == kind).orderBy(order, "id").limit(n)
    chosen = some(1, fit_toxic).unionByName(some(0, fit_clean))
    texts = docs.select(F.col(key).alias("doc_key"), F.col(text).alias("text"))
    texts = texts.filter(F.length("text").between(1, fit_chars))
    # the chosen labels are bounded by the sample's size
    return (texts.join(F.broadcast(chosen), F.col("doc_key") == F.col("id"))
            .groupBy("id", "toxic").agg(F.min("text").alias("text")).select("toxic", "text"))


def token_tags(ids: np.ndarray, table: np.ndarray, layout: Layout, toxic: np.ndarray) -> np.ndarray:
    """Which tokens of toxic documents are labelled toxic (1)."""
    own = table[:, :-2]
    pairs = np.unique(layout.doc.astype(np.int64) * len(table) + ids)
    doc, word = pairs // len(table), pairs % len(table)
    features = own[word]
    size = 1 << chain_field.TABLE_BITS
    seen = np.unique((np.repeat(doc, own.shape[1]) * size + features.ravel()))
    doc, feature = seen // size, seen % size
    t = np.bincount(feature, toxic[doc], size)
    c = np.bincount(feature, 1 - toxic[doc], size)
    n_t, n_c = toxic.sum(), (1 - toxic).sum()
    tested = ((t + c) > 0) & (np.arange(size) > 0)
    term = lambda k, n, r: k * np.log(np.maximum(k, 1e-300) / np.maximum(n * r, 1e-300))
    rate = (t + c) / (n_t + n_c)
    ratio = 2 * (term(t, n_t, rate) + term(c, n_c, rate)
                 + term(n_t - t, n_t, 1 - rate) + term(n_c - c, n_c, 1 - rate))
    sure = 2 * np.log(max(tested.sum(), 1) / LEVEL)
    toxic_feature = tested & (ratio >= sure) & (t * n_c >= TIMES * c * n_t) & (t > 0)
    tagged = toxic_feature[own].any(1)
    return (tagged[ids] & (toxic[layout.doc] > 0)).astype(float)


def document_features(p: np.ndarray, layout: Layout) -> np.ndarray:
    """Of each document: one, the log of its expected toxic tokens, the greatest marginal, log length."""
    n = len(layout.sizes)
    total = np.bincount(layout.doc, p, n)
    top = np.zeros(n)
    np.maximum.at(top, layout.doc, p)
    return np.stack([np.ones(n), np.log1p(total), top, np.log1p(layout.sizes) / 10], 1)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weighted logistic regression by Newton's steps, halved while they do not help."""
    b = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + b @ penalty @ b / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -500, 500)))
        g = x.T @ (weight * (y - p)) - penalty @ b
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(b))
        step, at = np.linalg.solve(h, g), loss(b)
        while np.abs(step).max() > 1e-9 and loss(b + step) > at:
            step /= 2
        b += step
        if np.abs(step).max() < 1e-6:
            break
    return b


def fit_model(texts: list[str], toxic: np.ndarray, odds: float) -> tuple[Field, np.ndarray] | None:
    """The field and the weights of a document's score; ``odds``: true share of toxic by clean labels."""
    if not toxic.any() or toxic.all():
        return None
    order = sorted(range(len(texts)), key=lambda i: texts[i])
    texts, toxic = [texts[i] for i in order], toxic[order].astype(float)
    ids, sizes, words = number_tokens(texts)
    table, ends = feature_table(words), np.cumsum(sizes)
    every = np.arange(len(texts))

    def part(docs: np.ndarray) -> tuple[np.ndarray, Layout]:
        spans = [np.arange(ends[d] - sizes[d], ends[d]) for d in docs]
        return (ids[np.concatenate(spans)] if len(docs) else ids[:0]), Layout(sizes[docs])

    def learnt(docs: np.ndarray) -> Field:
        own, layout = part(docs)
        return chain_field.fit(own, table, layout, token_tags(own, table, layout, toxic[docs]))

    # halves alike in their share of toxic documents
    half = np.empty(len(texts), int)
    for kind in (0.0, 1.0):
        among = np.flatnonzero(toxic == kind)
        half[among] = np.arange(len(among)) % 2
    x = np.zeros((len(texts), 4))
    for h in (0, 1):
        field = learnt(every[half != h])
        own, layout = part(every[half == h])
        x[half == h] = document_features(field.tag(own, field.of_words(table), layout), layout)
    weight = np.where(toxic > 0, odds * (1 - toxic).sum() / toxic.sum(), 1.0)
    return learnt(every), fit_logistic(x, toxic, weight)


def spans_of(text: str, p: np.ndarray) -> list[dict]:
    """Runs of tokens of probability 1/2 or more; a run's probability is its greatest."""
    out: list[dict] = []
    before = False
    for m, q in zip(chain_field.TOKEN.finditer(text), p):
        if q >= 0.5:
            if before:
                out[-1] = {"start": out[-1]["start"], "end": m.end(),
                           "probability": max(out[-1]["probability"], float(q))}
            else:
                out.append({"start": m.start(), "end": m.end(), "probability": float(q)})
        before = q >= 0.5
    return out


def score_texts(texts: list[str], model: tuple[Field, np.ndarray] | None,
                known: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores and spans of some whole texts; ``known`` keeps words' emissions between calls."""
    if model is None:
        return np.zeros(len(texts)), [[] for _ in texts]
    field, b = model
    known = {} if known is None else known
    ids, sizes, words = number_tokens(texts)
    layout = Layout(sizes)
    if len(known) > KNOWN_WORDS:
        known.clear()
    new = [w for w in words if w not in known]
    known.update(zip(new, map(tuple, field.of_words(feature_table(new)).tolist())))
    p = field.tag(ids, np.array([known[w] for w in words]).reshape(-1, 3), layout)
    score = 1 / (1 + np.exp(-np.clip(document_features(p, layout) @ b, -500, 500)))
    marked = np.bincount(layout.doc[p >= 0.5], minlength=len(texts)) if len(p) else np.zeros(len(texts))
    return score, [spans_of(t, p[f:f + n]) if k else []
                   for t, f, n, k in zip(texts, layout.first, sizes, marked)]


def _scored(model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        fitted = None
        if model.value is not None:
            weights, rest = np.frombuffer(model.value[0]), np.array(model.value[1])
            fitted = Field(weights, rest[:4].reshape(2, 2), rest[4:6]), rest[6:]
        for batch in batches:
            for lo, hi in chunks(batch.column(2), CHUNK_BYTES):
                rows = batch.slice(lo, hi - lo)
                texts = [t or "" for t in rows.column(2).to_pylist()]
                score, spans = score_texts(texts, fitted, known)
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                           ("probability", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(score, pa.float64()),
                     pa.array((score >= 0.5).astype(np.int32)), pa.array(spans, kind)],
                    names=["doc_id", "held_out", "score", "predicted", "spans"])
    return run


def tag_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                  fit_toxic: int = FIT_TOXIC, fit_clean: int = FIT_CLEAN, fit_chars: int = FIT_CHARS,
                  ) -> DataFrame:
    """One row per document: ``doc_id`` (of any type), held_out, score, predicted and spans."""
    spark = docs.sparkSession
    sample = fit_sample(docs, labels, key, text, fit_toxic, fit_clean, fit_chars)
    kinds = dict((r[0], r[1]) for r in labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
                 .groupBy(F.col("toxic") > 0).count().collect())
    odds = kinds.get(True, 0) / max(kinds.get(False, 0), 1)

    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        model = fit_model(rows["text"].tolist(), rows["toxic"].to_numpy(), odds)
        if model is None:
            return pd.DataFrame({"weights": [], "rest": []}, dtype=object)
        field, b = model
        return pd.DataFrame({"weights": [field.weights.tobytes()],
                             "rest": [[*field.trans.ravel(), *field.start, *b]]})

    # one task: the sample and the model are of bounded size
    row = sample.withColumn("all", F.lit("all")).groupBy("all").applyInPandas(
        fitted, "weights binary, rest array<double>").first()
    model = spark.sparkContext.broadcast((bytes(row["weights"]), list(row["rest"])) if row else None)
    source = docs.select(F.col(key).alias("doc_id"), held_out(F.col(key)).alias("held_out"),
                         F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType),
                           T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
                           T.StructField("spans", T.ArrayType(SPAN))])
    return source.mapInArrow(_scored(model), schema)
