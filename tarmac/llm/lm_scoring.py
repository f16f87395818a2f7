"""Language-model scoring of whole documents (operator 2).

1.  *Words.* Texts are cut into lower-case words; documents are packed into
    chunks of some megabytes, each with its own word list and the texts as
    numbers.  Training documents' words are counted per chunk, summed over
    the corpus by a shuffle on the word, and joined back to the chunks.
2.  *Codes.* The most frequent words get a code each; a rarer word gets the
    code of its frequency bucket.  Within a bucket a word has its share of
    the bucket's counts.  Words seen once or never share a bucket; its mass
    is split between the two by the Good-Turing estimate, and all unknown
    words are one word, as in the base score.
3.  *Model.* A gated recurrent model of the codes (``recurrent``) is trained
    by truncated backpropagation on all training documents, in rounds:
    every task goes on from the same weights over its chunks of the round,
    and the weights are averaged, weighted by tokens, in two steps of
    grouping.  Model and weights have a fixed size.
4.  *Scores.* The state is carried through each whole document.

Base score: sum of log10((c + 0.5) / (N + 0.5 (V + 1))) over the words and
the end, from training counts.

Defined cases: null text counts as empty (one token: the end); a null
identifier is a training document; repeated rows count and are scored each;
a text of any length is scored whole; without training documents every
word is unknown; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import recurrent
from tarmac.llm.common import materialise
from tarmac.llm.words import chunks, number_words

#: A key of the word table that no word can be (words hold no white space).
END = b" "
HEAD_WORDS = 512
HEAD_CLASSES = 16
BUCKETS = 40
ROUNDS = 3
CHUNK_BYTES = 10_000_000
#: Tokens scored or learnt at a time (whole documents; more only for a longer one).
SLAB = 200_000
RATES = (0.05, 0.02, 0.01)
#: Weights of tasks are averaged in so many groups, then those of the groups.
GROUPS = 64
WEIGHTS = "weights binary, seen long, g int"
CHUNK = ("chunk long, doc_ids array<long>, held array<boolean>, tokens array<long>, "
         "words array<binary>, counts array<long>, ids binary")


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def _coded_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks: word numbers of all tokens (an end after each text), word list, training counts."""
    part, number = TaskContext.get().partitionId(), 0
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for lo, hi in chunks(batch.column(2), CHUNK_BYTES):
            keys, held = batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo)
            ids, counts, words = number_words(batch.column(2).slice(lo, hi - lo).to_pylist())
            ids = np.insert(ids, np.cumsum(counts), len(words))
            counts = counts + 1
            training = np.repeat(~np.asarray(held), counts)
            seen = np.bincount(ids[training], minlength=len(words) + 1)
            row = lambda values, kind: pa.ListArray.from_arrays(
                pa.array([0, len(values)], pa.int32()), pa.array(values, kind))
            yield pa.RecordBatch.from_arrays([
                pa.array([(part << 32) + number], pa.int64()), row(keys.to_pylist(), pa.int64()),
                row(held.to_pylist(), pa.bool_()), row(counts, pa.int64()),
                row([*words, END], pa.binary()), row(seen, pa.int64()),
                pa.array([squeeze.compress(ids.astype(np.int32).tobytes())], pa.binary())],
                names=[f.split()[0] for f in CHUNK.split(", ")])
            number += 1


def _tables(vocabulary: DataFrame) -> dict:
    """What the model needs to know of the training counts; of bounded size."""
    n, v, once, twice = vocabulary.agg(
        F.sum("c"), F.count(F.lit(1)), F.count(F.when(F.col("c") == 1, 1)),
        F.count(F.when(F.col("c") == 2, 1))).first()
    head = [(bytes(r[0]), r[1]) for r in vocabulary.filter(F.col("word") != F.lit(END)).orderBy(
        F.desc("c"), "word").limit(HEAD_WORDS - 1).collect() if r[1] > 1]
    end = vocabulary.filter(F.col("word") == F.lit(END)).first()
    return {"N": n or 0, "V": v, "once": once, "twice": twice,
            "head": [(END, end["c"] if end else 0), *head]}


def bucket(count: Column) -> Column:
    """0 for words seen once or never, else the whole part of log2."""
    return F.when(count < 2, 0).otherwise(
        F.least(F.lit(BUCKETS - 1), F.length(F.bin(count)) - 1)).cast("int")


def _shape(head: list[tuple[bytes, int]]) -> recurrent.Shape:
    """Frequent words in classes of about equal sums of root counts; a class for each bucket."""
    weight = np.sqrt([c for _, c in head[1:]])
    starts = [0]
    if len(weight):
        at = np.floor(np.cumsum(weight) / weight.sum() * (HEAD_CLASSES - 1e-9)).astype(int)
        starts += (1 + np.flatnonzero(np.append(True, at[1:] != at[:-1]))).tolist()
    starts += range(len(head), len(head) + BUCKETS)
    return recurrent.Shape(len(head) + BUCKETS, tuple(starts))


def _coded(told: dict, masses: dict[int, float]) -> Callable:
    """A chunk with its words' corpus counts -> codes, base scores, and the fixed part of the scores."""
    total = told["N"] + 0.5 * (told["V"] + 1)
    known_once, n_head = told["once"], len(told["head"])
    unseen = known_once / (known_once + 2 * told["twice"]) if known_once and told["twice"] else \
        0.5 if known_once else 1.0

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        size = len(left["words_n"]) and left["words_n"][0].as_py()
        count, code = np.zeros(size, np.int64), np.full(size, n_head, np.int64)
        at = right["place"].to_numpy()
        count[at], code[at] = right["c"].to_numpy(), right["code"].to_numpy()
        base = np.log10((count + 0.5) / total)
        inside = np.zeros(size)
        tail = code >= n_head
        mass = np.array([masses.get(b, 1.0) for b in range(BUCKETS)])
        inside[tail] = np.log10((count[tail] + 0.5) / mass[code[tail] - n_head])
        rare = code == n_head
        inside[rare & (count == 0)] = math.log10(unseen)
        if known_once:
            inside[rare & (count == 1)] = math.log10((1 - unseen) / known_once)
        ids = np.frombuffer(zstandard.ZstdDecompressor().decompress(left["ids"][0].as_py()), np.int32)
        tokens = np.array(left["tokens"][0].as_py(), np.int64)
        first = np.append(0, np.cumsum(tokens))[:-1]
        per_doc = lambda v: np.add.reduceat(v[ids], first) if len(first) else v[:0]
        row = lambda values, kind: pa.array([values.tolist()], pa.list_(kind))
        return pa.table({
            "chunk": left["chunk"].combine_chunks(), "doc_ids": left["doc_ids"].combine_chunks(),
            "held": left["held"].combine_chunks(), "tokens": left["tokens"].combine_chunks(),
            "known": row(per_doc((count > 0).astype(np.int64)), pa.int64()),
            "base": row(per_doc(base), pa.float64()), "inside": row(per_doc(inside), pa.float64()),
            "codes": pa.array([code[ids].astype(np.uint16).tobytes()], pa.binary())})
    return run


def _training_codes(held: list[bool], tokens: list[int], codes: bytes) -> np.ndarray:
    return np.frombuffer(codes, np.uint16)[np.repeat(~np.array(held, bool), tokens)].astype(np.int64)


def slabs(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``SLAB`` tokens that end where documents end."""
    lo = 0
    while len(ends) and lo < ends[-1]:
        hi = int(ends[max(np.searchsorted(ends, lo + SLAB, "right") - 1, np.searchsorted(ends, lo, "right"))])
        yield lo, hi
        lo = hi


def _learn(weights: "Broadcast", like: recurrent.Params, shape: recurrent.Shape, rate: float) -> Callable:  # noqa: F821
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, seen = recurrent.Trainer(recurrent.unpack(weights.value, like), shape, rate), 0
        for batch in batches:
            for i in range(batch.num_rows):
                codes = _training_codes(*(batch.column(c)[i].as_py() for c in ("held", "tokens", "codes")))
                for lo, hi in slabs(np.flatnonzero(codes == 0) + 1):
                    trainer.learn(codes[lo:hi])
                seen += len(codes)
        if seen:
            yield _weighted(recurrent.pack(trainer.p), seen, TaskContext.get().partitionId() % GROUPS)
    return run


def _weighted(raw: bytes, seen: int, group: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([raw], pa.binary()), pa.array([seen], pa.int64()), pa.array([group], pa.int32())],
        names=["weights", "seen", "g"])


def _mean(table: pa.Table) -> pa.Table:
    total, seen = 0.0, 0
    for raw, n in zip(table["weights"], table["seen"]):
        total = total + np.frombuffer(raw.as_py(), np.float32) * float(n.as_py())
        seen += n.as_py()
    return pa.Table.from_batches([_weighted((total / seen).astype(np.float32).tobytes(), seen, 0)])


def train(coded: DataFrame, shape: recurrent.Shape, counts: np.ndarray, rounds: int = ROUNDS) -> recurrent.Params:
    """Weights after ``rounds`` rounds, which together read every training document once."""
    sc = coded.sparkSession.sparkContext
    params = recurrent.initial(shape, counts)
    for turn in range(rounds):
        weights = sc.broadcast(recurrent.pack(params))
        own = coded.filter(F.pmod(F.xxhash64("chunk"), F.lit(rounds)) == turn)
        learnt = own.select("held", "tokens", "codes").mapInArrow(
            _learn(weights, params, shape, RATES[min(turn, len(RATES) - 1)]), WEIGHTS)
        some = learnt.groupBy("g").applyInArrow(_mean, WEIGHTS)
        met = some.groupBy("g").applyInArrow(_mean, WEIGHTS).first()
        if met is not None:
            params = recurrent.unpack(bytes(met["weights"]), params)
    return params


def _scored(weights: "Broadcast", like: recurrent.Params, shape: recurrent.Shape, total: int) -> Callable:  # noqa: F821
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params = recurrent.unpack(weights.value, like)
        for batch in batches:
            for i in range(batch.num_rows):
                get = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                codes = np.frombuffer(get["codes"], np.uint16).astype(np.int64)
                tokens = np.array(get["tokens"], np.int64)
                first = np.append(0, np.cumsum(tokens))[:-1]
                told = [recurrent.score_stream(params, shape, codes[lo:hi]) for lo, hi in slabs(np.cumsum(tokens))]
                score = np.add.reduceat(np.concatenate(told), first)
                yield pa.RecordBatch.from_arrays([
                    pa.array(get["doc_ids"], pa.int64()), pa.array(get["held"], pa.bool_()),
                    pa.array(tokens), pa.array(get["known"], pa.int64()),
                    pa.array(np.full(len(tokens), total, np.int64)), pa.array(get["base"], pa.float64()),
                    pa.array(score + np.array(get["inside"]))], names=names)
    return run


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(F.col(key)).alias("held"),
                        F.col(text).alias("text"))
    packed = materialise(plain.mapInArrow(_coded_words, CHUNK), "lm-chunks")
    listed = packed.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w")
                           ).select("chunk", "place", "w.*")
    vocabulary = materialise(listed.filter("counts > 0").groupBy(F.col("words").alias("word")).agg(
        F.sum("counts").alias("c")), "lm-vocabulary")
    told = _tables(vocabulary)
    n_head = len(told["head"])
    codes = spark.createDataFrame([(bytearray(w), i) for i, (w, _) in enumerate(told["head"])],
                                  "head binary, head_code int")
    known = vocabulary.join(F.broadcast(codes), F.col("word") == F.col("head"), "left").select(
        "word", "c", F.coalesce("head_code", F.lit(n_head) + bucket(F.col("c"))).alias("code"))
    sums = {r[0] - n_head: (r[1], r[2]) for r in known.filter(F.col("code") >= n_head).groupBy("code").agg(
        F.sum(F.col("c") + 0.5), F.sum("c")).collect()}
    met = listed.select("chunk", "place", F.col("words").alias("word")).join(known, "word").select(
        F.col("chunk").alias("of"), "place", "c", "code")
    whole = packed.select("chunk", "doc_ids", "held", "tokens", F.size("words").alias("words_n"), "ids")
    coded = materialise(whole.groupBy("chunk").cogroup(met.groupBy("of")).applyInArrow(
        _coded(told, {b: float(s[0]) for b, s in sums.items()}),
        "chunk long, doc_ids array<long>, held array<boolean>, tokens array<long>, known array<long>, "
        "base array<double>, inside array<double>, codes binary"), "lm-coded")
    shape = _shape(told["head"])
    counts = np.zeros(shape.codes)
    counts[:n_head] = [c for _, c in told["head"]]
    for b, (_, c) in sums.items():
        counts[n_head + b] = c
    params = train(coded, shape, counts)
    weights = spark.sparkContext.broadcast(recurrent.pack(params))
    return coded.drop("chunk").mapInArrow(
        _scored(weights, params, shape, int(told["N"])),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")
