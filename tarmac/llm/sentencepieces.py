"""SentencePiece encoding and decoding as a relational lattice (operator 3).

Pieces never cross the start of a run of word marks, so a text is encoded
word by word, and each distinct word once:

1.  Texts are packed into chunks with word lists; distinct words are
    collected by a shuffle on the word.
2.  Every substring of a word up to the longest piece's length is joined to
    the piece table (of fixed size: the model's).  The matches are the
    edges of the word's lattice; a character that is no piece becomes an
    edge of its byte pieces.  Edges are grouped by word where they are: the
    words' partitioning still holds.
3.  A fold over the word's edges (``aggregate``) gives the pieces.  For a
    unigram model it is Viterbi.  For a BPE model the best path is not the
    encoder's answer; there the fold merges, step by step, the best-scored
    edge that joins exactly two neighbours, over the same lattice.
4.  The words' pieces are joined back to the chunks and put into documents.
5.  Every row is decoded again, and the SHA-256 of what comes out compared
    with that of the source text, taken before the text was cut into words.

The fold holds a word's boundaries in the bits of a long.  Words of over 62
characters are merged by a heap instead, with the same result, in time
that grows with length times its logarithm.

Decoding looks up each row's identifiers in the piece table and puts their
bytes together; rows never meet, so identifiers may be null or repeated.

Defined cases: null or empty text has no pieces; bytes that are not UTF-8
cannot occur in a string column; on decoding, ill-formed bytes become
U+FFFD, identifiers outside the model are ignored, and control pieces and nulls are
nothing; repeated rows are encoded alike; an empty table gives an empty
result; other columns are not read.  A text that holds the word mark itself
decodes to spaces there: round_trip is false.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.llm.common import bound_batches, materialise
from tarmac.llm.words import chunks

# The word mark, and model types.
MARK = "▁"
UNIGRAM, BPE = 1, 2
FOLD_CHARS = 62
CHUNK_BYTES = 8_000_000
MOST_PIECES = 1_000_000
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Model:
    kind: int
    #: piece, score and identifier of the pieces that text can match
    pieces: tuple[tuple[str, float, int], ...]
    #: identifiers of the byte pieces 0 ... 255 (empty without byte fallback)
    bytes: tuple[int, ...]
    unknown: int

    @staticmethod
    def load(path: str) -> Model:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        rules = proto.normalizer_spec
        if (proto.trainer_spec.model_type not in (UNIGRAM, BPE) or rules.precompiled_charsmap
                or rules.remove_extra_whitespaces or not rules.add_dummy_prefix
                or not rules.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix):
            raise ValueError("only unigram and BPE models without a normaliser are supported")
        p = SentencePieceProcessor(model_proto=proto.SerializeToString())
        every = range(p.get_piece_size())
        plain = [i for i in every if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
        raw = {int(p.id_to_piece(i)[3:-1], 16): i for i in every if p.is_byte(i)}
        return Model(proto.trainer_spec.model_type,
                     tuple((p.id_to_piece(i), p.get_score(i), i) for i in plain),
                     tuple(raw[b] for b in range(256)) if raw else (), p.unk_id())

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.pieces)

    @property
    def lone(self) -> str:
        """ASCII control characters that no piece holds: each stands alone."""
        held = set("".join(p for p, _, _ in self.pieces))
        return "".join(c for c in map(chr, range(32)) if c not in held)

    def fallback(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode("utf-8", "replace")] if self.bytes else [self.unknown]

    def written(self) -> dict[int, bytes]:
        """What each identifier stands for; control pieces stand for nothing."""
        return {**{i: p.encode() for p, _, i in self.pieces}, **{i: bytes([b]) for b, i in enumerate(self.bytes)},
                **({} if self.bytes else {self.unknown: " ⁇ ".encode()})}

    def table(self, spark: SparkSession) -> DataFrame:
        if len(self.pieces) > MOST_PIECES:
            raise ValueError(f"a model has at most {MOST_PIECES} pieces")
        order = {x: r for r, x in enumerate(sorted({-s for _, s, _ in self.pieces}))}
        return spark.createDataFrame([(p, s, i, order[-s]) for p, s, i in self.pieces],
                                     "piece string, score double, id int, rank int")


def merge_pieces(word: str, ranks: dict[str, tuple[float, int]], model: Model) -> list[int]:
    """The pieces of one word of a BPE model, by a heap of neighbour pairs."""
    left, right = list(range(-1, len(word) - 1)), list(range(1, len(word) + 1))
    text, heap = list(word), []

    def offer(i: int) -> None:
        j = right[i]
        if j < len(word) and (found := ranks.get(text[i] + text[j])):
            heapq.heappush(heap, (-found[0], i, text[i], text[j]))

    for i in range(len(word) - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = right[i]
        if text[i] != a or j >= len(word) or text[j] != b:
            continue
        text[i], text[j], right[i] = a + b, "", right[j]
        if right[i] < len(word):
            left[right[i]] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    out: list[int] = []
    for t in text:
        if t:
            out += [ranks[t][1]] if t in ranks else model.fallback(t)
    return out


def words_of(text: str | None, lone: re.Pattern) -> list[str]:
    return lone.findall(MARK + text.replace(" ", MARK)) if text else []


def word_pattern(model: Model) -> re.Pattern:
    alone = re.escape(model.lone)
    return re.compile(f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+|[{alone}]" if alone
                      else f"{MARK}+[^{MARK}]*|[^{MARK}]+")


PACKED = ("chunk long, doc_ids array<long>, sizes array<long>, digests array<binary>, "
          "words array<string>, places binary")


def _pack(pattern: re.Pattern, marks_are_spaces: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for lo, hi in chunks(batch.column(1), CHUNK_BYTES):
                numbers: dict[str, int] = {}
                get, places, sizes, digests = numbers.setdefault, [], [], []
                for value in batch.column(1).slice(lo, hi - lo):
                    text = value.as_py()
                    words = words_of(text, pattern)
                    source = (text or "").replace(MARK, " ") if marks_are_spaces else text or ""
                    digests.append(hashlib.sha256(source.encode("utf-8", "replace")).digest())
                    places.append(np.array([get(w, len(numbers)) for w in words], np.int32))
                    sizes.append(len(words))
                # frequent words get small numbers, which compress better
                flat = np.concatenate(places)
                order = np.argsort(-np.bincount(flat, minlength=len(numbers)), kind="stable")
                rank = np.empty(len(numbers), np.int32)
                rank[order] = np.arange(len(numbers))
                words = list(numbers)
                flat = rank[flat] if len(flat) else flat
                planes = np.ascontiguousarray(flat.view(np.uint8).reshape(-1, 4).T)
                row = lambda values, kind: pa.ListArray.from_arrays(
                    pa.array([0, len(values)], pa.int32()), pa.array(values, kind))
                yield pa.RecordBatch.from_arrays([
                    pa.array([(part << 32) + number], pa.int64()),
                    row(batch.column(0).slice(lo, hi - lo).to_pylist(), pa.int64()), row(sizes, pa.int64()),
                    row(digests, pa.binary()), row([words[i] for i in order], pa.string()),
                    pa.array([squeeze.compress(planes.tobytes())], pa.binary())],
                    names=[f.split()[0] for f in PACKED.split(", ")])
                number += 1
    return run


def _places(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.int32).reshape(-1)


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def _matches(words: DataFrame, model: Model) -> DataFrame:
    """Each substring of a word (start, len, sub) that is a piece (id, score, rank) or one character."""
    ranked = model.table(words.sparkSession)
    size = F.length("word")
    cut = words.withColumn("size", size).withColumn(
        "start", F.explode(F.sequence(F.lit(0), F.col("size") - 1)))
    cut = cut.withColumn("len", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(model.longest), F.col("size") - F.col("start")))))
    cut = cut.withColumn("sub", F.substring("word", F.col("start") + 1, F.col("len")))
    return cut.join(F.broadcast(ranked), F.col("sub") == F.col("piece"), "left").filter(
        F.col("piece").isNotNull() | (F.col("len") == 1))


def _fallback(char: Column, model: Model) -> Column:
    """Identifiers for a character that is no piece: those of its bytes, or the unknown one."""
    if not model.bytes:
        return F.array(F.lit(model.unknown))
    digits = F.hex(F.encode(char, "UTF-8"))
    table = F.array(*map(F.lit, model.bytes))
    return F.transform(F.sequence(F.lit(0), F.octet_length(char) - 1), lambda i: F.element_at(
        table, F.conv(F.substring(digits, i * 2 + 1, F.lit(2)), 16, 10).cast("int") + 1))


def lattice(words: DataFrame, model: Model) -> DataFrame:
    """``word``, and ``edges`` as structs: cost (minus the score), start, end, ids."""
    low = min(s for _, s, _ in model.pieces) - UNKNOWN_PENALTY
    edge = F.struct((-F.coalesce("score", F.lit(low))).alias("cost"), "start",
                    (F.col("start") + F.col("len")).alias("end"),
                    F.when(F.col("piece").isNotNull(), F.array("id")).otherwise(
                        _fallback(F.col("sub"), model)).alias("ids"))
    return _matches(words, model).groupBy("word").agg(F.sort_array(F.collect_list(edge)).alias("edges"))


#: An edge as a long, for words of up to FOLD_CHARS: rank of the score (best first), start, length, identifier.
RANK_BITS, START_BITS, LEN_BITS, ID_BITS = 21, 6, 7, 21
NO_ID = (1 << ID_BITS) - 1


def packed_lattice(words: DataFrame, model: Model) -> DataFrame:
    """``word``, and ``edges`` as longs in order of rank, then start."""
    put = lambda c, bits: F.shiftleft(F.col(c).cast("long") if isinstance(c, str) else c, bits)
    rank = F.coalesce("rank", F.lit((1 << RANK_BITS) - 1)).cast("long")
    edge = (put(rank, START_BITS + LEN_BITS + ID_BITS).bitwiseOR(put("start", LEN_BITS + ID_BITS))
            .bitwiseOR(put("len", ID_BITS)).bitwiseOR(F.coalesce("id", F.lit(NO_ID)).cast("long")))
    return _matches(words, model).groupBy("word").agg(F.sort_array(F.collect_list(edge)).alias("edges"))


def fold_merges(word: Column, edges: Column, model: Model) -> Column:
    """Pieces of a BPE model: at each step the best edge over exactly two neighbours joins them.

    The fold's state has a bit for each boundary that is left.
    """
    def opened(e: Column) -> Column:
        take = lambda at, bits: F.shiftright(e, at).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
        start, size = take(LEN_BITS + ID_BITS, START_BITS), take(ID_BITS, LEN_BITS)
        end = start + size
        return F.struct(start.alias("start"), take(0, ID_BITS).alias("id"),
                        _bit(start).bitwiseOR(_bit(end)).alias("both"),
                        (_bit(end) - 1).bitwiseAND(F.bitwise_not(_bit(start + 1) - 1)).alias("inner"))

    ends = lambda s, e: s.bitwiseAND(e["both"]) == e["both"]
    whole = _bit(F.length(word) + 1) - 1

    def step(merges: Column, s: Column) -> Column:
        fits = F.filter(merges, lambda e: ends(s, e) & (F.bit_count(s.bitwiseAND(e["inner"])) == 1))
        return F.coalesce(s.bitwiseAND(F.bitwise_not(F.get(fits, F.lit(0))["inner"])), s)

    def pieces(es: Column) -> Column:
        merges = F.filter(es, lambda e: e["inner"] != 0)
        bounds = F.transform(F.array(merges), lambda m: F.aggregate(
            F.sequence(F.lit(1), F.length(word)), whole, lambda s, _: step(m, s)))
        chosen = F.transform(bounds, lambda s: F.array_sort(F.transform(
            F.filter(es, lambda e: ends(s, e) & (s.bitwiseAND(e["inner"]) == 0)),
            lambda e: F.struct(e["start"].alias("start"), e["id"].alias("id")))))
        return F.transform(F.get(chosen, F.lit(0)), lambda c: F.when(
            c["id"] != NO_ID, F.array(c["id"])).otherwise(
            _fallback(F.substring(word, c["start"] + 1, F.lit(1)), model)))

    # lists of one, so that edges are opened and the fold is run once
    return F.flatten(F.get(F.transform(F.array(F.transform(edges, opened)), pieces), F.lit(0)))


def fold_viterbi(word: Column, edges: Column) -> Column:
    """Pieces of a unigram model: the path of least cost, ties to the edge that starts first."""
    none = F.struct(F.lit(0.0).alias("cost"), F.lit(-1).alias("start"),
                    F.array().cast("array<int>").alias("ids"))

    def reach(best: Column, end: Column) -> Column:
        into = F.transform(F.filter(edges, lambda e: e["end"] == end), lambda e: F.struct(
            (F.get(best, e["start"])["cost"] + e["cost"]).alias("cost"), e["start"].alias("start"),
            e["ids"].alias("ids")))
        return F.concat(best, F.array(F.array_min(into)))

    best = F.aggregate(F.sequence(F.lit(1), F.length(word)), F.array(none), reach)
    start = F.struct(F.length(word).alias("at"), F.array().cast("array<int>").alias("ids"))

    def back(s: Column, _: Column, b: Column) -> Column:
        edge = F.get(b, s["at"])
        return F.when(s["at"] <= 0, s).otherwise(F.struct(
            edge["start"].alias("at"), F.concat(edge["ids"], s["ids"]).alias("ids")))

    return F.get(F.transform(F.array(best), lambda b: F.aggregate(
        F.sequence(F.lit(1), F.length(word)), start, lambda s, i: back(s, i, b))["ids"]), F.lit(0))


def _long_words(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = {p: (s, i) for p, s, i in model.pieces}
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([merge_pieces(w, ranks, model) for w in words],
                                           pa.list_(pa.int32()))], names=["word", "ids"])
    return run


def encode_words(words: DataFrame, model: Model) -> DataFrame:
    """``word`` and ``ids`` for distinct words (column ``word``, non-empty)."""
    if model.kind == UNIGRAM:
        return lattice(words, model).select("word", fold_viterbi(F.col("word"), F.col("edges")).alias("ids"))
    short = words.filter(F.length("word") <= FOLD_CHARS)
    told = packed_lattice(short, model).select(
        "word", fold_merges(F.col("word"), F.col("edges"), model).alias("ids"))
    long_ = words.filter(F.length("word") > FOLD_CHARS).select("word")
    return told.unionByName(long_.mapInArrow(_long_words(model), "word string, ids array<int>"))


def _assemble() -> Callable:
    """A chunk with its words' pieces -> per document the pieces."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        places, sizes = _places(left["places"][0].as_py()), np.array(left["sizes"][0].as_py(), np.int64)
        at = right["place"].to_numpy()
        lists = right["ids"].combine_chunks() if right.num_rows else pa.array([], pa.list_(pa.int32()))
        if isinstance(lists, pa.ChunkedArray):
            lists = pa.concat_arrays(lists.chunks)
        ends = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.to_numpy()
        n = int(at.max()) + 1 if len(at) else 0
        begin, length = np.zeros(n, np.int64), np.zeros(n, np.int64)
        begin[at], length[at] = ends[:-1], np.diff(ends)
        counts = length[places]
        total = np.append(0, np.cumsum(counts))
        ids = flat[np.repeat(begin[places] - total[:-1], counts) + np.arange(total[-1])] \
            if len(places) else flat[:0]
        docs = np.append(0, np.cumsum(sizes))
        return pa.table({
            "doc_id": left["doc_ids"].combine_chunks().flatten(),
            "n_pieces": pa.array(np.diff(total[docs])),
            "piece_ids": pa.ListArray.from_arrays(pa.array(total[docs].astype(np.int32)),
                                                  pa.array(ids.astype(np.int32))),
            "digest": left["digests"].combine_chunks().flatten()})
    return run


def _encode(docs: DataFrame, model_path: str, key: str, text: str, marks_are_spaces: bool) -> DataFrame:
    """One row per document: doc_id, n_pieces, piece_ids, digest of its text."""
    model = Model.load(model_path)
    bound_batches(docs.sparkSession)
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    packed = materialise(plain.mapInArrow(_pack(word_pattern(model), marks_are_spaces), PACKED), "pieces-chunks")
    listed = packed.select(F.col("chunk").alias("of"), F.posexplode("words").alias("place", "w"))
    known = materialise(encode_words(listed.select(F.col("w").alias("word")).distinct(), model), "pieces-words")
    met = listed.join(known, listed["w"] == known["word"]).select("of", "place", "ids")
    whole = packed.select("chunk", "doc_ids", "sizes", "digests", "places")
    return whole.groupBy("chunk").cogroup(met.groupBy("of")).applyInArrow(
        _assemble(), "doc_id long, n_pieces long, piece_ids array<int>, digest binary")


def encode_documents(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``encode_and_decode``, but a word mark in the text counts as a space."""
    return _told(_encode(docs, model_path, key, text, True), model_path)


def _decode(known: dict[int, bytes], at: int) -> Callable:
    """Batches with their texts added, from the pieces in column ``at``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = [known.get(i, b"") for i in range(max(known) + 1)]
        ends = np.append(0, np.cumsum([len(x) for x in pieces]))
        every = np.frombuffer(b"".join(pieces), np.uint8)
        for batch in batches:
            texts = []
            for row in batch.column(at):
                ids = np.asarray(row.values.to_numpy(zero_copy_only=False), float) if row.is_valid else np.zeros(0)
                # null identifiers are no numbers, and fail both comparisons
                ids = ids[(ids >= 0) & (ids < len(pieces))].astype(np.int64)
                sizes = ends[ids + 1] - ends[ids]
                total = np.append(0, np.cumsum(sizes))
                raw = every[np.repeat(ends[ids] - total[:-1], sizes) + np.arange(total[-1])].tobytes()
                texts.append(raw.decode("utf-8", "replace").replace(MARK, " ").removeprefix(" "))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, "text"])
    return run


def decode_documents(encoded: DataFrame, model_path: str, key: str = "doc_id",
                     ids: str = "piece_ids", others: tuple[str, ...] = ()) -> DataFrame:
    """One row per row: its identifier, ``others``, its pieces, and its text as ``text``."""
    columns = encoded.select(key, *others, ids)
    schema = StructType([*columns.schema.fields, StructField("text", StringType())])
    return columns.mapInArrow(_decode(Model.load(model_path).written(), len(columns.columns) - 1), schema)


def _told(encoded: DataFrame, model_path: str) -> DataFrame:
    back = decode_documents(encoded, model_path, others=("n_pieces", "digest"))
    same = F.sha2(F.encode("text", "UTF-8"), 256) == F.lower(F.hex("digest"))
    return back.select("doc_id", "n_pieces", "piece_ids", same.alias("round_trip"))


def encode_and_decode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_pieces, piece_ids, and whether decoding gives the text again."""
    return _told(_encode(docs, model_path, key, text, False), model_path)
