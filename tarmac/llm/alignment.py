"""Cross-tokenizer alignment by whitespace-token anchors (operator 13).

1.  Each text is tokenised as a whole by both models, A (byte-level BPE) over
    space + text and B (SentencePiece) over the text, which gets its space
    from the model.  A text takes part when the tokens' bytes, put together,
    are space + text for both.
2.  *Anchors*: byte offsets at which a token of A and one of B end (verified
    on the running sums of token lengths) and both next tokens are marked by
    a leading space.  They cut the text into windows of token identifiers.
3.  A window's alignment hangs on its identifiers alone, so it is worked out
    once per pair of identifier tuples and chunk of texts: byte offsets at
    which both sides end cut it into groups, and the two tokens that end
    there are linked.
4.  Links are counted by pair of identifiers, first per chunk, then by a
    shuffle over the corpus, and the counts are joined back to the chunks'
    distinct pairs.  The most frequent pair of each identifier of B follows
    from the counts; that table has a row per identifier of the model.

Chunks hold windows as numbers into their own window list, so the corpus is
tokenised once.

Output: one row per document with its groups, ``a1,a2|b1;a3|b2,b3``
(identifiers in order; ``group_arrays`` takes them apart), and counts.

Defined cases: a null or empty text, or one whose joined bytes differ (B
writes the word mark U+2581 as a space, for one), has no tokens: zeros and
an empty string; special tokens' strings in a text are plain text; repeated
rows are aligned and counted each, whatever their identifiers; identifiers
may be null and of any type; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import bound_batches, kept_by_worker, materialise
from tarmac.llm.words import chunks, mix

CHUNK_BYTES = 4_000_000
MARK = "▁"
#: Identifiers of B fit into so many bits of a pair's code.
B_BITS = 31


# Fixed value: how byte-level BPE splits text before its merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class TokenizerA:
    """Byte-level BPE from a ``tokenizers`` file; the bytes of each identifier.

    Where the identifiers follow the order of the merges, as the file's model
    has them, the ranks are taken from the file and merged by ``tiktoken``, which
    gives the same tokens in a fraction of the time.
    """

    def __init__(self, path: str):
        of = byte_of_char()
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        vocabulary = model["vocab"]
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.bytes[i] = bytes(of[c] for c in entry) if all(c in of for c in entry) else entry.encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        split = told.get("pre_tokenizer") or {}
        in_order = (not told.get("normalizer") and not model.get("ignore_merges") and not model.get("unk_token")
                    and all(split.get(k) == v for k, v in plain.items())
                    and all(vocabulary.get(x + y) == 256 + k for k, (x, y) in enumerate(merges))
                    and sorted(vocabulary[c] for c in of if c in vocabulary) == list(range(256)))
        if in_order:
            from tiktoken import Encoding
            ranks = {self.bytes[i]: i for i in range(256 + len(merges))}
            self._encode = Encoding("byte level", pat_str=SPLIT, mergeable_ranks=ranks,
                                    special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer
            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            self._encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        return self._encode(" " + text)


class TokenizerB:
    """A SentencePiece model that adds a space in front; the bytes of each identifier."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i)
                              else piece.replace(MARK, " ").encode())

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


def byte_of_char() -> dict[str, int]:
    """Byte-level BPE's letters: printable Latin-1 bytes stand for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def tokenizers(path_a: str, path_b: str) -> tuple[TokenizerA, TokenizerB]:
    return kept_by_worker(f"tokenizers {path_a} {path_b}", lambda: (TokenizerA(path_a), TokenizerB(path_b)))


class Side:
    """What a tokenizer's identifiers look like: bytes, their number, and whether a space leads."""

    def __init__(self, tokenizer: TokenizerA | TokenizerB):
        self.encode, self.bytes = tokenizer.encode, tokenizer.bytes
        self.size = np.array([len(b) for b in self.bytes], np.int64)
        self.spaced = np.array([b[:1] == b" " for b in self.bytes])

    def tokens(self, text: str, whole: bytes) -> np.ndarray | None:
        ids = self.encode(text)
        if b"".join(map(self.bytes.__getitem__, ids)) != whole:
            return None
        out = np.array(ids, np.int32)
        return out[self.size[out] > 0]


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _ranges(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers from each ``first`` on, ``lengths`` of them, in a row."""
    return np.repeat(first - _starts(lengths), lengths) + np.arange(lengths.sum())


#: What follows an identifier where groups are written.
NEXT, OTHER_SIDE, NEXT_GROUP, NEXT_WINDOW = range(4)
SIGNS = ",|;\n"


class Aligned:
    """Windows in a row, cut into groups where both sides' tokens end.

    Windows cover the same bytes on both sides, so their ends meet as those of
    groups do, and all are aligned by one comparison of running sums.
    """

    def __init__(self, a: Side, b: Side, ids_a: np.ndarray, ids_b: np.ndarray, sizes: np.ndarray):
        _, self.last_a, self.last_b = np.intersect1d(
            np.cumsum(a.size[ids_a]), np.cumsum(b.size[ids_b]), assume_unique=True, return_indices=True)
        self.ids_a, self.ids_b = ids_a, ids_b
        #: the last group of each window
        self.closing = np.searchsorted(self.last_a, np.cumsum(sizes[:, 0]) - 1)
        self.groups = np.diff(self.closing, prepend=-1)
        self.links = ids_a[self.last_a].astype(np.int64) << B_BITS | ids_b[self.last_b]

    def written(self, numbers: list[str]) -> str:
        """A line for each window, its groups as ``a1,a2|b1;a3|b2,b3``; ``numbers``: see ``signed_numbers``."""
        per_a, per_b = np.diff(self.last_a, prepend=-1), np.diff(self.last_b, prepend=-1)
        follow_a = np.full(len(self.ids_a), NEXT, np.int64)
        follow_a[self.last_a] = OTHER_SIDE
        follow_b = np.full(len(self.ids_b), NEXT, np.int64)
        follow_b[self.last_b] = NEXT_GROUP
        follow_b[self.last_b[self.closing]] = NEXT_WINDOW
        out = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        out[np.arange(len(self.ids_a)) + np.repeat(_starts(per_b), per_a)] = self.ids_a * len(SIGNS) + follow_a
        out[np.arange(len(self.ids_b)) + np.repeat(np.cumsum(per_a), per_b)] = self.ids_b * len(SIGNS) + follow_b
        return "".join(map(numbers.__getitem__, out.tolist()))[:-1]


def signed_numbers(a: Side, b: Side) -> list[str]:
    """Each identifier followed by each of SIGNS."""
    return [f"{i}{sign}" for i in range(max(len(a.bytes), len(b.bytes))) for sign in SIGNS]


class Windows:
    """The windows of some texts in a row, and the distinct ones among them.

    Windows are told apart by their tuples of identifiers: they are numbered by
    a 64-bit hash, and every window is compared with the first of its number;
    should one differ, all are numbered anew by another hash.
    """

    def __init__(self, a: Side, b: Side, ids: tuple[np.ndarray, np.ndarray]):
        self.sides, self.ids = (a, b), ids
        ends = self._anchors() if len(ids[0]) else (np.zeros(0, np.int64),) * 2
        self.ends = ends[0]                               # in tokens of A
        self.sizes = np.stack([np.diff(e, prepend=0) for e in ends], 1)
        self.first = np.stack([_starts(n) for n in self.sizes.T], 1)
        seed = 0
        while not self._numbered(seed):
            seed += 1

    def _anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens up to the shared ends that a space-marked token follows on both sides; every text starts so."""
        before = [np.append(np.flatnonzero(side.spaced[x[1:]]), len(x) - 1) for side, x in zip(self.sides, self.ids)]
        offsets = [np.cumsum(side.size[x])[at] for side, x, at in zip(self.sides, self.ids, before)]
        _, at_a, at_b = np.intersect1d(*offsets, assume_unique=True, return_indices=True)
        return before[0][at_a] + 1, before[1][at_b] + 1

    def _numbered(self, seed: int) -> bool:
        step, keys = np.uint64(0x9E3779B97F4A7C15), np.full(len(self.sizes), seed, np.uint64)
        for side in (0, 1):
            n = self.sizes[:, side]
            place = _ranges(np.zeros(len(n), np.int64), n).astype(np.uint64)
            told = mix(self.ids[side].astype(np.uint64) + step * (place + np.uint64(seed)))
            keys = mix(keys * step + np.add.reduceat(told, self.first[:, side])) if len(n) else keys
        _, self.kept, self.numbers = np.unique(keys, return_index=True, return_inverse=True)
        like = self.kept[self.numbers]
        return bool((self.sizes[like] == self.sizes).all()) and all(
            (x[_ranges(self.first[like, side], self.sizes[:, side])] == x).all() for side, x in enumerate(self.ids))

    def aligned(self, order: np.ndarray) -> tuple[np.ndarray, Aligned]:
        """The distinct windows in ``order``: tokens of A, of B and groups of each; their alignment."""
        kept = self.kept[order]
        ids = [x[_ranges(self.first[kept, side], self.sizes[kept, side])] for side, x in enumerate(self.ids)]
        told = Aligned(*self.sides, *ids, self.sizes[kept])
        return np.column_stack([self.sizes[kept], told.groups]), told


def tokens_of(a: Side, b: Side, text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A text's tokens on both sides; none when a side's bytes are not space + text."""
    whole = (" " + text).encode("utf-8", "surrogatepass") if text else b""
    own_a = a.tokens(text, whole) if text else None
    own_b = b.tokens(text, whole) if own_a is not None else None
    return (own_a, own_b) if own_b is not None else (np.zeros(0, np.int32),) * 2


def _squeezed(values: np.ndarray) -> bytes:
    """Integers as zstd over their byte planes."""
    planes = np.ascontiguousarray(values.astype(np.int32).view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unsqueezed(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.int32).reshape(-1)


def _chunk_schema(key: T.DataType) -> T.StructType:
    field = T.StructField
    return T.StructType([
        field("chunk", T.LongType()), field("keys", T.ArrayType(key)),
        field("windows", T.ArrayType(T.LongType())),      # of each text
        field("places", T.BinaryType()),                  # the texts' windows in a row
        field("groups", T.BinaryType()),                  # of the distinct windows: a line each
        field("sizes", T.BinaryType()),                   # three of each distinct window
        field("window_links", T.BinaryType()),            # links of the distinct windows in a row
        field("pairs", T.ArrayType(T.LongType())),        # distinct pair codes; links are numbers into them
        field("counts", T.ArrayType(T.LongType())),       # how many links of the chunk hold each
    ])


def _sides(path_a: str, path_b: str) -> tuple[Side, Side, list[str]]:
    a, b = map(Side, tokenizers(path_a, path_b))
    return a, b, signed_numbers(a, b)


def _packed(path_a: str, path_b: str, schema: T.StructType) -> Callable:
    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        a, b, signed = kept_by_worker(f"sides {path_a} {path_b}", lambda: _sides(path_a, path_b))
        for batch in batches:
            for lo, hi in chunks(batch.column(1), CHUNK_BYTES):
                each = [tokens_of(a, b, value.as_py()) for value in batch.column(1).slice(lo, hi - lo)]
                windows = Windows(a, b, tuple(np.concatenate(x) for x in zip(*each)))
                until = np.searchsorted(windows.ends, np.cumsum([len(x) for x, _ in each]), "right")
                flat = windows.numbers
                # frequent windows get small numbers, which compress better
                n = len(windows.kept)
                seen = np.bincount(flat, minlength=n)
                order = np.argsort(-seen, kind="stable")
                rank = np.empty(n, np.int64)
                rank[order] = np.arange(n)
                sizes, told = windows.aligned(order)
                pairs, numbers = np.unique(told.links, return_inverse=True)
                counts = np.bincount(numbers, np.repeat(seen[order], told.groups), len(pairs))
                row = {
                    "chunk": (part << 32) + nth, "keys": batch.column(0).slice(lo, hi - lo).to_pylist(),
                    "windows": np.diff(until, prepend=0).tolist(), "places": _squeezed(rank[flat] if n else flat),
                    "groups": zstandard.ZstdCompressor(level=1).compress(told.written(signed).encode()),
                    "sizes": _squeezed(sizes.ravel()),
                    "window_links": _squeezed(numbers), "pairs": pairs.tolist(),
                    "counts": counts.astype(np.int64).tolist()}
                yield pa.RecordBatch.from_pylist([row], schema=target)
                nth += 1
    return run


ALIGNED = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()),
           ("n_best", T.LongType()), ("count_sum", T.LongType()), ("groups", T.StringType())]
#: Rows that leave a task at a time hold about so many characters of groups.
OUT_CHARS = 4_000_000


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with their pairs' corpus counts -> one row per document."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = lambda name: batch.column(batch.schema.get_field_index(name))[at]  # noqa: E731,B023
            keys, per_text = row("keys").values, np.array(row("windows").as_py(), np.int64)
            places, sizes = _unsqueezed(row("places").as_py()), _unsqueezed(row("sizes").as_py()).reshape(-1, 3)
            links = _unsqueezed(row("window_links").as_py())
            lines = zstandard.ZstdDecompressor().decompress(row("groups").as_py()).decode()
            groups = lines.split("\n") if lines else []
            told = row("told").values
            n = len(row("pairs").values) if row("pairs").values is not None else 0
            total, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
            if n:
                place = np.asarray(told.field("place"))
                total[place], best[place] = np.asarray(told.field("total")), np.asarray(told.field("best"))
            window = np.repeat(np.arange(len(groups)), sizes[:, 2])
            of_window = np.zeros((len(groups), 5), np.int64)
            of_window[:, :3] = sizes
            np.add.at(of_window[:, 3], window, best[links])
            np.add.at(of_window[:, 4], window, total[links])
            sums = np.zeros((len(places) + 1, 5), np.int64)
            np.cumsum(of_window[places], 0, out=sums[1:])
            ends = np.cumsum(per_text)
            out = sums[ends] - sums[ends - per_text]
            text, lo, chars = [], 0, 0
            for k, (end, size) in enumerate(zip(ends.tolist(), per_text.tolist())):
                text.append(";".join(map(groups.__getitem__, places[end - size:end].tolist())))
                chars += len(text[-1])
                if chars > OUT_CHARS or k == len(ends) - 1:
                    x = out[lo:k + 1]
                    columns = [x[:, 0], x[:, 1], x[:, 2], x[:, 2], x[:, 3], x[:, 4]]
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(lo, k + 1 - lo), *map(pa.array, columns), pa.array(text, pa.string())],
                        names=["key", *[name for name, _ in ALIGNED]])
                    text, lo, chars = [], k + 1, 0


def pair_counts(packed: DataFrame) -> DataFrame:
    """``pair``, ``total`` (links of the corpus that hold it) and ``best`` (1: no pair of its B id has more)."""
    pairs = materialise(packed.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
                        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("total")),
                        "alignment-pairs")
    b = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    # a row per identifier of the model: bounded
    most = pairs.groupBy(b.alias("b")).agg(F.max("total").alias("most"))
    return pairs.join(F.broadcast(most), b == F.col("b")).select(
        "pair", "total", (F.col("total") == F.col("most")).cast("long").alias("best"))


def align_documents(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text",
                    ) -> DataFrame:
    """One row per document: the key (as ``key``), token, group and link counts, and ``groups``."""
    bound_batches(docs.sparkSession)
    kind = docs.schema[key].dataType
    schema = _chunk_schema(kind)
    packed = materialise(docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        _packed(path_a, path_b, schema), schema), "alignment-chunks")
    own = packed.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    # the distinct pairs of a chunk are bounded by the chunk
    told = own.join(pair_counts(packed), "pair").groupBy("chunk").agg(
        F.collect_list(F.struct("place", "total", "best")).alias("told"))
    both = packed.join(told.withColumnRenamed("chunk", "of"), F.col("chunk") == F.col("of"), "left")
    out = T.StructType([T.StructField("key", kind), *[T.StructField(n, t) for n, t in ALIGNED]])
    return both.drop("of", "counts").mapInArrow(_aligned, out)


def group_arrays(groups: Column) -> Column:
    """``groups`` as an array of structs of two arrays of identifiers, ``a`` and ``b``."""
    ids = lambda x: F.split(x, ",").cast("array<int>")
    each = F.transform(F.split(groups, ";"), lambda g: F.struct(
        ids(F.split(g, "\\|")[0]).alias("a"), ids(F.split(g, "\\|")[1]).alias("b")))
    return F.when(groups != "", each).otherwise(F.array().cast("array<struct<a:array<int>,b:array<int>>>"))
