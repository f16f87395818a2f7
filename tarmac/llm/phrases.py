"""Phrase collocations by Toivonen mining (operator 12).

Phrases are runs of 1 to ``LONGEST`` words within a piece of text (between
punctuation and line ends), counted by stratum (language), overlaps included.
A phrase is frequent at ``least`` occurrences.

1.  *Sample.* A share of the documents, by a hash of the row, is mined at a
    lowered threshold: words and pairs first, then longer phrases whose pairs
    were all found.  This proposes the phrases.
2.  *Full pass.* All documents are read once.  Counted exactly are the
    proposed phrases and their negative border: every phrase that was not
    proposed although its first and last words-but-one parts both were
    (all single words are).  Most of the border is rare, so the pass adds up
    counts by 64-bit hashes first; then the phrases whose hash is frequent are
    read again, spelled and counted exactly.  A hash of two phrases costs a
    counted phrase too many.
3.  *Expansion.*  A border phrase that turns out frequent is a failure: longer
    phrases may contain it that the full pass has not counted.  The second
    reading counts these as well: every phrase with a failure in it whose other
    parts are frequent.  A frequent phrase that the full pass left out has a
    part that was not proposed, and the least such part was counted and is a
    failure.  So every frequent phrase has then been counted, exactly.

Tasks know the admitted phrases by a Bloom filter of fixed size, so what is
broadcast does not grow with the corpus.  A false positive costs a counted
phrase too many and changes nothing: the filter decides what is counted, the
counts of the second reading decide what is frequent.

Cutting a phrase after its first k words gives score floor(2000000 a / (l + r));
the least over k counts (the smaller k among equals).  A candidate is dropped
when a longer one around it has 80 % of its occurrences or more.

Defined cases: null text counts as empty, a null stratum as ``und``; A-Z are
lower-cased; a text of any length is read whole; repeated rows count each;
without frequent phrases, or for an empty table, the result is empty; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import bound_batches, materialise, text_of
from tarmac.llm.words import chunks, hash_words, mix

LONGEST = 4
LEAST = 30
SAMPLE = 0.2
TOP = 2_000
CHUNK_BYTES = 8_000_000
#: Bits of the filter of admitted phrases, and bits set for each.
FILTER_BITS, FILTER_HASHES = 1 << 26, 4
#: Bits of one bitmap of Spark's ``bitmap_construct_agg``.
BITMAP = 1 << 15

# Characters that end a piece, and the table that makes them line ends and tabs spaces.
ENDS = b".,;:!?\n\x0b\x0c\r"
PLAIN = bytes.maketrans(ENDS + b"\t", b"\n" * len(ENDS) + b" ")
COUNTED = "lang string, phrase string, words int, n long"


def number_pieces(texts: list[str | None]) -> tuple[np.ndarray, pa.Array]:
    """Word numbers of all texts in a row, -1 between pieces, and the words (strings) by number."""
    raw = b"".join([(t or "").encode("utf-8", "surrogatepass").lower().translate(PLAIN) + b"\n" for t in texts])
    chars = np.frombuffer(raw, np.uint8)
    end = chars == 10
    inside = ~end & (chars != 32)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    spoken = chars[inside]
    starts = np.cumsum(inside, dtype=np.int64)[begins] - 1
    offsets = np.append(starts, len(spoken)).astype(np.int64)
    said = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(spoken)])
    coded = said.dictionary_encode()
    ids = np.full(len(chars), -2, np.int64)
    ids[end] = -1
    ids[begins] = coded.indices.to_numpy()
    return ids[begins | end], coded.dictionary


class Filter:
    """A Bloom filter of phrases, given by 64-bit hashes."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits  # bytes

    @staticmethod
    def places(hashes: np.ndarray) -> np.ndarray:
        """The bits of each hash, one row each."""
        step = mix(hashes ^ np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        nth = np.arange(FILTER_HASHES, dtype=np.uint64)
        return (hashes[:, None] + nth * step[:, None]) & np.uint64(FILTER_BITS - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        mask, seven = np.uint64(FILTER_BITS - 1), np.uint64(7)
        set_ = lambda at: self.bits[at >> np.uint64(3)] >> (at & seven).astype(np.uint8) & np.uint8(1) > 0
        out = set_(hashes & mask)
        left = np.flatnonzero(out)  # most fall at the first bit
        h = hashes[left]
        step = mix(h ^ np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        held = np.ones(len(left), bool)
        for nth in range(1, FILTER_HASHES):
            held &= set_(h + np.uint64(nth) * step & mask)
        out[left] = held
        return out


def phrase_hashes(words: list[np.ndarray], lang: str) -> np.ndarray:
    """Hashes of phrases from those of their words, one array for each position."""
    h = np.full(len(words[0]), hash_words([lang.encode("utf-8", "surrogatepass")])[0], np.uint64)
    for w in words:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w)
    return h


def spell_phrases(words: pa.Array, spell: np.ndarray) -> pa.Array:
    """Phrases as strings, from their words' numbers, a row each."""
    if not spell.shape[1]:
        return pa.array([""] * len(spell), pa.string())
    said = [words.take(pa.array(column)) for column in spell.T]
    return (said[0] if len(said) == 1 else pc.binary_join_element_wise(*said, pa.scalar(b" ", words.type))).cast(
        pa.large_string()).cast(pa.string())


def numbered_phrases(texts: list[str | None], lang: str, sizes: range, admitted: Filter | None, earlier: Filter | None,
                     everything: bool, fresh: Filter | None = None) -> Iterator[tuple]:
    """Phrases of some texts of one language: the words, a phrase's words by number, their hashes, and the counts.

    A phrase of one word is always admitted, a longer one if ``admitted`` holds
    the parts without its last and its first word (``everything``: always).
    Left out is what a pass with ``earlier`` as its filter has counted.  Phrases
    are told apart exactly.
    With ``fresh``, a phrase is admitted if ``admitted`` holds it or a shorter
    part is one of ``fresh``, and its parts are admitted; the phrase of no words
    then comes first, counted once for each word.
    """
    ids, words = number_pieces(texts)
    if not len(words):
        return
    hashes = mix(hash_words(words.to_pylist()))
    place = np.flatnonzero(ids >= 0)            # where phrases of the current size begin
    if fresh is not None:
        yield words, np.zeros((1, 0), np.int64), [], np.array([len(place)])
    code = ids[place]                           # their numbers; each number is one phrase
    spell = np.arange(len(words))[:, None]      # the words of each number
    near = np.zeros(len(words), bool)           # whether one of ``fresh`` is in it
    for size in range(1, sizes[-1] + 1):
        if size > 1:
            # phrases of size - 1 that begin at neighbouring words make one of this size
            at = np.full(len(ids) + 1, -1, np.int64)
            at[place] = np.arange(len(place))
            follows = at[place + 1]
            keep = follows >= 0
            if not len(spell) or not keep.any():
                return
            left, right = code[keep], code[follows[keep]]
            place = place[keep]
            coded = pa.array(left * len(spell) + right).dictionary_encode()
            pairs, code = coded.dictionary.to_numpy(), coded.indices.to_numpy().astype(np.int64)
            first, last = pairs // len(spell), pairs % len(spell)
            spell = np.concatenate([spell[first], spell[last][:, -1:]], 1)
            near = near[first] | near[last]
        counts = np.bincount(code, minlength=len(spell))
        parts = [hashes[spell[:, k]] for k in range(size)]
        held = None
        if fresh is not None:
            own = phrase_hashes(parts, lang)
            held = near | admitted.holds(own)
            near[held] |= fresh.holds(own[held])
        elif admitted is not None and size < sizes[-1]:
            held = admitted.holds(phrase_hashes(parts, lang))
        if size in sizes:
            out = np.ones(len(spell), bool) if fresh is None else held.copy()
            if size > 1 and not everything and fresh is None:
                out = _admits(admitted, parts, lang)
            if earlier is not None and size > 1 and out.any():
                out[out] = ~_counts(earlier, [p[out] for p in parts], lang)
            told = np.flatnonzero(out)
            if len(told):
                yield words, spell[told], [p[told] for p in parts], counts[told]
        # only phrases that the filter holds can be part of a longer one that is admitted
        if held is not None and size < sizes[-1]:
            on = held[code]
            place, code = place[on], code[on]
            renumber = np.cumsum(held) - 1
            code, spell, near = renumber[code], spell[held], near[held]


def count_phrases(texts: list[str | None], lang: str, *how, **more) -> Iterator[tuple[list[str], int, np.ndarray]]:
    """Phrases as in ``numbered_phrases``, spelled, their number of words, and their counts."""
    for words, spell, _, counts in numbered_phrases(texts, lang, *how, **more):
        yield spell_phrases(words, spell).to_pylist(), spell.shape[1], counts


def _admits(f: Filter, parts: list[np.ndarray], lang: str) -> np.ndarray:
    out = f.holds(phrase_hashes(parts[:-1], lang))
    if out.any():
        out[out] = f.holds(phrase_hashes([p[out] for p in parts[1:]], lang))
    return out


def _counts(f: Filter, parts: list[np.ndarray], lang: str) -> np.ndarray:
    """Which phrases a pass with this filter counts: those of which it holds every part.

    Both parts of one word less are not enough: the filter may hold them by mistake,
    and the pass has not come to them if it does not hold something inside.
    """
    out = np.ones(len(parts[0]), bool)
    for size in range(1, len(parts)):
        for at in range(len(parts) - size + 1):
            if out.any():
                out[out] = f.holds(phrase_hashes([p[out] for p in parts[at:at + size]], lang))
    return out


def _by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """Languages and their texts, a chunk after another."""
    for batch in batches:
        for lo, hi in chunks(batch.column(1), CHUNK_BYTES):
            of: dict[str, list] = {}
            for lang, text in zip(batch.column(0).slice(lo, hi - lo).to_pylist(),
                                  batch.column(1).slice(lo, hi - lo).to_pylist()):
                of.setdefault(lang, []).append(text)
            yield from of.items()


def _counted(sizes: range, admitted, earlier, everything: bool, fresh) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = Filter(admitted.value) if admitted is not None else None
        before = Filter(earlier.value) if earlier is not None else None
        near = Filter(fresh.value) if fresh is not None else None
        for lang, own in _by_chunk(batches):
            for words, spell, _, n in numbered_phrases(own, lang, sizes, now, before, everything, near):
                for k in range(0, len(spell), 100_000):
                    part = spell_phrases(words, spell[k:k + 100_000])
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(part), pa.string()), part,
                        pa.array(np.full(len(part), spell.shape[1], np.int32)),
                        pa.array(n[k:k + 100_000].astype(np.int64))],
                        names=["lang", "phrase", "words", "n"])
    return run


def _hashed(sizes: range, admitted) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = Filter(admitted.value)
        for lang, own in _by_chunk(batches):
            for _, _, parts, n in numbered_phrases(own, lang, sizes, now, None, False):
                hashes = phrase_hashes(parts, lang).view(np.int64)
                for k in range(0, len(hashes), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(hashes[k:k + 100_000]),
                                                      pa.array(n[k:k + 100_000].astype(np.int64))], names=["hash", "n"])
    return run


def _count(texts: DataFrame, sizes: range, admitted=None, earlier=None,
           everything: bool = False, fresh=None) -> DataFrame:
    found = texts.mapInArrow(_counted(sizes, admitted, earlier, everything, fresh), COUNTED)
    return found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))


def _hashes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, rows in _by_lang(batch):
            for size in {len(r) for r in rows}:
                same = [r for r in rows if len(r) == size]
                parts = [mix(hash_words([r[k] for r in same])) for k in range(size)]
                yield pa.RecordBatch.from_arrays([pa.array(phrase_hashes(parts, lang).view(np.int64))], names=["hash"])


def hashes_of(phrases: DataFrame) -> DataFrame:
    """``hash`` of each ``lang`` and ``phrase``, as in ``_hashed``."""
    return phrases.select("lang", "phrase").mapInArrow(_hashes_of, "hash long")


def _by_lang(batch: pa.RecordBatch) -> list[tuple[str, list[list[bytes]]]]:
    of: dict[str, list] = {}
    for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        of.setdefault(lang, []).append(phrase.encode("utf-8", "surrogatepass").split(b" "))
    return list(of.items())


def _filter_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = Filter.places(batch.column(0).to_numpy().view(np.uint64)).ravel().astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(bits))], names=["bit"])


def make_filter(spark: SparkSession, hashes: DataFrame):
    """A broadcast Bloom filter of phrases given by ``hash``: FILTER_BITS bits, whatever the phrases' number."""
    bits = hashes.select("hash").mapInArrow(_filter_bits, "bit long")
    maps = bits.groupBy((F.col("bit") / BITMAP).cast("long").alias("at")).agg(
        F.expr(f"bitmap_construct_agg(bit % {BITMAP})").alias("map"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in maps.toLocalIterator():
        raw = np.frombuffer(bytes(row["map"]), np.uint8)
        out[row["at"] * (BITMAP // 8):][:BITMAP // 8] = raw[:BITMAP // 8]
    return spark.sparkContext.broadcast(out)


def lowered(least: int, share: float) -> int:
    """The sample's threshold: what a phrase of ``least`` occurrences seldom falls short of there."""
    expected = least * share
    return max(2, int(expected - 1.65 * expected ** 0.5)) if share < 1 else least


def count_frequent(spark: SparkSession, texts: DataFrame, proposed: DataFrame, least: int,
                   longest: int) -> tuple[DataFrame, DataFrame]:
    """All phrases of ``least`` occurrences or more, and all words' number by lang, in two readings of the texts."""
    known = materialise(hashes_of(proposed), "phrases-known")
    sums = texts.mapInArrow(_hashed(range(1, longest + 1), make_filter(spark, known)), "hash long, n long")
    often = materialise(sums.groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("hash"),
                        "phrases-hashes")
    # frequent and not proposed: failures of the border
    failures = make_filter(spark, often.join(known, "hash", "left_anti"))
    exact = _count(texts, range(1, longest + 1), make_filter(spark, often), fresh=failures)
    counted = materialise(exact.filter((F.col("n") >= least) | (F.col("words") == 0)), "phrases-frequent")
    return counted.filter("words > 0"), counted.filter("words = 0").select("lang", "n")


def propose(spark: SparkSession, texts: DataFrame, least: int, share: float, longest: int) -> DataFrame:
    """``lang`` and ``phrase``: what a share of the documents shows to be frequent, perhaps."""
    sample = texts.filter(F.col("row_hash") % 1_000_000 < int(share * 1_000_000)).select("lang", "text")
    at = F.col("n") >= lowered(least, share)
    short = materialise(_count(sample, range(1, min(2, longest) + 1), everything=True).filter(at), "phrases-short")
    if longest < 3:
        return short.select("lang", "phrase")
    within = make_filter(spark, hashes_of(short))
    long = _count(sample, range(3, longest + 1), within, everything=True).filter(at)
    return materialise(short.unionByName(long).select("lang", "phrase"), "phrases-proposed")


def frequent_phrases(docs: DataFrame, text: str = "text", stratum: str = "lang", least: int = LEAST,
                     share: float = SAMPLE, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """All phrases of ``least`` occurrences or more (lang, phrase, words, n), and all words' number by lang."""
    spark = docs.sparkSession
    bound_batches(spark)
    # copies of a text are drawn one by one, if other columns tell them apart
    hashable = [f.name for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)]
    texts = docs.select(F.coalesce(F.col(stratum).cast("string"), F.lit("und")).alias("lang"),
                        text_of(text).alias("text"),
                        F.pmod(F.xxhash64(*hashable), F.lit(1_000_000_007)).alias("row_hash"))
    proposed = propose(spark, texts, least, share, longest)
    texts = texts.select("lang", "text")
    return count_frequent(spark, texts, proposed, least, longest)


def collocations(docs: DataFrame, text: str = "text", stratum: str = "lang", least: int = LEAST,
                 top: int = TOP, share: float = SAMPLE, longest: int = LONGEST) -> DataFrame:
    """Each stratum's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    found, totals = frequent_phrases(docs, text, stratum, least, share, longest)
    candidates = found.filter("words > 1").withColumnRenamed("n", "a")
    words = F.split("phrase", " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("first", F.array_join(F.slice(words, F.lit(1), F.col("k")), " "))
    cuts = cuts.withColumn("rest", F.array_join(F.slice(words, F.col("k") + 1, F.col("words") - F.col("k")), " "))
    part = lambda name, n: found.select(F.col("lang"), F.col("phrase").alias(name), F.col("n").alias(n))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    exact = "(cast(2000000 as decimal(38, 0)) * cast(a as decimal(20, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))"
    scored = (cuts.withColumn("score", F.expr(exact).cast("long"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    # each phrase's most frequent longer candidate around it
    start = F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1))
    inner = (candidates.filter("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
             .withColumn("start", start)
             .select("lang", F.array_join(F.slice(words, F.col("start"), F.col("size")), " ").alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("around")))
    kept = (scored.join(inner, ["lang", "phrase"], "left")
            .filter(F.coalesce(F.lit(100) * F.col("around") < F.lit(80) * F.col("a"), F.lit(True))))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    # a row per stratum
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
