"""Words of many texts at once, as numbers and 64-bit hashes (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 4_000_000


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a column that hold about ``size`` bytes of text (one row at least)."""
    lengths = np.nan_to_num(np.asarray(pc.binary_length(texts).to_pandas(), float))
    total = np.cumsum(lengths)
    lo = 0
    while lo < len(lengths):
        base = total[lo - 1] if lo else 0.0
        hi = max(lo + 1, int(np.searchsorted(total, base + size, "right")))
        yield lo, hi
        lo = hi


def lower_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def number_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word numbers of all texts in a row, words per text, and the words by number."""
    numbers: dict[bytes, int] = {}
    get = numbers.setdefault
    ids: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = lower_words(text)
        counts[i] = len(words)
        ids.extend([get(w, len(numbers)) for w in words])
    return np.array(ids, np.int64), counts, list(numbers)


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Per text, the sorted distinct 64-bit hashes of its runs of ``width`` words.

    A text with fewer words has one: the whole sequence.  One without words has none.
    """
    ids, counts, words = number_words(texts)
    hashes = mix(hash_words(words))[ids] if len(ids) else np.zeros(0, np.uint64)
    step = np.uint64(0x9E3779B97F4A7C15)
    n = max(len(ids) - width + 1, 0)
    runs = np.full(n, width, np.uint64)
    for k in range(width):
        runs = runs * step + hashes[k:k + n]
    runs = mix(runs)
    sets, at = [], 0
    for c in counts:
        if c >= width:
            sets.append(np.unique(runs[at:at + c - width + 1]))
        elif c:
            h = np.uint64(c)
            with np.errstate(over="ignore"):
                for k in range(c):
                    h = h * step + hashes[at + k]
            sets.append(mix(np.array([h], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += c
    return sets
