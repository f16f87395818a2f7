"""A linear-chain conditional random field with two tags, in numpy.

A token is clean (0) or toxic (1).  Its emission is the sum of the weights
of its features (hashed into a table of fixed size); the transitions weigh
a tag by the one before it.  Only differences count: the emission is the
toxic tag's advantage.

``marginals`` is forward-backward over whole texts of any length.  Texts are
cut into blocks; first every block's transfer matrix is multiplied out, all
blocks side by side; then the messages between blocks go along each text;
then the messages inside the blocks follow, again side by side.  The result
is that of the plain recursion, and a text of n tokens needs about
n / BLOCK + 3 BLOCK steps.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np

from tarmac.llm.words import mix

TABLE_BITS = 18
BLOCK = 64
#: Emissions are held within these bounds, so products stay in range.
MOST = 30.0
PREFIXES = range(3, 9)
SUFFIXES = (3, 4)
#: Features of a word, own ones and as the token before or after.
WIDTH = 1 + 2 * len(PREFIXES) + len(SUFFIXES) + 2

TOKEN = re.compile(r"\w+")


def _code_points(words: list[str], width: int) -> np.ndarray:
    """Their first ``width`` code points, one row each; 0 after a word's end."""
    return np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint64)


def _places(hashes: np.ndarray, kind: int) -> np.ndarray:
    """Places in the weight table for features of one kind; never 0, which is no feature."""
    at = mix(hashes ^ np.uint64(kind << 56)) >> np.uint64(64 - TABLE_BITS)
    return np.maximum(at, 1).astype(np.int32)


def _rolled(points: np.ndarray) -> list[np.ndarray]:
    """Hashes of each row's first 1, 2, ... code points."""
    out, h = [], np.zeros(len(points), np.uint64)
    for k in range(points.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + points[:, k] + np.uint64(1))
        out.append(h)
    return out


def feature_table(words: list[str]) -> np.ndarray:
    """Places of each word's features in the weight table; the last two are those as a neighbour.

    Features are the word, its prefixes, that it goes on after a prefix, and its
    suffixes, all in lower case.
    """
    low = [w.lower() for w in words]
    if not low:
        return np.zeros((0, WIDTH), np.int32)
    whole = mix(np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in low), np.uint64, len(low)))
    size = np.fromiter(map(len, low), np.int64, len(low))
    columns = [_places(whole, 1)]
    heads = _rolled(_code_points(low, PREFIXES[-1]))
    for k in PREFIXES:
        columns.append(np.where(size >= k, _places(heads[k - 1], 2), 0))
        columns.append(np.where(size > k, _places(heads[k - 1], 3), 0))
    tails = _rolled(_code_points([w[:-SUFFIXES[-1] - 1:-1] for w in low], SUFFIXES[-1]))
    columns += [np.where(size > k, _places(tails[k - 1], 4), 0) for k in SUFFIXES]
    return np.stack([*columns, _places(whole, 5), _places(whole, 6)], 1)


def number_tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Word numbers of all tokens in a row, tokens per text, and the words by number."""
    numbers: dict[str, int] = {}
    get, ids, sizes = numbers.setdefault, [], []
    for t in texts:
        found = TOKEN.findall(t)
        sizes.append(len(found))
        ids += [get(w, len(numbers)) for w in found]
    return np.array(ids, np.int64), np.array(sizes, np.int64), list(numbers)


@dataclass
class Layout:
    """Where the tokens of some texts lie: blocks of up to BLOCK tokens, longest first."""

    sizes: np.ndarray

    def __post_init__(self):
        n = self.sizes
        self.doc = np.repeat(np.arange(len(n)), n)
        self.first = np.cumsum(n) - n
        self.blocks = -(-n // BLOCK)
        doc = np.repeat(np.arange(len(n)), self.blocks)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(self.blocks) - self.blocks, self.blocks)
        start = self.first[doc] + nth * BLOCK
        size = np.minimum(BLOCK, n[doc] - nth * BLOCK)
        order = np.argsort(-size, kind="stable")
        self.start, self.size = start[order], size[order]
        self.place = np.empty(len(order), np.int64)  # of a text's k-th block among the sorted ones
        self.place[order] = np.arange(len(order))
        self.block_first = np.cumsum(self.blocks) - self.blocks
        self.active = np.searchsorted(-self.size, -np.arange(BLOCK), "left")  # blocks longer than t


def marginals(emission: np.ndarray, layout: Layout, trans: np.ndarray, start: np.ndarray,
              ) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each token is toxic, and expected counts of the four tag pairs."""
    if not len(emission):
        return np.zeros(0), np.zeros((2, 2))
    e = np.exp(np.clip(emission, -MOST, MOST))
    t = np.exp(trans)
    a, first, size, active = layout, layout.start, layout.size, layout.active
    m = len(first)
    # each block's product of (transition, emission) matrices; the first token's emission included
    # (a text's first token has the start weights for transitions, whatever comes in)
    head = np.zeros(m, bool)
    head[a.place[a.block_first[a.blocks > 0]]] = True
    s = np.exp(start)
    at_start = [[np.where(head, s[j], t[i, j]) for j in (0, 1)] for i in (0, 1)]
    p = np.zeros((2, 2, m))
    p[0, 0], p[1, 1] = 1, 1
    for k in range(BLOCK):
        n = active[k]
        if not n:
            break
        x = e[first[:n] + k]
        q = p[:, :, :n]
        u = t if k else at_start
        c0 = q[:, 0] * u[0][0] + q[:, 1] * u[1][0]
        c1 = (q[:, 0] * u[0][1] + q[:, 1] * u[1][1]) * x
        total = (c0 + c1).sum(0)
        p[:, 0, :n], p[:, 1, :n] = c0 / total, c1 / total
    # messages between blocks, along each text
    into = np.empty((2, m))
    back = np.ones((2, m))
    by_count = np.argsort(-a.blocks, kind="stable")
    counts = a.blocks[by_count]
    most = int(counts[0]) if len(counts) else 0
    state = np.full((2, len(counts)), 0.5)
    for k in range(most):
        n = int(np.searchsorted(-counts, -k, "left"))
        at = a.place[a.block_first[by_count[:n]] + k]
        state = state[:, :n]
        into[:, at] = state
        state = state[0] * p[0][:, at] + state[1] * p[1][:, at]
        state = state / state.sum(0)
    for k in range(most - 1, 0, -1):
        n = int(np.searchsorted(-counts, -k, "left"))
        at = a.place[a.block_first[by_count[:n]] + k]
        prev = a.place[a.block_first[by_count[:n]] + k - 1]
        b = back[:, at]
        new = p[:, 0][:, at] * b[0] + p[:, 1][:, at] * b[1]
        back[:, prev] = new / new.sum(0)
    # messages inside the blocks
    f = np.empty((2, len(e)))
    g = np.ones((2, len(e)))
    now = into.copy()
    for k in range(BLOCK):
        n = active[k]
        if not n:
            break
        at = first[:n] + k
        u = t if k else at_start
        c0 = now[0, :n] * u[0][0] + now[1, :n] * u[1][0]
        c1 = (now[0, :n] * u[0][1] + now[1, :n] * u[1][1]) * e[at]
        total = c0 + c1
        now[0, :n], now[1, :n] = c0 / total, c1 / total
        f[:, at] = now[:, :n]
    last = first + size - 1
    g[:, last] = back
    for k in range(BLOCK - 1, 0, -1):
        n = active[k]
        if not n:
            continue
        at = first[:n] + k
        x = g[1, at] * e[at]
        c0 = t[0, 0] * g[0, at] + t[0, 1] * x
        c1 = t[1, 0] * g[0, at] + t[1, 1] * x
        total = c0 + c1
        g[0, at - 1], g[1, at - 1] = c0 / total, c1 / total
    both = f * g
    toxic = both[1] / both.sum(0)
    # pairs of tokens that follow each other in one text
    left = np.flatnonzero(a.doc[1:] == a.doc[:-1]) if len(e) > 1 else np.zeros(0, int)
    right = left + 1
    pair = np.empty((2, 2, len(left)))
    for i in (0, 1):
        pair[i, 0] = f[i, left] * t[i, 0] * g[0, right]
        pair[i, 1] = f[i, left] * t[i, 1] * e[right] * g[1, right]
    pair /= np.maximum(pair.sum((0, 1)), 1e-300)
    return toxic, pair.sum(2)


@dataclass
class Field:
    """Weights of the features (0: none), of the transitions, and of the tag of a text's first token."""

    weights: np.ndarray
    trans: np.ndarray
    start: np.ndarray

    @staticmethod
    def fresh() -> Field:
        return Field(np.zeros(1 << TABLE_BITS), np.zeros((2, 2)), np.zeros(2))

    def of_words(self, table: np.ndarray) -> np.ndarray:
        """What each word adds to its own emission, to the next token's and to the previous one's."""
        w = self.weights
        return np.stack([w[table[:, :-2]].sum(1), w[table[:, -2]], w[table[:, -1]]], 1)

    def tag(self, ids: np.ndarray, parts: np.ndarray, layout: Layout) -> np.ndarray:
        return marginals(emissions(ids, parts, layout), layout, self.trans, self.start)[0]


def emissions(ids: np.ndarray, parts: np.ndarray, layout: Layout) -> np.ndarray:
    e = parts[ids, 0]
    same = layout.doc[1:] == layout.doc[:-1]
    e[1:] += parts[ids[:-1], 1] * same
    e[:-1] += parts[ids[1:], 2] * same
    return e


def gradient(field: Field, ids: np.ndarray, table: np.ndarray, layout: Layout, tags: np.ndarray,
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the log-likelihood of the tags, by weights, transitions and start."""
    p, pairs = marginals(emissions(ids, field.of_words(table), layout), layout, field.trans, field.start)
    d = tags - p
    same = layout.doc[1:] == layout.doc[:-1]
    n = len(table)
    own = np.bincount(ids, d, n)
    before = np.bincount(ids[:-1], d[1:] * same, n)
    after = np.bincount(ids[1:], d[:-1] * same, n)
    g = np.bincount(table[:, :-2].ravel(), np.repeat(own, table.shape[1] - 2), 1 << TABLE_BITS)
    g += np.bincount(table[:, -2], before, 1 << TABLE_BITS) + np.bincount(table[:, -1], after, 1 << TABLE_BITS)
    g[0] = 0.0
    y = tags.astype(int)
    seen = np.bincount((y[:-1] * 2 + y[1:])[same], minlength=4).reshape(2, 2)
    starts = layout.first[layout.sizes > 0]
    first = np.array([(1 - y[starts]).sum() - (1 - p[starts]).sum(), y[starts].sum() - p[starts].sum()])
    return g, seen - pairs, first


def fit(ids: np.ndarray, table: np.ndarray, layout: Layout, tags: np.ndarray, steps: int = 30,
        rate: float = 0.25, keep: float = 1e-3) -> Field:
    """Weights by Adam on the whole log-likelihood, less ``keep`` times half their squares."""
    field = Field.fresh()
    parts = [field.weights, field.trans, field.start]
    one, two = [np.zeros_like(x) for x in parts], [np.zeros_like(x) for x in parts]
    if not len(ids):
        return field
    for k in range(1, steps + 1):
        step = rate * (1 - 0.8 * k / steps)
        for x, g, m, v in zip(parts, gradient(field, ids, table, layout, tags), one, two):
            g = g - keep * x
            m += 0.1 * (g - m)
            v += 0.05 * (g * g - v)
            x += step * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.95 ** k)) + 1e-8)
    return field
