"""Signature trees over documents of a group (numpy, inside tasks).

A document's signature is a bitmap of its shingles' hashes, some bits per
shingle, of a power-of-two length; halving the length is an OR of the two
halves, so documents of different sizes compare at the shorter length.
The documents of a group, in order of size, lie in the leaves of a tree whose
nodes hold the OR of the bitmaps below and the range of sizes.  A dual
traversal starts with the root against itself and splits node pairs; a pair
is dropped as soon as no document of one node can overlap enough with one
of the other: sizes too far apart, or too few common bits even if every
shingle on a common bit were shared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

#: Bitmaps travel once for each block pair of a document; at one to two bits a shingle, sets that
#: share three quarters or less are told apart, and the exact check does the rest.
BITS_PER_SHINGLE = 1
LEAST_BITS = 64
FAN_OUT = 4
LEAF = 32


def signature(hashes: np.ndarray) -> bytes:
    bits = LEAST_BITS
    while bits < BITS_PER_SHINGLE * len(hashes):
        bits *= 2
    marks = np.zeros(bits, np.uint8)
    marks[(hashes & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(marks, bitorder="little").tobytes()


def fold(bitmap: np.ndarray, length: int) -> np.ndarray:
    while len(bitmap) > length:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] | bitmap[half:]
    return bitmap


def ones(bitmaps: np.ndarray) -> np.ndarray:
    """Bits set in each row."""
    return np.bitwise_count(np.ascontiguousarray(bitmaps).view(np.uint64)).sum(1, dtype=np.int64)


def least_overlap(n: int, m: int, percent: int) -> int:
    """Smallest intersection of sets of n and m elements with Jaccard >= percent / 100."""
    return -(-percent * (n + m) // (100 + percent))


@dataclass
class Node:
    lo: int
    hi: int
    bitmap: np.ndarray
    least: int
    most: int
    hidden: int  # most shingles of one document that its own bits do not tell apart
    first: bool  # may hold the smaller document of a pair
    labels: tuple[int, int]
    children: list[Node]
    joined: bool = False


class SignatureTree:
    """Documents sorted by size: ``sizes``, ``bitmaps``, ``firsts``, ``labels`` by position.

    A leaf holds up to ``LEAF`` documents; each document of a leaf is compared
    with those of another by one array operation.
    """

    def __init__(self, sizes: np.ndarray, bitmaps: list[bytes], firsts: np.ndarray,
                 labels: np.ndarray, percent: int):
        self.percent, self.sizes, self.firsts, self.labels = percent, sizes, firsts, labels
        self.rows = [np.frombuffer(raw, np.uint8) for raw in bitmaps]
        level = [self._leaf(lo, min(lo + LEAF, len(sizes))) for lo in range(0, len(sizes), LEAF)]
        while len(level) > 1:
            level = [self._above(level[i:i + FAN_OUT]) for i in range(0, len(level), FAN_OUT)]
        self.root = level[0]

    def _leaf(self, lo: int, hi: int) -> Node:
        rows = self._matrix(lo, hi, min(len(r) for r in self.rows[lo:hi]))
        own = slice(lo, hi)
        return Node(lo, hi, np.bitwise_or.reduce(rows), int(self.sizes[lo]), int(self.sizes[hi - 1]),
                    int((self.sizes[own] - ones(rows)).max()), bool(self.firsts[own].any()),
                    (int(self.labels[own].min()), int(self.labels[own].max())), [])

    def _above(self, nodes: list[Node]) -> Node:
        if len(nodes) == 1:
            return nodes[0]
        length = min(len(n.bitmap) for n in nodes)
        hidden = max(n.hidden if len(n.bitmap) == length else n.most for n in nodes)
        return Node(nodes[0].lo, nodes[-1].hi, np.bitwise_or.reduce([fold(n.bitmap, length) for n in nodes]),
                    min(n.least for n in nodes), max(n.most for n in nodes), hidden,
                    any(n.first for n in nodes), (min(n.labels[0] for n in nodes),
                                                  max(n.labels[1] for n in nodes)), nodes)

    def _matrix(self, lo: int, hi: int, length: int) -> np.ndarray:
        return np.stack([fold(r, length) for r in self.rows[lo:hi]])

    def may_link(self, a: Node, b: Node) -> bool:
        """Whether a document of ``a`` may link with a larger (or later) one of ``b``."""
        if not a.first or 100 * a.most < self.percent * b.least:
            return False
        if a.labels[0] == a.labels[1] == b.labels[0] == b.labels[1]:
            return False
        if a is b:
            return True
        length = min(len(a.bitmap), len(b.bitmap))
        # a document shares at most the common bits and what its own bits hide
        slack = min(n.hidden if len(n.bitmap) == length else n.most for n in (a, b))
        common = ones((fold(a.bitmap, length) & fold(b.bitmap, length))[None])[0]
        return common + slack >= least_overlap(a.least, b.least, self.percent)

    def leaf_pairs(self, a: Node, b: Node) -> np.ndarray:
        """Positions (smaller, larger) of the documents of two leaves that may link."""
        n, m = self.sizes[a.lo:a.hi, None], self.sizes[None, b.lo:b.hi]
        fits = self.firsts[a.lo:a.hi, None] & (100 * n >= self.percent * m) & (
            self.labels[a.lo:a.hi, None] != self.labels[None, b.lo:b.hi])
        if a is b:
            fits &= np.arange(a.lo, a.hi)[:, None] < np.arange(a.lo, a.hi)[None]
        for i in np.flatnonzero(fits.any(1)):
            x, size = self.rows[a.lo + i], int(n[i, 0])
            js = np.flatnonzero(fits[i])
            # a larger document's bitmap is as long or longer: at this length both tell most
            y = np.stack([r if len(r) == len(x) else fold(r, len(x)) for r in (self.rows[b.lo + j] for j in js)])
            slack = np.minimum(size - ones(x[None]), m[0, js] - ones(y))
            need = -(-self.percent * (size + m[0, js]) // (100 + self.percent))
            fits[i, js] = ones(x & y) + slack >= need
        return np.argwhere(fits) + (a.lo, b.lo)

    def pairs(self, root: Callable[[int], int] | None = None) -> Iterator[tuple[int, int]]:
        """Positions (smaller, larger) of the documents that may link, smaller positions first.

        ``root`` tells which documents the caller has joined so far: node pairs
        that are one group by then are passed over.
        """
        stack = [(self.root, self.root)]
        while stack:
            a, b = stack.pop()
            if root is not None and (one := self._group(a, root)) is not None and one == self._group(b, root):
                continue
            if not self.may_link(a, b):
                continue
            if not a.children and not b.children:
                yield from map(tuple, self.leaf_pairs(a, b).tolist())
            elif a is b:
                below = [(x, y) for i, x in enumerate(a.children) for y in a.children[i:]]
                stack.extend(reversed(below))
            elif a.children and (not b.children or a.hi - a.lo >= b.hi - b.lo):
                stack.extend((x, b) for x in reversed(a.children))
            else:
                stack.extend((a, y) for y in reversed(b.children))

    def _group(self, node: Node, root: Callable[[int], int]) -> int | None:
        """The group that all documents of a node are in, or None; groups only ever grow."""
        if node.joined:
            return root(node.lo)
        if node.children:
            first = self._group(node.children[0], root)
            if first is None or any(self._group(c, root) != first for c in node.children[1:]):
                return None
        else:
            first = root(node.lo)
            if any(root(i) != first for i in range(node.lo + 1, node.hi)):
                return None
        node.joined = True
        return first
