"""A gated recurrent language model with a class-factored softmax (numpy, inside tasks).

Tokens come as codes.  The unit is a minimal gated one: for code ``x``,
``h' = f(x) * h + (1 - f(x)) * z(x)`` with gate ``f = sigmoid(F[x])`` and
candidate ``z = tanh(Z[x])``; code 0 (end of text) has ``f = 0``, so every
text starts from the same state and texts can follow one another in one
stream.  As the gate reads the input only, all windows of a stream can be
run side by side, and the state carried from each into the next is put in
afterwards, exactly.

The next code's probability is that of its class (softmax over classes)
times that of the code within its class (softmax over the class's codes);
a class of one code needs no second factor.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WINDOW = 32


@dataclass(frozen=True)
class Shape:
    codes: int
    #: first code of each class, ascending; classes are ranges of codes
    starts: tuple[int, ...]
    hidden: int = 16

    @property
    def class_of(self) -> np.ndarray:
        return np.searchsorted(np.array(self.starts), np.arange(self.codes), "right") - 1

    def ranges(self) -> list[tuple[int, int]]:
        return list(zip(self.starts, [*self.starts[1:], self.codes]))


Params = dict[str, np.ndarray]


def initial(shape: Shape, counts: np.ndarray, seed: int = 0) -> Params:
    """Start from the code frequencies: the biases alone give the unigram model."""
    rng = np.random.default_rng(seed)
    share = (counts + 0.5) / (counts + 0.5).sum()
    cls = np.bincount(shape.class_of, share, len(shape.starts))
    small = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
    return {"F": small(shape.codes, shape.hidden) + np.float32(1.0), "Z": small(shape.codes, shape.hidden),
            "C": np.zeros((shape.hidden, len(shape.starts)), np.float32),
            "c": np.log(cls).astype(np.float32),
            "W": np.zeros((shape.codes, shape.hidden), np.float32),
            "w": np.log(share).astype(np.float32)}


def pack(p: Params) -> bytes:
    return np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float32).tobytes()


def unpack(raw: bytes, like: Params) -> Params:
    flat, out, at = np.frombuffer(raw, np.float32), {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


def _gates(p: Params, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gate = 1 / (1 + np.exp(-p["F"]))
    gate[0] = 0.0
    return gate[x], np.tanh(p["Z"])[x]


def _log_softmax(a: np.ndarray) -> np.ndarray:
    a -= a.max(1, keepdims=True)
    return a - np.log(np.exp(a).sum(1, keepdims=True))


def log_probabilities(p: Params, shape: Shape, h: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural log-probability of each code ``y`` after state ``h`` (one row each)."""
    cls = shape.class_of[y]
    out = np.empty(len(y))
    for lo in range(0, len(y), 65536):
        part = slice(lo, lo + 65536)
        logp = _log_softmax(h[part] @ p["C"] + p["c"])
        out[part] = logp[np.arange(len(logp)), cls[part]]
    order = np.argsort(cls, kind="stable")
    cuts = np.searchsorted(cls[order], np.arange(len(shape.starts) + 1))
    for k, (a, b) in enumerate(shape.ranges()):
        rows = order[cuts[k]:cuts[k + 1]]
        if b - a > 1 and len(rows):
            logw = _log_softmax(h[rows] @ p["W"][a:b].T + p["w"][a:b])
            out[rows] += logw[np.arange(len(rows)), y[rows] - a]
    return out


def states(p: Params, x: np.ndarray) -> np.ndarray:
    """The state after each code of a stream that starts with code 0."""
    n = -(-len(x) // WINDOW)
    padded = np.zeros(n * WINDOW, x.dtype)
    padded[:len(x)] = x
    f, z = _gates(p, padded)
    f, z = f.reshape(n, WINDOW, -1), z.reshape(n, WINDOW, -1)
    h, kept = (1 - f) * z, f.copy()
    for t in range(1, WINDOW):
        h[:, t] += f[:, t] * h[:, t - 1]
        kept[:, t] *= kept[:, t - 1]
    carry = np.zeros_like(h[:, 0])
    for k in range(1, n):
        carry[k] = h[k - 1, -1] + kept[k - 1, -1] * carry[k - 1]
    h += kept * carry[:, None]
    return h.reshape(n * WINDOW, -1)[:len(x)]


def score_stream(p: Params, shape: Shape, codes: np.ndarray) -> np.ndarray:
    """Log10 probability of each code of texts in a row, each ended by code 0."""
    x = np.concatenate([[0], codes[:-1]])
    return log_probabilities(p, shape, states(p, x), codes) / np.log(10)


class Trainer:
    """Adam over windows of several lanes; gradients stop at a window's start, states are carried on."""

    def __init__(self, p: Params, shape: Shape, rate: float):
        self.p, self.shape, self.rate, self.steps = p, shape, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def learn(self, codes: np.ndarray) -> None:
        """One pass over texts in a row, each ended by code 0."""
        x = np.concatenate([[0], codes[:-1]])
        lanes = int(np.clip(len(x) // (64 * WINDOW), 4, 512))
        length = max(-(-len(x) // lanes), 1)
        # the last lanes are filled up with codes that count for nothing
        live = np.arange(lanes * length) < len(x)
        x, y = (np.pad(a, (0, len(live) - len(a))) for a in (x, codes))
        x, y, live = (a.reshape(lanes, length) for a in (x, y, live))
        h = np.zeros((lanes, self.shape.hidden), np.float32)
        for lo in range(0, length, WINDOW):
            part = slice(lo, lo + WINDOW)
            h = self.window(x[:, part].T, y[:, part].T, h, live[:, part].T)

    def window(self, x: np.ndarray, y: np.ndarray, before: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Forward, backward and one update on the live codes (time, lane); the last states."""
        p, shape = self.p, self.shape
        steps, lanes = x.shape
        f, z = _gates(p, x)
        h = np.empty_like(f)
        last = before
        for t in range(steps):
            h[t] = last = f[t] * last + (1 - f[t]) * z[t]
        flat, target = h.reshape(steps * lanes, -1), y.reshape(-1)
        n, counted = len(target), live.reshape(-1)
        weight = 1 / max(int(counted.sum()), 1)
        cls = shape.class_of[target]
        g: Params = {"W": np.zeros_like(p["W"]), "w": np.zeros_like(p["w"])}
        d = np.exp(_log_softmax(flat @ p["C"] + p["c"]))
        d[np.arange(n), cls] -= 1
        d *= weight * counted[:, None].astype(d.dtype)
        g["C"], g["c"] = flat.T @ d, d.sum(0)
        dh = d @ p["C"].T
        order = np.argsort(cls, kind="stable")
        order = order[counted[order]]
        cuts = np.searchsorted(cls[order], np.arange(len(shape.starts) + 1))
        for k, (a, b) in enumerate(shape.ranges()):
            rows = order[cuts[k]:cuts[k + 1]]
            if b - a > 1 and len(rows):
                own = flat[rows]
                e = np.exp(_log_softmax(own @ p["W"][a:b].T + p["w"][a:b]))
                e[np.arange(len(rows)), target[rows] - a] -= 1
                e *= weight
                g["W"][a:b], g["w"][a:b] = e.T @ own, e.sum(0)
                dh[rows] += e @ p["W"][a:b]
        dh = dh.reshape(h.shape)
        for t in range(steps - 2, -1, -1):
            dh[t] += f[t + 1] * dh[t + 1]
        earlier = np.concatenate([before[None], h[:-1]])
        df = dh * (earlier - z) * f * (1 - f)
        dz = dh * (1 - f) * (1 - z * z)
        at = np.argsort(x.reshape(-1), kind="stable")
        seen, first = np.unique(x.reshape(-1)[at], return_index=True)
        for name, grad in (("F", df), ("Z", dz)):
            g[name] = np.zeros_like(p[name])
            g[name][seen] = np.add.reduceat(grad.reshape(n, -1)[at], first)
        self._update(g)
        return last

    def _update(self, g: Params) -> None:
        self.steps += 1
        scale = self.rate * np.sqrt(1 - 0.99 ** self.steps) / (1 - 0.9 ** self.steps)
        for k, v in g.items():
            m, s = self.m[k], self.v[k]
            m += 0.1 * (v - m)
            s += 0.01 * (v * v - s)
            self.p[k] -= (scale * m / (np.sqrt(s) + 1e-8)).astype(np.float32)
