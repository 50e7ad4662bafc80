"""A bidirectional gated recurrent network with attention pooling, in numpy.

Inputs of a step are a word's own vector (hashed bucket) beside the mean vector
of its character n-grams (hashed buckets), so an unseen form of a known stem
still says something. Two gated recurrent layers read the window in either
direction, attention weights pool their states, and a logistic unit gives the
window's probability. Training is by Adam on the exact gradients.
"""

from __future__ import annotations

import numpy as np

from storeloom.llm.common import joined, mix

WORD_BUCKETS, GRAM_BUCKETS = 1 << 14, 1 << 15
GRAMS = (3, 4, 5, 6)  # bytes, with a mark at either end of the word


def bucket_words(words: list[bytes]) -> np.ndarray:
    """A bucket for each word."""
    buffer, starts = joined(words, bytes(8))
    flat = np.ndarray(len(buffer) - 7, "<u8", buffer, strides=(1,))
    size = np.diff(starts) - 8
    key = mix(size.astype(np.uint64))
    for at in range(0, int(size.max(initial=0)), 8):
        more = np.flatnonzero(size > at)
        left = np.minimum(size[more] - at, 8).astype(np.uint64) * np.uint64(8)
        mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - left)
        key[more] = mix(key[more] ^ (flat[starts[:-1][more] + at] & mask))
    return (key >> np.uint64(40)).astype(np.int64) % WORD_BUCKETS


def bucket_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character n-grams, and where each word's begin (every word has some)."""
    buffer, starts = joined([b"<" + w + b">" for w in words])
    flat = np.ndarray(len(buffer), "<u8", buffer + bytes(8), strides=(1,))[:]
    row = np.repeat(np.arange(len(words)), np.diff(starts))
    left = starts[1:][row] - np.arange(row.size)
    buckets, rows = [], []
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        key = mix((flat[at] & np.uint64((1 << 8 * n) - 1)) + np.uint64(n << 56))
        buckets.append((key >> np.uint64(40)).astype(np.int64) % GRAM_BUCKETS)
        rows.append(row[at])
    whole = np.concatenate(rows)
    order = np.argsort(whole, kind="stable")
    return np.concatenate(buckets)[order], np.searchsorted(whole[order], np.arange(len(words) + 1))


def _sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows and the sum of the values of each."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    return rows[first], np.add.reduceat(values[order], first, axis=0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class BiGRU:
    """Parameters by name; the first axis of the recurrent ones is the direction."""

    def __init__(self, hidden: int = 8, word_dim: int = 8, gram_dim: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        d, h = word_dim + gram_dim, hidden
        self.h = h
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        self.p = {"word": draw(0.02, WORD_BUCKETS, word_dim), "gram": draw(0.1, GRAM_BUCKETS, gram_dim), "W": draw(d ** -0.5, 2, d, 3 * h), "U": draw(h ** -0.5, 2, h, 3 * h),
                  "b": np.zeros((2, 1, 3 * h), np.float32), "v": draw(0.3, 2, h), "w": draw(0.3, 2, h), "c": np.zeros(1, np.float32)}

    def inputs(self, words: list[bytes], chunk: int = 20_000) -> tuple[np.ndarray, tuple]:
        """A vector for each word (row 0 is the padding), and what the gradient needs."""
        out = np.zeros((len(words) + 1, self.p["W"].shape[1]), np.float32)
        k = self.p["word"].shape[1]
        kept = []
        for at in range(0, len(words), chunk):
            part = words[at:at + chunk]
            bucket, (grams, starts) = bucket_words(part), bucket_grams(part)
            out[at + 1:at + 1 + len(part), :k] = self.p["word"][bucket]
            sums = np.add.reduceat(self.p["gram"][grams], starts[:-1], axis=0)
            out[at + 1:at + 1 + len(part), k:] = sums / np.diff(starts)[:, None]
            kept.append((bucket, grams, starts))
        return out, tuple(kept)

    def projected(self, x: np.ndarray) -> np.ndarray:
        """Input parts of the gates: (direction, word, 3h)."""
        return x[None] @ self.p["W"] + self.p["b"]

    def forward(self, ids: np.ndarray, table: np.ndarray, keep: bool = False):
        """Probabilities of the windows ``ids`` (window, step; 0 is padding)."""
        n, steps = ids.shape
        h, U = self.h, self.p["U"]
        H = np.empty((steps, 2, n, h), np.float32)  # by place in the window
        state = np.zeros((2, n, h), np.float32)
        trace = []
        mask = (ids > 0).astype(np.float32).T[:, :, None]
        for t in range(steps):
            f, b = t, steps - 1 - t
            x = np.stack([table[0][ids[:, f]], table[1][ids[:, b]]])
            y = state @ U
            gates = _sigmoid(x[..., :2 * h] + y[..., :2 * h])
            r, z = gates[..., :h], gates[..., h:]
            new = np.tanh(x[..., 2 * h:] + r * y[..., 2 * h:])
            m = np.stack([mask[f], mask[b]])
            after = (new + z * (state - new)) * m
            if keep:
                trace.append((state, r, z, new, y[..., 2 * h:], m))
            state = after
            H[f, 0], H[b, 1] = after[0], after[1]
        score = np.einsum("tdnh,dh->tn", H, self.p["v"]) + np.where(mask[..., 0] > 0, 0, -1e9).astype(np.float32)
        e = np.exp(score - score.max(axis=0))
        a = e / e.sum(axis=0)
        pooled = np.einsum("tdnh,tn->dnh", H, a)
        prob = _sigmoid(np.einsum("dnh,dh->n", pooled, self.p["w"]) + self.p["c"])
        return (prob, (H, trace, a, pooled)) if keep else prob

    def gradients(self, ids: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the mean weighted log loss, and that with respect to the word vectors ``x``."""
        table = self.projected(x)
        prob, (H, trace, a, pooled) = self.forward(ids, table, keep=True)
        n, steps = ids.shape
        h, U, p = self.h, self.p["U"], self.p
        d = ((prob - y) * weight / n).astype(np.float32)
        g = {"w": np.einsum("n,dnh->dh", d, pooled), "c": d.sum(keepdims=True)}
        dpool = d[None, :, None] * p["w"][:, None, :]
        da = np.einsum("tdnh,dnh->tn", H, dpool)
        ds = a * (da - (a * da).sum(axis=0))
        g["v"] = np.einsum("tdnh,tn->dh", H, ds)
        dH = a[:, None, :, None] * dpool[None] + ds[:, None, :, None] * p["v"][None, :, None, :]
        g["U"] = np.zeros_like(U)
        dtable = np.zeros_like(table)
        moved = np.empty((steps, 2, n, 3 * h), np.float32)
        back = np.zeros((2, n, h), np.float32)
        for t in reversed(range(steps)):
            f, b = t, steps - 1 - t
            state, r, z, new, yn, m = trace[t]
            dh = (np.stack([dH[f, 0], dH[b, 1]]) + back) * m
            dnew = dh * (1 - z) * (1 - new * new)
            dz = dh * (state - new) * z * (1 - z)
            dr = dnew * yn * r * (1 - r)
            dx = np.concatenate([dr, dz, dnew], axis=-1)
            dy = np.concatenate([dr, dz, dnew * r], axis=-1)
            g["U"] += np.swapaxes(state, 1, 2) @ dy
            back = dh * z + dy @ np.swapaxes(U, 1, 2)
            moved[f, 0], moved[b, 1] = dx[0], dx[1]
        for way in (0, 1):
            at, total = _sums(ids.T.ravel(), moved[:, way].reshape(-1, 3 * h))
            dtable[way, at] = total
        dtable[:, 0] = 0
        g["W"] = x.T[None] @ dtable
        g["b"] = dtable.sum(axis=1, keepdims=True)
        return g, np.einsum("dwk,dik->wi", dtable, p["W"])

    def step(self, ids: np.ndarray, words: list[bytes], y: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One Adam step on some windows; only the vectors of their words move."""
        used, local = np.unique(ids, return_inverse=True)
        local = local.reshape(ids.shape)
        own = [words[i - 1] for i in used.tolist() if i]
        if used.size and used[0] != 0:
            local = local + 1
        x, kept = self.inputs(own, chunk=max(1, len(own)))
        g, dx = self.gradients(local, x, y, weight)
        if not hasattr(self, "moments"):
            self.moments, self.ticks = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}, 0
        self.ticks += 1
        k = self.p["word"].shape[1]
        for bucket, grams, starts in kept:
            share = dx[1:, k:] / np.diff(starts)[:, None]
            for name, rows, values in (("word", bucket, dx[1:, :k]), ("gram", grams, np.repeat(share, np.diff(starts), axis=0))):
                at, total = _sums(rows, values)
                self._adam(name, total, rate, at)
        for name, value in g.items():
            self._adam(name, value.astype(np.float32), rate)

    def _adam(self, name: str, g: np.ndarray, rate: float, rows: np.ndarray | slice = slice(None)) -> None:
        m, v = self.moments[name]
        m[rows] += 0.1 * (g - m[rows])
        v[rows] += 0.01 * (g * g - v[rows])
        fix = rate * np.sqrt(1 - 0.99 ** self.ticks) / (1 - 0.9 ** self.ticks)
        self.p[name][rows] -= (fix * m[rows] / (np.sqrt(v[rows]) + 1e-7)).astype(np.float32)
