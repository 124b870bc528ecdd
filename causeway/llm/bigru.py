"""A bidirectional gated recurrent network with attention pooling, forward and backward, in numpy.

Inputs are word numbers. A word's vector is a learned word vector (words of the
training sample that are frequent enough) beside the mean of learned vectors of
its hashed character n-grams, so a word never seen still says something.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

WORD_DIM, CHAR_DIM, HIDDEN, ATTEND = 16, 16, 12, 12
CHAR_BUCKETS = 1 << 14
NGRAMS = (3, 5)
PAD = -1


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def word_ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, starts): the character n-gram buckets of all words in a row, and where each word's begin.

    A word counts with a mark on either side, so it has a three-gram at least.
    """
    joined = "".join(f"\x02{w}\x03" for w in words)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    owner_end = np.repeat(ends, sizes)
    place = np.arange(len(points))
    buckets = np.full((len(points), len(NGRAMS)), -1, np.int64)
    run = np.zeros(len(points), np.uint32)
    for n in range(1, min(NGRAMS[-1], len(points)) + 1):
        shifted = np.zeros(len(points), np.uint32)
        shifted[:len(points) - n + 1] = points[n - 1:]
        run = (run ^ (shifted + np.uint32(n * 0x9E37))) * np.uint32(0x85EBCA6B)
        run ^= run >> np.uint32(13)
        if n in NGRAMS:
            ok = place + n <= owner_end
            buckets[ok, NGRAMS.index(n)] = (run[ok] & np.uint32(CHAR_BUCKETS - 1)).astype(np.int64)
    flat = buckets.ravel()
    used = flat >= 0
    per_point = used.reshape(-1, len(NGRAMS)).sum(axis=1)
    starts = np.concatenate([[0], np.cumsum(per_point)])[np.concatenate([[0], ends[:-1]])]
    return flat[used], starts


@dataclass
class BiGru:
    vocabulary: dict[str, int]
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, vocabulary: dict[str, int], seed: int = 7) -> BiGru:
        r = np.random.default_rng(seed)
        n = lambda *s: r.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        return cls(vocabulary, {
            "word": r.normal(0, 0.1, (len(vocabulary) + 1, WORD_DIM)).astype(np.float32),
            "char": r.normal(0, 0.3, (CHAR_BUCKETS, CHAR_DIM)).astype(np.float32),
            "wx": n(d, 6 * h), "bx": np.zeros(6 * h, np.float32), "wf": n(h, 3 * h), "wb": n(h, 3 * h),
            "a": n(2 * h, ATTEND), "ab": np.zeros(ATTEND, np.float32), "v": n(ATTEND), "o": n(2 * h),
            "ob": np.zeros(1, np.float32)})

    def table(self, words: list[str], drop: np.ndarray | None = None) -> dict:
        """Input projections of distinct words, and what the backward pass needs of them.

        ``drop`` marks words whose word vector is left out, for training.
        """
        rows = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        if drop is not None:
            rows = np.where(drop, 0, rows)
        buckets, starts = word_ngrams(words)
        sizes = np.diff(np.append(starts, len(buckets)))
        char = np.add.reduceat(self.p["char"][buckets], starts, axis=0) / sizes[:, None]
        word = self.p["word"][rows] * (rows > 0)[:, None]
        x = np.concatenate([word, char.astype(np.float32)], axis=1)
        return {"x": x, "gx": x @ self.p["wx"] + self.p["bx"], "rows": rows, "buckets": buckets, "sizes": sizes}

    def _direction(self, gx: np.ndarray, ids: np.ndarray, w: np.ndarray, order, keep: list | None) -> np.ndarray:
        n, h = len(ids), HIDDEN
        state = np.zeros((n, h), np.float32)
        out = np.zeros((ids.shape[1], n, h), np.float32)
        for t in order:
            g, m = gx[ids[:, t]], (ids[:, t] != PAD)[:, None]
            r = state @ w
            zr = sigmoid(g[:, :2 * h] + r[:, :2 * h])
            z, reset = zr[:, :h], zr[:, h:]
            c = np.tanh(g[:, 2 * h:] + reset * r[:, 2 * h:])
            new = np.where(m, c + z * (state - c), state)
            if keep is not None:
                keep.append((t, state, z, reset, c, r[:, 2 * h:], m))
            out[t] = state = new
        return out

    def forward(self, table: dict, ids: np.ndarray, keep: bool = False):
        """Probabilities of windows ``ids`` (windows, length), words numbered as in ``table``, padded at the end."""
        h = HIDDEN
        # Padding looks up the last row; the mask keeps it out.
        steps = range(ids.shape[1])
        kf, kb = ([], []) if keep else (None, None)
        fw = self._direction(table["gx"][:, :3 * h], ids, self.p["wf"], steps, kf)
        bw = self._direction(table["gx"][:, 3 * h:], ids, self.p["wb"], reversed(steps), kb)
        hidden = np.concatenate([fw, bw], axis=2)  # (length, windows, 2h)
        u = np.tanh(hidden @ self.p["a"] + self.p["ab"])
        s = np.where(ids.T != PAD, u @ self.p["v"], -1e9)
        e = np.exp(s - s.max(axis=0))
        share = e / e.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", share, hidden)
        y = sigmoid(pooled @ self.p["o"] + self.p["ob"])
        return (y, (kf, kb, hidden, u, share, pooled)) if keep else y

    def gradients(self, table: dict, ids: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        y, (kf, kb, hidden, u, share, pooled) = self.forward(table, ids, keep=True)
        p, h, g = self.p, HIDDEN, {}
        d = ((y - target) * weight / weight.sum()).astype(np.float32)
        g["o"], g["ob"] = pooled.T @ d, np.array([d.sum()], np.float32)
        dpool = d[:, None] * p["o"]
        dshare = np.einsum("tnh,nh->tn", hidden, dpool)
        ds = share * (dshare - (share * dshare).sum(axis=0))
        du = ds[:, :, None] * p["v"] * (1 - u * u)
        g["v"] = np.einsum("tn,tnk->k", ds, u)
        flat = hidden.reshape(-1, 2 * h)
        g["a"], g["ab"] = flat.T @ du.reshape(-1, ATTEND), du.sum(axis=(0, 1))
        dh = share[:, :, None] * dpool + du @ p["a"].T
        dgx = np.zeros((*ids.shape, 6 * h), np.float32)
        for name, kept, at in (("wf", kf, 0), ("wb", kb, 1)):
            w, dw, back = p[name], np.zeros_like(p[name]), np.zeros((len(ids), h), np.float32)
            for t, before, z, reset, c, rc, m in reversed(kept):
                up = dh[t, :, at * h:(at + 1) * h] + back
                on = up * m
                dc = on * (1 - z) * (1 - c * c)
                dz = on * (before - c) * z * (1 - z)
                dr = dc * rc * reset * (1 - reset)
                dgx[:, t, 3 * h * at:3 * h * (at + 1)] = np.concatenate([dz, dr, dc], axis=1)
                dg = np.concatenate([dz, dr, dc * reset], axis=1)
                dw += before.T @ dg
                back = np.where(m, on * z, up) + dg @ w.T
            g[name] = dw
        used = ids.ravel() != PAD
        per_word = np.zeros_like(table["gx"])
        np.add.at(per_word, ids.ravel()[used], dgx.reshape(-1, 6 * h)[used])
        g["wx"], g["bx"] = table["x"].T @ per_word, per_word.sum(axis=0)
        dx = per_word @ p["wx"].T
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], table["rows"], dx[:, :WORD_DIM] * (table["rows"] > 0)[:, None])
        g["char"] = np.zeros_like(p["char"])
        np.add.at(g["char"], table["buckets"], np.repeat(dx[:, WORD_DIM:] / table["sizes"][:, None], table["sizes"], axis=0))
        return g


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.rate, self.step = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.s = {k: np.zeros_like(v) for k, v in p.items()}

    def update(self, p: dict[str, np.ndarray], g: dict[str, np.ndarray]) -> None:
        self.step += 1
        for k in p:
            self.m[k] += 0.1 * (g[k] - self.m[k])
            self.s[k] += 0.01 * (g[k] * g[k] - self.s[k])
            fixed = self.m[k] / (1 - 0.9 ** self.step)
            p[k] -= (self.rate * fixed / (np.sqrt(self.s[k] / (1 - 0.99 ** self.step)) + 1e-8)).astype(np.float32)
