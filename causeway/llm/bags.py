"""Words and shingle bags of texts inside a task."""

from __future__ import annotations

import re

import numpy as np

_UPPER = {c: c + 32 for c in range(65, 91)}
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_MASK = (1 << 64) - 1
_MULTIPLIERS = [pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(64)]


def word_lists(texts: list[str | None]) -> list[list[str]]:
    """The lower-cased (A-Z) words of each text; a null text has none."""
    return [[] if not t else _WORD.findall(t.lower() if t.isascii() else t.translate(_UPPER)) for t in texts]


class _Numbers(dict):
    """Stable 64-bit numbers of words: hashed once, kept while there is room."""

    LIMIT = 400_000

    def __missing__(self, word: str) -> int:
        import xxhash
        value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < self.LIMIT:
            self[word] = value
        return value


_numbers = _Numbers()


def shingle_bags(words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct 64-bit shingles, counts) of the runs of ``n`` words; fewer words are one shingle."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    numbers = np.fromiter(map(_numbers.__getitem__, words), np.uint64, len(words))
    n = min(n, len(words))
    size = len(words) - n + 1
    out = np.full(size, n, np.uint64)
    for k in range(n):
        out ^= numbers[k:k + size] * np.uint64(_MULTIPLIERS[k])
        out ^= out >> np.uint64(29)
        out *= np.uint64(_MULTIPLIERS[k + 8])
    return np.unique(out, return_counts=True)
