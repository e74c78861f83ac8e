"""Character n-gram hashes of a list of words, as numpy arrays."""

from __future__ import annotations

import numpy as np

from ratecraft.llm.common import U64, mix64

LEFT, RIGHT = 2, 3          # code points that stand for a word's start and end
_P = U64(0x9E3779B97F4A7C15)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, each between LEFT and RIGHT, and the word starts (n + 1)."""
    text = "".join([f"\x02{w}\x03" for w in words])
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.cumsum([len(w) + 2 for w in words], dtype=np.int64)
    return cps, np.concatenate([np.zeros(1, np.int64), ends])


def slices(lengths: list[int], budget: int = 1_000_000):
    """Ranges [lo, hi) whose summed lengths (3 added for each) stay within ``budget``, one entry at least."""
    lo, used = 0, 0
    for i, n in enumerate(lengths):
        if i > lo and used + n + 3 > budget:
            yield lo, i
            lo, used = i, 0
        used += n + 3
    if lo < len(lengths):
        yield lo, len(lengths)


def rolling(cps: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, end positions) of all n-grams that lie inside one word.

    The hash of an n-gram holds its order, so orders can share one table.
    """
    size = len(cps) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    inside = word[:size] == word[n - 1:]
    with np.errstate(over="ignore"):
        h = np.zeros(size, np.uint64)
        for k in range(n):
            h = (h + cps[k:k + size] + U64(1)) * _P
            h ^= h >> U64(29)
        h = mix64(h + U64(n))
    return h[inside], np.flatnonzero(inside) + (n - 1)
