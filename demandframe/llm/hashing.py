"""Hashed word and character n-grams of many texts at once, over their bytes as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BITS = 20
#: Bytes of texts that are hashed together (a longer text is hashed alone).
GROUP = 1 << 18
_RNG = np.random.default_rng(7)
_BYTE = _RNG.integers(0, 1 << 64, (16, 256), dtype=np.uint64)  # [place in the n-gram, byte]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def bucket(h: np.ndarray, kind: int) -> np.ndarray:
    """Feature numbers of 64-bit hashes; the same hash of another kind is another feature."""
    h = (h ^ np.uint64(kind * 0x632BE59BD9B4E019 % (1 << 64))) * _MIX
    return ((h ^ (h >> np.uint64(32))) * _MIX >> np.uint64(64 - BITS)).astype(np.int64)


class Bytes:
    """Texts as one run of bytes: each between line breaks, so that n-grams never reach into the next text.

    ``blank`` says for each of the 256 byte values whether it ends a word.
    """

    def __init__(self, texts: Sequence[bytes], blank: np.ndarray):
        raw = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
        self.raw, self.is_blank = raw, blank[raw]
        self.data = np.where(self.is_blank, np.uint8(32), raw)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[1], 1 + np.cumsum(sizes + 1)])[:-1]
        self.ends = self.starts + sizes
        edge = np.diff(self.is_blank.astype(np.int8))
        self.word_at, self.word_end = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, features) of n-grams whose inner bytes lie in one word; a blank may stand at either end."""
        m = len(self.data) - n + 1
        if m < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        inside = np.concatenate([[0], np.cumsum(self.is_blank)])
        at = np.flatnonzero(inside[n - 1 : n - 1 + m] == inside[1 : 1 + m])
        at = at[~(self.is_blank[at] & self.is_blank[at + n - 1])]
        h = np.zeros(len(at), np.uint64)
        for k in range(n):
            h += _BYTE[k][self.data[at + k]]
        return at, bucket(h, n)

    def word_hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, from one running sum."""
        power = np.cumprod(np.full(len(self.data), _BASE))
        run = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[0][self.data] * power)])
        down = np.cumprod(np.full(len(self.data), _INVERSE))
        return (run[self.word_end] - run[self.word_at]) * down[self.word_at]


def groups(texts: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    """Runs a:b of texts of some GROUP bytes together."""
    a = size = 0
    for b, t in enumerate(texts):
        if b > a and size + len(t) > GROUP:
            yield a, b
            a, size = b, 0
        size += len(t)
    if texts:
        yield a, len(texts)


def gradient_steps(loss, w: np.ndarray, steps: int, rate: float, floor: np.ndarray | float = -np.inf) -> np.ndarray:
    """Adam with a rate that falls to a tenth; ``loss(w)`` returns the gradient, no weight goes below ``floor``."""
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = loss(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = np.maximum(w - rate * (1 - 0.9 * t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8), floor)
    return w
