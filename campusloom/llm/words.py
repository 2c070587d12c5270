"""Words of many texts at once, as numpy arrays: spans, 64-bit hashes, shingles. Runs inside tasks.

A word is a longest run of characters other than space and \\x09-\\x0D. The hash of a word is
a polynomial over random byte values modulo 2**64, taken from prefix sums and then mixed, so
that no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np

_ODD = 0x9E3779B97F4A7C15
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)
_rng = np.random.default_rng(20240229)
_BYTES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BY_PLACE = _rng.integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of a list of texts: spans in `buffer`, `bounds[k]:bounds[k + 1]` the words of text k, `hashes`."""

    def __init__(self, texts: list[bytes], white: np.ndarray = _WHITE, gap: bytes = b" "):
        joined = gap + gap.join(texts) + gap
        self.buffer = np.frombuffer(joined, np.uint8)
        self.starts_of_texts = np.cumsum([1] + [len(t) + 1 for t in texts])
        gap = white[self.buffer]
        edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        self.starts, self.ends = edges[::2], edges[1::2]
        self.bounds = np.searchsorted(self.starts, self.starts_of_texts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @cached_property
    def _sums(self) -> np.ndarray:
        return np.cumsum(_BYTES[self.buffer] * powers(_ODD, len(self.buffer)), dtype=np.uint64)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the bytes of [start, end)."""
        own = (self._sums[ends - 1] - self._sums[starts - 1]) * powers(_ODD_INVERSE, len(self.buffer))[starts]
        return mix(own)

    @cached_property
    def hashes(self) -> np.ndarray:
        return self.spans(self.starts, self.ends)


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows and the bounds by text. Fewer than k words form one window; none form none."""
    counts = np.diff(bounds)
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out = np.concatenate([[0], np.cumsum(n)])
    text = np.repeat(np.arange(len(counts)), n)
    first = bounds[:-1][text] + np.arange(out[-1]) - out[:-1][text]
    last = bounds[1:][text]
    total = np.zeros(len(first), np.uint64)
    for j in range(k):
        at = first + j
        inside = at < last
        total += np.where(inside, hashes[np.minimum(at, len(hashes) - 1)] * _BY_PLACE[j % 8], np.uint64(0)) if len(hashes) else 0
    return mix(total), out


def chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Slices of consecutive texts of about `most` bytes each; a longer text is a slice of its own."""
    start = total = 0
    for k, size in enumerate(sizes):
        if k > start and total + size > most:
            yield start, k
            start, total = k, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
