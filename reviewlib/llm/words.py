"""Words and word shingles of UTF-8 texts as 64-bit codes, many texts at a time.

A word is a run without blank, tab or line end, ``[^\\x20\\x09-\\x0D]+``. Its code depends on its
bytes alone, so codes agree between tasks; different words share a code with a chance of
about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_CHUNK = 1 << 18  # bytes coded at a time
_SEED = 7919


class Group(NamedTuple):
    """Words of rows ``lo`` to ``hi`` (exclusive): row ``lo + i`` has ``codes[bounds[i]:bounds[i+1]]``.
    ``starts`` and ``ends`` are byte places in ``data``."""

    lo: int
    hi: int
    codes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array, null as empty."""
    if pa.types.is_binary(texts.type):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
    else:
        texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    return offsets, np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)


class Coder:
    """Codes words; make one per task. ``lower`` folds A-Z. With ``split`` a word also ends where
    letters (and all bytes of other characters), digits and punctuation meet."""

    def __init__(self, lower: bool = True, split: bool = False):
        values = np.random.default_rng(_SEED).integers(1, 2**63, 256, dtype=np.uint64) * 2 + 1
        table = np.arange(256)
        if lower:
            table[65:91] += 32
        self._byte = values[table]
        self.space = np.zeros(256, bool)
        self.space[[32, *range(9, 14)]] = True
        self._kind = np.where(self.space, 0, 1)
        if split:
            self._kind[33:128] = 3
            self._kind[48:58] = 2
            self._kind[[*range(65, 91), *range(97, 123)]] = 1
        self._kind = self._kind.astype(np.uint8)
        self._base = np.uint64(0x9E3779B97F4A7C15)
        self._inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
        self._powers(_CHUNK + 4096)

    def _powers(self, n: int) -> None:
        for name, base in (("_up", self._base), ("_down", self._inverse)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            setattr(self, name, np.multiply.accumulate(x))

    def _code(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and codes of the words of a stretch; a word also ends where ``first`` says
        that a text begins."""
        kind = self._kind[data]
        edge = np.ones(len(data) + 1, bool)
        np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
        edge[first] = True
        word = kind > 0
        starts = np.flatnonzero(word & edge[:-1])
        ends = np.flatnonzero(word & edge[1:]) + 1
        return starts, ends, self.codes(data, starts, ends)

    def codes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The code of each stretch of bytes: of equal bytes the same wherever they are."""
        if len(data) > len(self._up):
            self._powers(2 * len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._byte[data] * self._up[: len(data)], out=sums[1:])
        codes = (sums[ends] - sums[starts]) * self._down[starts]
        return mix(codes + (ends - starts).astype(np.uint64) * self._base)

    def _pieces(self, data: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int]]:
        """Stretches of a long text that end at white space."""
        while hi - lo > _CHUNK:
            cut = lo + _CHUNK
            while cut < hi and not self.space[data[cut]]:
                near = np.flatnonzero(self.space[data[cut : min(hi, cut + 4096)]])
                cut = cut + int(near[0]) if len(near) else min(hi, cut + 4096)
            yield lo, cut
            lo = cut
        yield lo, hi

    def groups(self, texts: pa.Array) -> Iterator[Group]:
        """The words of all texts, some hundred kilobytes at a time; a longer text is a group
        of its own."""
        offsets, data = buffers(texts)
        lo, n = 0, len(texts)
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + _CHUNK, "right")) - 1)
            begin, end = int(offsets[lo]), int(offsets[hi])
            parts = []
            for a, b in self._pieces(data, begin, end):
                inner = offsets[lo:hi]
                inner = inner[(inner >= a) & (inner <= b)] - a
                s, e, c = self._code(data[a:b], inner)
                parts.append((s + a, e + a, c))
            starts, ends, codes = (np.concatenate(x) for x in zip(*parts))
            bounds = np.searchsorted(starts, offsets[lo : hi + 1])
            yield Group(lo, hi, codes, bounds, starts, ends, data)
            lo = hi


_SHINGLE = np.uint64(0xD6E8FEB86659FD93)


def windows(codes: np.ndarray, width: int) -> np.ndarray:
    """A code for every ``width`` words in a row, wherever texts end: window ``i`` starts at word
    ``i``. A window of another width has another code."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.full(n, width, np.uint64)
    for k in range(width):
        sums *= _SHINGLE
        sums += codes[k : k + n]
    return mix(sums)


def shingles(group: Group, width: int = 5) -> Iterator[np.ndarray]:
    """For each text its distinct shingles in ascending order: of ``width`` words, the whole
    text as one if it has fewer, none if it has no word."""
    all_windows = windows(group.codes, width)
    for a, b in zip(group.bounds[:-1].tolist(), group.bounds[1:].tolist()):
        if b - a >= width:
            yield np.unique(all_windows[a : b - width + 1])
        else:
            yield windows(group.codes[a:b], b - a) if b > a else np.zeros(0, np.uint64)
