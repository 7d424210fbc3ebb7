"""Words and word shingles of whole texts, by numpy over the bytes of many texts at once.

Words are maximal runs outside [\x20\x09-\x0D], with A-Z lower-cased. Two hashes are
offered: a 64-bit polynomial hash of shingles, for candidate search, computed
for all bytes at once; and XXH64 of the shingle's text, where a contract names it.
"""

from __future__ import annotations

import numpy as np
import xxhash

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


_known: dict[np.uint64, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 up to base**(n - 1) modulo 2**64; kept, as blocks are of like size."""
    powers = _known.get(base, np.ones(1, np.uint64))
    with np.errstate(over="ignore"):
        while len(powers) < n:
            powers = np.concatenate([powers, powers * (powers[-1] * base)])
    _known[base] = powers
    return powers[:n]


class Words:
    """The words of a list of texts: where each starts and ends in ``data``, and
    which of them belong to each text (``first[i]`` up to ``first[i + 1]``)."""

    def __init__(self, texts: list[str | None]):
        encoded = [(t or "").encode() for t in texts]
        raw = b"\n".join([*encoded, b""])
        self.data = _LOWER[np.frombuffer(raw, np.uint8)]
        edge = np.diff(np.concatenate([[True], _SPACE[self.data], [True]]).astype(np.int8))
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)
        self.first = np.searchsorted(self.start, np.cumsum([0, *[len(t) + 1 for t in encoded]]))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        n = len(self.data)
        # sums of byte * base**position, shifted to the word's start: exact arithmetic modulo 2**64
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
            value = (sums[self.end] - sums[self.start]) * _powers(_INVERSE, n)[self.start]
            return mix(value + (self.end - self.start).astype(np.uint64) * _STEP)

    def of(self, i: int) -> list[bytes]:
        """The words of a text."""
        a, b = self.first[i], self.first[i + 1]
        if a == b:
            return []
        return self.data[self.start[a] : self.end[b - 1]].tobytes().split()

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each run of ``width`` words within a text, and the text it is of."""
        words = self.hashes()
        if len(words) < width:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            value = np.zeros(len(words) - width + 1, np.uint64)
            for k in range(width):
                value = mix(value + words[k : len(words) - width + 1 + k] + np.uint64(k + 1))
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        inside = text[: len(value)] == text[width - 1 :]
        return value[inside], text[: len(value)][inside]

    def xxh64(self, width: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
        """XXH64 of each shingle's text, its words joined by one space, and each
        text's number of shingles. A text with fewer words has one: all of them; a
        text without words has none."""
        lengths = self.end - self.start
        # the words again, each behind one space
        ends = np.cumsum(lengths + 1)
        total = int(ends[-1]) if len(ends) else 0
        packed = np.full(total, 0x20, np.uint8)
        body = np.repeat(self.start - (ends - lengths), lengths) + _inside(ends - lengths, lengths)
        packed[_inside(ends - lengths, lengths)] = self.data[body]
        view = packed.tobytes()
        starts, stops = (ends - lengths).tolist(), ends.tolist()
        out: list[int] = []
        counts = np.zeros(len(self.first) - 1, np.int64)
        digest = xxhash.xxh64_intdigest
        edges = self.first.tolist()
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            if b - a >= width:
                out += [digest(view[s:e], seed) for s, e in zip(starts[a : b - width + 1], stops[a + width - 1 : b])]
                counts[i] = b - a - width + 1
            elif b > a:
                out.append(digest(view[starts[a] : stops[b - 1]], seed))
                counts[i] = 1
        return np.array(out, np.uint64), counts


def _inside(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, in a row."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view("<u8").ravel()


def bit_counts(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many of each run of hashes (of ``counts`` each, in a row) have each of the 64 bits.

    Each byte of a hash becomes eight bytes of a bit each, which add up as one 64-bit
    number for 255 hashes at a time without carrying over."""
    out = np.zeros((len(counts), 64), np.int64)
    filled = np.flatnonzero(counts)
    if len(filled):
        n = counts[filled]
        pieces = -(-n // 255)
        first = np.cumsum(pieces) - pieces
        starts = np.repeat(np.cumsum(n) - n, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
        lanes = _LANES[hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)]
        parts = np.add.reduceat(lanes, starts, axis=0).view(np.uint8)
        out[filled] = np.add.reduceat(parts, first, axis=0, dtype=np.int64)
    return out
