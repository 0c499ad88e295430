"""Words of many texts at once, as arrays: where each begins, and 64-bit fingerprints of words and of runs of words.

A batch of UTF-8 texts is laid out in one byte buffer with a separator between texts. A fingerprint is a polynomial over
the ring of 64-bit integers with an odd base, read off prefix sums, so its cost does not depend on the run's length.
"""

from __future__ import annotations

import numpy as np

#: Bytes per buffer: texts are taken together up to this size, a longer text alone. Its arrays then stay in the CPU's cache.
BUFFER = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Base:
    """Random byte values and the powers of an odd base with their inverses."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 58, 1 << 60)) * 8 + 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 1 << 16, 2 * len(self.powers))
            for name, base in (("powers", self.base), ("inverses", self.inverse)):
                a = np.full(size, np.uint64(base))
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums of value times power; entry i is the sum of the first i."""
        self.upto(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.inverses[starts])


_BASES: dict[int, _Base] = {}


def base(seed: int) -> _Base:
    if seed not in _BASES:
        _BASES[seed] = _Base(seed)
    return _BASES[seed]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit integer over all of them; one to one."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Words:
    """The words of one group of texts.

    `starts`, `ends`: byte places in `buffer`. `first`: for each text, the index of its first word; one entry more than texts.
    """

    def __init__(self, texts: list[bytes], lower: bool = False, space: np.ndarray = _SPACE):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if lower:
            self.buffer = _LOWER[self.buffer]
        inside = ~space[self.buffer]
        edges = np.flatnonzero(np.diff(inside, prepend=False)) if len(inside) else np.empty(0, np.int64)
        self.starts, self.ends = edges[0::2], edges[1::2]
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(lengths + 1, out=offsets[1:])
        self.offsets = offsets
        self.first = np.searchsorted(self.starts, offsets)
        self.texts = len(texts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """For each word, the index of its text."""
        return np.repeat(np.arange(self.texts), self.counts())

    def hashes(self, seed: int = 1) -> np.ndarray:
        b = base(seed)
        return b.spans(b.sums(b.values[self.buffer]), self.starts, self.ends)

    def word(self, i: int) -> bytes:
        return self.buffer[self.starts[i] : self.ends[i]].tobytes()


def groups(texts: list[bytes], size: int = BUFFER):
    """(from, to) of consecutive texts that fit a buffer together."""
    begin = total = 0
    for i, t in enumerate(texts):
        if i > begin and total + len(t) > size:
            yield begin, i
            begin, total = i, 0
        total += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)


def runs(hashes: np.ndarray, first: np.ndarray, width: int, seed: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all runs of `width` consecutive words that lie in one text, and the index of each run's first word."""
    if len(hashes) < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    b = base(seed)
    sums = b.sums(hashes)
    at = np.arange(len(hashes) - width + 1)
    last = np.repeat(first[1:], np.diff(first))[: len(at)] - width  # last start in the same text
    at = at[at <= last]
    return b.spans(sums, at, at + width), at
