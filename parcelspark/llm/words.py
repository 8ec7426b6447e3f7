"""Words of a text and hashes of runs of words, vectorised per text."""

from __future__ import annotations

import numpy as np
import xxhash

# Words a worker remembers with their hashes; a full memory is emptied, which costs time only.
CACHE_ENTRIES = 100_000
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def each(column, size: int = 256):
    """The values of an Arrow column; few of them are Python objects at a time."""
    for start in range(0, len(column), size):
        yield from column[start : start + size].to_pylist()


def split(text: str | bytes) -> list[bytes]:
    """Runs of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return."""
    return (text.encode() if isinstance(text, str) else text).split()


def hashed(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


_PIECE = 1 << 16


def spelled(text: str | bytes) -> np.ndarray:
    """64-bit hash of each word, all words of a piece of text at once: faster than ``hashed`` where many words are
    new, with hashes of its own. Long texts are taken piece by piece, cut between words."""
    data = np.frombuffer(text.encode() if isinstance(text, str) else text, np.uint8)
    blank = np.empty(len(data) + 2, bool)
    blank[0] = blank[-1] = True
    np.less(data - np.uint8(9), 5, out=blank[1:-1])  # tab to carriage return; lower codes wrap around
    blank[1:-1] |= data == 32
    edges = np.flatnonzero(blank[1:] != blank[:-1])  # words begin and end in turn
    starts, ends = edges[::2], edges[1::2]
    if len(data) <= _PIECE:
        return Runs(data.astype(np.uint64) + np.uint64(1)).of(starts, ends)
    found, at = [np.zeros(0, np.uint64)], 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _PIECE, "right")))
        low, high = int(starts[at]), int(ends[to - 1])
        found.append(Runs(data[low:high].astype(np.uint64) + np.uint64(1)).of(starts[at:to] - low, ends[at:to] - low))
        at = to
    return np.concatenate(found)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, at least n of them."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < n:
        size = max(1024, 1 << n.bit_length())
        inverse = pow(base, -1, 1 << 64)
        made = []
        for factor in (base, inverse):
            powers = np.full(size, factor, np.uint64)
            powers[0] = 1
            made.append(np.multiply.accumulate(powers))
        known = _POWERS[base] = (made[0], made[1])
    return known


class Runs:
    """Hashes of runs of consecutive words, each from two prefix sums."""

    def __init__(self, hashes: np.ndarray, lane: int = 0):
        self.powers, self.inverse = _powers(_BASES[lane], len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.powers[: len(hashes)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = (ends - starts).astype(np.uint64)
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + lengths)

    def each(self, size: int) -> np.ndarray:
        """Of every run of ``size`` words."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[size:] - self.sums[:n]) * self.inverse[:n] + np.uint64(size))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
