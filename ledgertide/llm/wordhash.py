"""Words of many texts at once, and hashes of words and of runs of words, in numpy.

A word is a run of bytes other than space and 0x09 to 0x0D. Its hash is a sum of
random numbers, one for each byte at each place (tabulation), and a run's a sum
of its words' hashes with a random factor for each place. No structure of a text
makes sums over independent numbers meet, as it can with powers of one base. The
two kinds of hash use numbers of their own, so together they have 128 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.default_rng(20240229)
_PLACES = 64  # places in a word whose numbers are in a table; the others are made by mixing
_LONGEST_RUN = 32
HASHED_BYTES = 1 << 20
_KEYS = _RNG.integers(1, 2**63, (2, 256), dtype=np.uint64)
_PLACE_STEP = _RNG.integers(2**40, 2**63, 2, dtype=np.uint64) | np.uint64(1)
_RUN = _RNG.integers(2**40, 2**63, (2, _LONGEST_RUN), dtype=np.uint64) | np.uint64(1)
_TABLE = _RNG.integers(0, 2**64, (2, _PLACES, 256), dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of unsigned 64-bit integers."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)


def _hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray, kind: int) -> np.ndarray:
    """Hashes of words of ``data``, whose first begins at 0; several numbers are held for each byte."""
    place = np.arange(len(data), dtype=np.int32)
    place -= np.repeat(start, np.diff(start, append=len(data))).astype(np.int32)
    far = np.flatnonzero(place >= _PLACES)  # in long words, and in long runs of space, which no sum takes
    distant = place[far].astype(np.uint64)
    np.minimum(place, _PLACES - 1, out=place)
    place <<= 8
    place += data
    numbers = _TABLE[kind].ravel()[place]
    if len(far):
        numbers[far] = mixed(mixed(distant * _PLACE_STEP[kind]) + _KEYS[kind][data[far]])
    sums = np.add.reduceat(numbers, np.stack([start, end], 1).ravel())[::2]
    return mixed(sums + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words of texts in order: byte places, the text of each word, its place there."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    per_text: np.ndarray
    first: np.ndarray  # of each text

    @property
    def place(self) -> np.ndarray:
        return np.arange(len(self.start)) - np.repeat(self.first, self.per_text)

    def fits(self, length: int) -> np.ndarray:
        """Whether a run of ``length`` words from each word stays in its text."""
        return self.place + length <= np.repeat(self.per_text, self.per_text)

    def hashes(self, kind: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; ``kind`` 0 and 1 are independent."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        out = np.empty(len(self.start), np.uint64)
        cuts = np.unique(np.searchsorted(self.start, np.arange(0, len(self.data), HASHED_BYTES)))
        for a, b in zip(cuts, [*cuts[1:], len(self.start)], strict=True):
            if a < b:
                out[a:b] = _hashed(self.data[self.start[a]:self.end[b - 1] + 1], self.start[a:b] - self.start[a], self.end[a:b] - self.start[a], kind)
        return out

    def runs(self, hashes: np.ndarray, length: int, kind: int = 0) -> np.ndarray:
        """A hash of the ``length`` words from each word; past the end it means nothing (see ``fits``)."""
        padded = np.concatenate([hashes, np.zeros(length, np.uint64)])
        out = np.zeros(len(hashes), np.uint64)
        for k in range(length):
            out += padded[k:k + len(hashes)] * _RUN[kind, k]
        return mixed(out)


def words_of(texts: list[bytes]) -> Words:
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[data]
    start = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    end = np.flatnonzero(~space[:-1] & space[1:]) + 1
    bounds = np.cumsum([1] + [len(t) + 1 for t in texts])
    first = np.searchsorted(start, bounds)
    return Words(data, start, end, np.diff(first), first[:-1])


def planes(values: np.ndarray) -> bytes:
    """Bytes of integers, most alike bytes together, so that block compression finds them."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def ascending(values: np.ndarray) -> bytes:
    """Sorted unsigned integers as differences."""
    return planes(np.diff(values, prepend=values.dtype.type(0)))


def from_ascending(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(from_planes(data, kind), dtype=kind)
