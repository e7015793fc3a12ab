"""64-bit hashes of words, word n-grams and byte strings, many at a time in numpy.

``Substrings``: a string's hash is the sum of a random number per byte times a power of
an odd multiplier, modulo 2**64, so that differences of one running sum give the hash of
every substring. Strings can be made whose sums agree in many low bits, so it only
proposes; what it says is confirmed by other hashes or by bytes. ``words``: each byte with
its place in the word has a number of its own, and these are summed.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
MULTIPLIER = _U(0x9E3779B97F4A7C15 | 4 | 1)
INVERSE = _U(pow(int(MULTIPLIER), -1, 1 << 64))
BYTE_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, np.uint64) * _U(2) + _U(1)
_powers = {True: np.ones(1, np.uint64), False: np.ones(1, np.uint64)}


def powers(n: int, up: bool) -> np.ndarray:
    """multiplier ** i (or its inverse's powers) for i below n; kept for reuse."""
    known = _powers[up]
    if len(known) < n:
        steps = np.full(max(n, 1 << 20), MULTIPLIER if up else INVERSE, np.uint64)
        steps[0] = 1
        known = _powers[up] = np.multiply.accumulate(steps)
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits over all (the finalizer of a 64-bit generator)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Substrings:
    """Hashes of substrings of one byte array."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * powers(n, True), out=self.sums[1:])
        self.inverse = powers(n + 1, False)

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.inverse[starts]

    def windows(self, length: int) -> np.ndarray:
        """Of every window of ``length`` bytes, by its start."""
        n = len(self.sums) - 1 - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[length:] - self.sums[:n]) * self.inverse[:n]


WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


PLACES = 64  # places in a word with a table of random numbers; mixed ones follow
PLACED = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 64, PLACES * 256, np.uint64, endpoint=False)


def placed(byte: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A number for each byte and its place in its word, unlike all others."""
    out = PLACED[np.minimum(place, PLACES - 1) * 256 + byte]
    far = np.flatnonzero(place >= PLACES)
    out[far] = mix(BYTE_VALUES[byte[far]] ^ mix(place[far].astype(np.uint64)))
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word of texts that stand one after another."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    black = ~WHITE[data]
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets] = True
    start = black.copy()
    start[1:] &= ~black[:-1] | opens[1:-1]
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(black)
    begins = np.searchsorted(at, starts)
    sizes = np.diff(begins, append=len(at))
    sums = np.add.reduceat(placed(data[at], at - np.repeat(starts, sizes)), begins)
    return mix(sums + sizes.astype(np.uint64)), np.searchsorted(offsets, starts, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word n-grams of each text as (hashes, ends of the texts' parts), sorted
    inside each text. A text of fewer words has one, its whole sequence; one without
    words has none."""
    n = len(offsets) - 1
    hashed, text = words(LOWER[data], offsets)
    counts = np.bincount(text, minlength=n)
    step = _U(0xD6E8FEB86659FD93)

    def chain(first: np.ndarray, size: int) -> np.ndarray:
        h = np.full(len(first), size, np.uint64)
        for k in range(size):
            h = h * step + hashed[first + k]
        return mix(h)

    found = []
    if len(hashed) >= length:
        first = np.arange(len(hashed) - length + 1)
        first = first[text[first] == text[first + length - 1]]
        found.append((text[first], chain(first, length)))
    begins = np.cumsum(counts) - counts
    for size in range(1, length):
        short = np.flatnonzero(counts == size)
        if len(short):
            found.append((short, chain(begins[short], size)))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    owner, h = np.concatenate([o for o, _ in found]), np.concatenate([h for _, h in found])
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.cumsum(np.bincount(owner[new], minlength=n))


def segment_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums, modulo 2**64, of consecutive parts; empty parts give 0."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    return sums[ends] - sums[starts]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every part, one part after another."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
