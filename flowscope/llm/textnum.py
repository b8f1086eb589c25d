"""Vectorised word scanning and hashing over UTF-8 bytes.

Word classes are defined on bytes; all separators used here are ASCII, so no
multi-byte character is ever cut. Words are identified by a 64-bit hash
(random per-byte values, polynomial positions, a bijective finaliser): two
different words of one corpus collide with odds of about 2**-57 per pair.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_rng = np.random.default_rng(20240229)
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
STEP = U(0x9E3779B97F4A7C15)
STEP_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
GRAM_STEP = U(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# white space [\x20\x09-\x0D]
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
# letters a-z, digits and every byte of a non-ASCII character
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP**i and STEP**-i for i < n, kept per process and grown by doubling."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, step in enumerate((STEP, STEP_INVERSE)):
            t = np.full(size, step, np.uint64)
            t[0] = 1
            _powers[k] = np.multiply.accumulate(t)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> U(33))
    h *= U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span data[start:end] (prefix sums, no per-span loop)."""
    power, inverse = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * power[:-1], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64) * GRAM_STEP)


def word_spans(data: np.ndarray, offsets: np.ndarray, word: np.ndarray,
               cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): spans of maximal runs of word bytes inside each row;
    the words of row r are first[r]:first[r+1]. ``cut`` marks bytes that also
    begin a new word."""
    n, rows = len(data), len(offsets) - 1
    if n == 0:
        e = np.empty(0, np.int64)
        return e, e, np.zeros(rows + 1, np.int64)
    inside = np.zeros(n + 1, bool)
    inside[:n] = word[data]
    begins = inside[:n].copy()
    begins[1:] &= ~inside[:n - 1]
    edge = offsets[:-1]
    edge = edge[edge < n]
    if cut is not None:
        begins |= cut & inside[:n]
    begins[edge] = inside[edge]
    starts = np.flatnonzero(begins)
    stop = np.zeros(n + 1, bool)
    stop[n] = True
    stop[:n] = begins | ~inside[:n]
    stop[edge] = True
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, side="right")]
    return starts, ends, np.searchsorted(starts, offsets)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive word hashes (length max(0, n - k + 1))."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= GRAM_STEP
        out += h[j: j + n]
    return mix(out)


def gram_starts(first: np.ndarray, k: int) -> np.ndarray:
    """For each row the number of k-grams that lie inside it."""
    return np.maximum(np.diff(first) - k + 1, 0)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of arange(start, start + count)."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    if total == 0:
        return np.empty(0, np.int64)
    out = np.ones(total, np.int64)
    keep = counts > 0
    s, c = np.asarray(starts, np.int64)[keep], counts[keep]
    at = np.cumsum(c)[:-1]
    out[0] = s[0]
    out[at] = s[1:] - (s[:-1] + c[:-1] - 1)
    return np.cumsum(out)
