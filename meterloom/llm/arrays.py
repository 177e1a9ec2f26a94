"""Hashes of byte strings with numpy; used inside tasks on one text at a time.

A text's prefix sums of byte codes times powers of an odd base (all modulo 2^64) give
the hash of any substring by a difference, so windows cost a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Codes of the 256 bytes: the start of a fixed random sequence.
CODES = np.random.Generator(np.random.PCG64(20240601)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; the longest answer so far is kept."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        _powers[base] = known = np.multiply.accumulate(known)
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others (a fixed bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(CODES[data] * powers(BASE, len(data)), out=sums[1:])
    return sums


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair, lengths included."""
    raw = (sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts]
    return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text, A-Z taken as a-z."""
    data = np.frombuffer(text.lower(), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    inside = np.concatenate(([False], ~SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return spans(prefix_sums(data), edges[0::2], edges[1::2])


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; of all words, if they are fewer."""
    words = word_hashes(text or b"")
    if not len(words):
        return words
    n = min(n, len(words))
    value = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        value = mixed(value * np.uint64(BASE) + words[k : len(words) - n + 1 + k])
    return np.unique(value)




def texts(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a binary column, one at a time."""
    for value in column:
        yield value.as_py()


def flat(values: list[np.ndarray], dtype=np.int64) -> pa.Array:
    joined = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.array(joined.view(dtype) if joined.dtype != dtype else joined)


def lists(values: list[np.ndarray]) -> pa.Array:
    """A list<int64> column of one array per row."""
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values], dtype=np.int64)))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat(values))
