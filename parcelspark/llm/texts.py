"""Words and hashes of many texts at a time, with numpy, inside Arrow tasks."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text worked on at a time; a longer text is taken alone.
SLICE_BYTES = 2 << 20
#: A-Z to a-z; then also all ASCII but letters and digits to a blank.
LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
PLAIN = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in LOWER)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], U64)
STEP = U64(0x9E3779B97F4A7C15)


def texts_of(column: pa.Array) -> list[bytes]:
    """The texts of a binary column; null is empty."""
    return [x or b"" for x in column.to_pylist()]


def slices(texts: list[bytes], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs (from, to) of texts with at most ``most`` bytes, or of one text."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers, in place."""
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def times(n: int) -> np.uint64:
    """``n`` steps, modulo 2^64."""
    return U64(n * int(STEP) % 2 ** 64)


class Words:
    """Words between white space of several texts: start, end (bytes in ``data``), text (its number), hash.

    Words of up to eight bytes have different hashes, longer ones 64-bit hashes of all their bytes.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b" ".join(texts)
        if lower:
            joined = joined.translate(LOWER)
        self.data = joined + b" " * 9
        raw = np.frombuffer(self.data, np.uint8)
        edges = np.flatnonzero(np.diff(IS_SPACE[raw].view(np.int8), prepend=1))
        self.start, self.end = edges[0::2], edges[1::2]
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        self.text = np.searchsorted(ends, self.start, "right")
        self.count = np.bincount(self.text, minlength=len(texts))
        self.first = np.cumsum(self.count) - self.count
        self.hash = byte_hashes(self.data, self.start, self.end)

    def windows(self, size: int) -> np.ndarray:
        """Numbers of the words at which a window of one text starts."""
        n = len(self.start)
        if n < size:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.text[:n - size + 1] == self.text[size - 1:])


def byte_hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch of ``data``, which must go on for eight bytes after the last one."""
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    left = (end - start).astype(np.int64)
    h = eight[start] & KEEP[np.minimum(left, 8)]
    mixed(h)
    h += np.minimum(left, 8).astype(U64) * STEP
    more = np.flatnonzero(left > 8)
    at = 8
    while len(more):
        rest = left[more] - at
        h[more] = mixed((h[more] * STEP) ^ (eight[start[more] + at] & KEEP[np.minimum(rest, 8)])) + rest.astype(U64)
        at += 8
        more = more[rest > 8]
    return h


def grams(h: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """A hash of each ``size`` consecutive numbers, the order counted."""
    out = np.zeros(max(0, len(h) - size + 1), U64)
    factor = U64(0xD6E8FEB86659FD93 + 2 * salt)
    for k in range(size):
        out *= factor
        out += h[k:k + len(out)]
    return mixed(out)


def sliding_min(v: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive values."""
    out, have = v, 1
    while have < size:
        step = min(have, size - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out
