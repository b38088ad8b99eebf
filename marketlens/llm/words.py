"""Words of Arrow text batches as hash arrays.

The word classes here are classes of UTF-8 bytes, so a batch of texts is cut
into words on its byte buffer, without a Python object per word.  A word's
hash is a polynomial of random byte values modulo 2**64, read off running
sums.  Long batches are hashed in segments that end between words, so the
arrays stay small whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
SEGMENT = 1 << 20
CHUNK = 1 << 21
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


class WordClass:
    """Which bytes form words; A-Z count as a-z."""

    def __init__(self, is_word):
        self.mask = np.array([is_word(b) for b in range(256)])
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        values = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
        self.value = values[self.lower]
        self.value[~self.mask] = 0


#: Runs of letters, digits and characters beyond ASCII.
ALNUM = WordClass(lambda b: b >= 128 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)
#: Runs of anything but ASCII white space.
NONBLANK = WordClass(lambda b: b != 32 and not 9 <= b <= 13)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of x reaches every bit of the result."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = max(n, SEGMENT)
        up, down = np.full(n, U(_BASE)), np.full(n, U(_UNBASE))
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _powers


@dataclass
class Words:
    """Words of some texts: hash, bytes start and end in ``data``; text t has words first[t] to first[t + 1] - 1."""

    data: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def text(self, i: int, n: int, lower: np.ndarray) -> bytes:
        """Words i to i + n - 1, lower-cased and joined by one space."""
        return b" ".join(lower[self.data[s:e]].tobytes() for s, e in zip(self.start[i:i + n], self.end[i:i + n]))


def words_of(data: np.ndarray, offsets: np.ndarray, kind: WordClass) -> Words:
    """The words of the texts data[offsets[t]:offsets[t + 1]]."""
    hashes, starts, ends = [], [], []
    a, last = int(offsets[0]), int(offsets[-1])
    while a < last:
        b = min(last, a + SEGMENT)
        while b < last and kind.mask[data[b]] and kind.mask[data[b - 1]]:  # not inside a word
            more = np.flatnonzero(~kind.mask[data[b:b + SEGMENT]])
            b = b + int(more[0]) if len(more) else min(last, b + SEGMENT)
        part = data[a:b]
        inside = kind.mask[part]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edges = offsets[(offsets > a) & (offsets < b)] - a  # a word ends with its text
        begins[edges] = inside[edges]
        stops[edges - 1] = inside[edges - 1]
        s, e = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        if len(s):
            up, down = _power_tables(len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(kind.value[part] * up[:len(part)], out=sums[1:])
            hashes.append(mixed((sums[e] - sums[s]) * down[s]))
            starts.append(s + a)
            ends.append(e + a)
        a = b
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return Words(data, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), start,
                 np.concatenate(ends) if ends else np.zeros(0, np.int64), np.searchsorted(start, offsets))


def runs_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on; the last n - 1 have none."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    factor = 1
    for j in range(n):
        out += hashes[j:j + len(out)] * U(factor)
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
    return mixed(out + U(n))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow text column; null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def chunks_of(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of slices of about ``size`` bytes; a longer text is one slice."""
    data, offsets = text_buffers(column)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, b, data, offsets[a:b + 1]
        a = b
