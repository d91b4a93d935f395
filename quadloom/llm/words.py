"""Words of many texts at once: places and 64-bit hashes with numpy, bounded memory.

A text is bytes (UTF-8). Everything works on a chunk, several texts joined by a line feed, so
the cost per text is small and no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes `[\x20\x09-\x0D]` between words.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of one chunk, and of one block of hashing; a longer text is a chunk of its own.
CHUNK, BLOCK = 2 << 20, 1 << 20

_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95  # odd, 5 modulo 8
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if len(have) <= 4 * BLOCK:
            _powers[base] = have
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit sums (the finish of SplitMix64, in public use)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def byte_texts(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column; null is empty."""
    if pa.types.is_null(column.type):
        return [b""] * len(column)
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `limit` bytes, or of one text."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


class Words:
    """Words of a chunk of texts: byte places `start`, `end`, and `first`, the index of each
    text's first word (one more entry than texts)."""

    def __init__(self, texts: list[bytes], white: np.ndarray = WHITE):
        self.raw = b"\n".join(texts)
        self.data = np.frombuffer(self.raw, np.uint8)
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.text_start = np.concatenate([[0], np.cumsum(lengths + 1)])
        inside = np.zeros(len(self.data) + 2, np.int8)
        inside[1:-1] = ~white[self.data]
        if not white[10]:  # texts stay apart also where a line feed is part of words
            inside[self.text_start[1:-1]] = 0
        change = np.diff(inside)
        self.start = np.flatnonzero(change == 1)
        self.end = np.flatnonzero(change == -1)
        self.first = np.searchsorted(self.start, self.text_start)
        self.count = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word, equal for equal words."""
        out = np.empty(len(self.start), np.uint64)
        base = inverse(_BYTE_BASE)
        a = 0
        while a < len(out):
            b = max(a + 1, int(np.searchsorted(self.end, self.start[a] + BLOCK)))
            lo, hi = int(self.start[a]), int(self.end[b - 1])
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum((self.data[lo:hi].astype(np.uint64) + np.uint64(1)) * powers(_BYTE_BASE, hi - lo), out=sums[1:])
            s, e = self.start[a:b] - lo, self.end[a:b] - lo
            out[a:b] = (sums[e] - sums[s]) * powers(base, hi - lo)[s]
            a = b
        return mixed(out)

    def texts(self) -> Iterator[tuple[int, int]]:
        """Word range of each text."""
        return zip(self.first[:-1].tolist(), self.first[1:].tolist())


def window_hashes(words: np.ndarray, size: int, base: int = _WORD_BASE) -> np.ndarray:
    """A 64-bit hash of every `size` words in a row; entry i is for words i to i+size-1.
    Windows across texts are the caller's to leave out."""
    n = len(words)
    if n < size:
        return np.empty(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * powers(base, n), out=sums[1:])
    return mixed((sums[size:] - sums[:-size]) * powers(inverse(base), n)[: n - size + 1])


def window_owner(first: np.ndarray, size: int) -> np.ndarray:
    """True for the window starts that lie within one text."""
    n = int(first[-1])
    ok = np.ones(max(0, n - size + 1), bool)
    for f in first[1:-1]:
        ok[max(0, f - size + 1) : f] = False
    return ok


def sums_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of per-word values for each text."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]
