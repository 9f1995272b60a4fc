"""Vectorised text kernels used inside tasks: words, hashes and windows.

Everything here works on one bounded chunk of documents at a time, as numpy
arrays over the UTF-8 bytes that Spark hands over in Arrow batches; nothing
loops over words in Python. Spark does the partitioning and the shuffles.

Hashes are 64-bit sums modulo 2**64: a sequence x_0 .. x_{k-1} becomes
mix(sum(code(x_i) * P**i)), so that one prefix sum answers every window. Such sums
have equal values for some sequences of 1,024 and more (two letters in the order
of Thue and Morse and their complement), so they serve sequences of up to
LONGEST and words beyond it get a cryptographic code. Hashes stand for equality;
operators that must not rely on 64 bits take two, or compare the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 17         # the arrays of a chunk stay within a core's cache
LONGEST = 64                  # bytes of a word that a sum stands for

_U = np.uint64
_P = 0x9E3779B97F4A7C15 | 3          # odd, so that it has an inverse
_PINV = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_CODE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_pow: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the life of the worker up to 4 chunks."""
    have = _pow.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        out = np.full(size, base, dtype=_U)
        out[0] = 1
        have = np.cumprod(out, dtype=_U)
        if size <= 4 * CHUNK_BYTES:
            _pow[base] = have
    return have[:n]


class Rolling:
    """Hashes of any window of a sequence of codes, from one prefix sum."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.sums = np.zeros(n + 1, dtype=_U)
        np.cumsum(codes * powers(_P, n), dtype=_U, out=self.sums[1:])

    def windows(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, dtype=_U)
        return mix((self.sums[ends] - self.sums[starts]) * powers(_PINV, int(starts.max()) + 1)[starts])

    def raw(self, k: int) -> np.ndarray:
        """Unmixed hash of the k codes from each start 0 .. n-k (the high bits are spread, the low ones
        are not); empty if there are fewer."""
        m = len(self.sums) - k
        if m <= 0:
            return np.zeros(0, dtype=_U)
        out = self.sums[k:] - self.sums[:m]
        out *= powers(_PINV, m)
        return out

    def all(self, k: int) -> np.ndarray:
        """Hash of the k codes from each start 0 .. n-k."""
        return mix(self.raw(k))


@dataclass
class Chunk:
    """Documents first .. first+len(offsets)-2 of a batch: their bytes, laid end to end."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a text column into chunks of about ``limit`` bytes (a longer text is a chunk of its
    own); a null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, off, buf = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        lo, hi = int(offsets[at]), int(offsets[to])
        yield Chunk(at, data[lo:hi], offsets[at:to + 1] - lo)
        at = to


# Bytes that belong to words. Fixed values of the contracts.
_SPACE = np.ones(256, dtype=bool)           # words [^\x20\x09-\x0D]+
_SPACE[[0x20, *range(0x09, 0x0E)]] = False
_ALNUM = np.zeros(256, dtype=bool)          # words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
WORD_BYTES = {"space": _SPACE, "alnum": _ALNUM}
LOWER = np.arange(256, dtype=np.uint8)      # A-Z only
LOWER[0x41:0x5B] += 32


@dataclass
class Words:
    """Words of a chunk, in order: byte spans, and where each document's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray      # document d has words bounds[d] .. bounds[d+1]-1

    def codes(self) -> np.ndarray:
        """A 64-bit code for each word's bytes."""
        out = Rolling(_CODE[self.data]).windows(self.starts, self.ends)
        for i in np.flatnonzero(self.ends - self.starts > LONGEST):
            out[i] = int.from_bytes(hashlib.blake2b(self.data[self.starts[i]:self.ends[i]], digest_size=8).digest(), "little")
        return out

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def words(chunk: Chunk, kind: str = "space", lower: bool = False) -> Words:
    data, offsets = chunk.data, chunk.offsets
    if lower:
        data = LOWER[data]
    inside = WORD_BYTES[kind][data]
    n = len(data)
    begin, end = inside.copy(), inside.copy()
    if n:
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        cut = offsets[(offsets > 0) & (offsets < n)]
        begin[cut] = inside[cut]
        end[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets).astype(np.int64))


def window_starts(bounds: np.ndarray, k: int) -> np.ndarray:
    """Starts of all k-windows that lie within one document."""
    n = int(bounds[-1])
    if n < k:
        return np.zeros(0, dtype=np.int64)
    ok = np.ones(n, dtype=bool)
    last = np.maximum(bounds[1:] - (k - 1), bounds[:-1])
    size = bounds[1:] - last
    ok[np.repeat(last - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))] = False
    return np.flatnonzero(ok)


def cover(starts: np.ndarray, lengths, n: int) -> np.ndarray:
    """Which of n places are covered by an interval starts[i] .. starts[i]+lengths[i]-1."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths, -1)
    return np.cumsum(step[:n]) > 0


def runs(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true runs; a run never crosses a bound."""
    begin, end = mask.copy(), mask.copy()
    if len(mask):
        begin[1:] &= ~mask[:-1]
        end[:-1] &= ~mask[1:]
        cut = bounds[(bounds > 0) & (bounds < len(mask))]
        begin[cut] = mask[cut]
        end[cut - 1] = mask[cut - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values within each document."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]
