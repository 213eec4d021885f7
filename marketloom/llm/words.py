"""Words and word hashes of whole Arrow text columns, for use inside tasks.

Texts are handled as one UTF-8 byte array per chunk of rows, so that no Python
object is made per word. A word is a maximal run of bytes other than
``\\x20\\x09-\\x0D``; no byte of a multi-byte character is in that set.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Rows are taken together up to this many bytes of text; a longer text is a chunk of its own.
CHUNK_BYTES = 1_000_000
_BLOCK_BITS = 16  # prefix sums and powers are computed in blocks of this many bits of places

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_rng = np.random.Generator(np.random.PCG64(20240229))
_SYMBOL = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SYMBOL_AGAIN = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, and not 1 modulo 8


def symbols() -> np.ndarray:
    """The value of each byte in span hashes."""
    return _SYMBOL


class Chunk(NamedTuple):
    """Rows ``first`` to ``last`` (exclusive) of a batch, their bytes, and each row's first byte."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def _powers(base: int) -> np.ndarray:
    """base**i modulo 2**64 over a block."""
    p = np.full(1 << _BLOCK_BITS, base % 2**64, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def prefix_sums(values: np.ndarray, table: np.ndarray | None = None, base: int = _BASE) -> np.ndarray:
    """Sums of value times base**place before each place, modulo 2**64 (one more at the end); ``table`` maps the values."""
    up, step = _powers(base), pow(base, 1 << _BLOCK_BITS, 2**64)
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0], scale = 0, 1
    for a in range(0, len(values), 1 << _BLOCK_BITS):
        part = values[a : a + (1 << _BLOCK_BITS)]
        own = (part if table is None else table[part]) * up[: len(part)]
        own *= np.uint64(scale)
        own[0] = (int(own[0]) + int(sums[a])) % 2**64
        np.cumsum(own, out=sums[a + 1 : a + 1 + len(part)])
        scale = scale * step % 2**64
    return sums


def down(at: np.ndarray, base: int = _BASE) -> np.ndarray:
    """base**-place modulo 2**64."""
    inverse = pow(base, -1, 2**64)
    low = _powers(inverse)[at & ((1 << _BLOCK_BITS) - 1)]
    block = at >> _BLOCK_BITS
    if not len(at) or not block.any():
        return low
    high = np.full(int(block.max()) + 1, pow(inverse, 1 << _BLOCK_BITS, 2**64), np.uint64)
    high[0] = 1
    return low * np.multiply.accumulate(high)[block]


def release() -> None:
    """Give memory that is no longer used back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def freed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``; workers live on after a task, and without what it freed."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return whole


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The column in chunks of whole rows; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        own = offsets[first : last + 1]
        yield Chunk(first, last, raw[own[0] : own[-1]], own - own[0])
        first = last


class Words(NamedTuple):
    """Word bounds in bytes, and the number of the first word of each row (one more at the end)."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def split(chunk: Chunk) -> Words:
    data, offsets = chunk.data, chunk.offsets
    n = len(data)
    inside = np.zeros(n + 1, bool)  # one space after the end
    np.logical_not(_SPACE[data], out=inside[:n])
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside[:n] & ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] |= inside[cuts]
    ends[cuts - 1] |= inside[cuts - 1]
    start = np.flatnonzero(begins[:n])
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def lowered(chunk: Chunk) -> Chunk:
    """A-Z in lower case, nothing else changed."""
    return chunk._replace(data=_LOWER[chunk.data])


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, again: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte span, from prefix sums of a polynomial; ``again`` gives a second one."""
    sums = prefix_sums(data, _SYMBOL_AGAIN if again else _SYMBOL)
    return mix((sums[end] - sums[start]) * down(start))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive word hashes (rows not respected)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = words[:n] * _PLACE[0]
    for j in range(1, size):
        total += words[j : n + j] * _PLACE[j]
    return mix(total)


def long_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = 0xD1342543DE82EF95) -> np.ndarray:
    """Hash of the word runs ``start`` to ``end``, of any length, from prefix sums."""
    sums = prefix_sums(words, base=base)
    return mix((sums[end] - sums[start]) * down(start, base) + (end - start).astype(np.uint64))


def shingle_sets(hashes: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, sorted, and where each row's begin.

    A row of fewer than ``size`` words has its whole sequence as one shingle, a
    row without words none.
    """
    count = np.diff(first)
    size_of = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    begin = np.concatenate([[0], np.cumsum(size_of)])
    row = np.repeat(np.arange(len(count)), size_of)
    grams = gram_hashes(hashes, size)
    at = np.arange(len(row)) - begin[row] + first[:-1][row]
    short = np.flatnonzero((count > 0) & (count < size))
    values = grams[np.minimum(at, len(grams) - 1)] if len(grams) else np.zeros(len(row), np.uint64)
    if len(short):
        values[begin[:-1][short]] = long_hashes(hashes, first[:-1][short], first[1:][short])
    for b, e in zip(begin.tolist(), begin[1:].tolist()):
        if e - b > 1:
            values[b:e].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[new], row[new]
    return values, np.searchsorted(row, np.arange(len(count) + 1))
