"""Hashes of words, shingles and byte n-grams over whole Arrow text columns, with numpy.

All texts of a column lie in one byte buffer. A prefix sum of ``code(byte) * P**i``
(mod 2**64) gives the hash of any substring in two look-ups, so words and n-grams cost
a few array operations each and no Python loop. Work runs in blocks of about
``BLOCK_BYTES``, which bounds the memory they take, cut between texts; one longer text is a block of
its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18
U64 = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_P_INVERSE = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


CODES = mix(np.arange(1, 257, dtype=U64) * U64(_P))
_FOLD = np.arange(256)
_FOLD[65:91] += 32  # A-Z
FOLDED_CODES = CODES[_FOLD]
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers = np.ones(1, dtype=U64)
_inverses = np.ones(1, dtype=U64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of P and of its inverse up to exponent ``n``; kept for the next block."""
    global _powers, _inverses
    if len(_powers) > max(n, BLOCK_BYTES):
        return _powers, _inverses
    size = max(n, BLOCK_BYTES) + 1
    powers, inverses = (np.full(size, U64(base), dtype=U64) for base in (_P, _P_INVERSE))
    for table in (powers, inverses):
        table[0] = 1
        np.multiply.accumulate(table, out=table)
    if n <= 4 * BLOCK_BYTES:
        _powers, _inverses = powers, inverses
    return powers, inverses


class Block(NamedTuple):
    """Some texts of a column: their bytes, one after another, and where each begins."""

    first: int  # row of the first text
    data: np.ndarray  # uint8
    starts: np.ndarray  # int64, one more than texts

    @property
    def rows(self) -> int:
        return len(self.starts) - 1


def blocks(column: pa.Array | pa.ChunkedArray, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cuts a text column into blocks. A null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, values = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    starts = starts[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(starts, starts[at] + block_bytes, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        yield Block(at, data[starts[at] : starts[to]], starts[at : to + 1] - starts[at])
        at = to


class Prefix(NamedTuple):
    """Prefix sums of a block, from which any substring's hash follows."""

    sums: np.ndarray
    inverses: np.ndarray

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverses[start])


def prefix(data: np.ndarray, codes: np.ndarray = FOLDED_CODES) -> Prefix:
    powers, inverses = _tables(len(data))
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(codes[data] * powers[: len(data)], out=sums[1:])
    return Prefix(sums, inverses)


class Words(NamedTuple):
    start: np.ndarray  # byte positions in the block
    end: np.ndarray
    row: np.ndarray  # text of the block each word is in
    bounds: np.ndarray  # first word of each text, one more than texts


def words(block: Block) -> Words:
    """Runs of bytes other than space, tab, line feed, vertical tab, form feed, carriage return."""
    n = len(block.data)
    inside = np.zeros(n + 1, dtype=bool)
    np.logical_not(SPACE[block.data], out=inside[:n])
    cut = np.zeros(n + 1, dtype=bool)
    cut[block.starts] = True
    previous = np.concatenate(([False], inside[:-1]))
    start = np.flatnonzero(inside & (~previous | cut))
    end = np.flatnonzero(previous & (~inside | cut))
    bounds = np.searchsorted(start, block.starts)
    row = np.repeat(np.arange(block.rows), np.diff(bounds))
    return Words(start, end, row, bounds)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the runs [start, start + length), one run after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring bounds; empty runs give zero."""
    sums = np.zeros((len(values) + 1, *values.shape[1:]), dtype=values.dtype)
    np.cumsum(values, axis=0, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def shingle_sets(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text its distinct ``size``-word shingles as sorted hashes, and their bounds.

    A text of fewer words has one shingle, its whole word sequence; one without words none.
    Letters A-Z count as lower case.
    """
    found = words(block)
    hashed = prefix(block.data).hashes(found.start, found.end)
    counts = np.diff(found.bounds)
    width = np.minimum(counts, size)
    number = np.where(counts > 0, counts - width + 1, 0)
    first = ranges(found.bounds[:-1], number)
    wide = np.repeat(width, number)
    value = wide.astype(U64)
    for k in range(size):
        inside = wide > k
        part = hashed[np.where(inside, first + k, 0)] if len(hashed) else value
        value = np.where(inside, mix(value * U64(_P) + part), value)
    bounds = np.concatenate(([0], np.cumsum(number)))
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a > 1:
            value[a:b].sort()
    fresh = np.ones(len(value), dtype=bool)
    if len(value):
        fresh[1:] = value[1:] != value[:-1]
        fresh[bounds[:-1][number > 0]] = True
    kept = np.concatenate(([0], np.cumsum(fresh)))
    return value[fresh], kept[bounds]


def as_long(x: np.ndarray) -> np.ndarray:
    return x.astype(U64, copy=False).view(np.int64)
