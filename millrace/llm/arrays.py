"""Words and rolling hashes of many texts at once, as numpy arrays.

Texts are handled as their UTF-8 bytes. Hashes are polynomials modulo 2**64
(Rabin-Karp): a prefix sum of `value * base**-position`, so the hash of any span
is one subtraction and one product. Spans are mixed afterwards. Two seeds give
two independent hashes, 128 bits together.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache
from inspect import signature

import numpy as np
import pyarrow as pa

_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)  # odd, so they have inverses
_MASK = (1 << 64) - 1

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    size = 1 << max(12, (max(n, 1) - 1).bit_length())
    if size > 1 << 22:  # only for a single very long text
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    return _powers(base, size)[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Rabin-Karp hash of values[start:end] for every span."""
    base = _BASES[seed]
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    back = powers(pow(base, -1, 1 << 64), len(values))
    np.cumsum(values.astype(np.uint64) * back, dtype=np.uint64, out=sums[1:])
    spans = (sums[ends] - sums[starts]) * powers(base, len(values) + 1)[starts]
    return mix(spans + (ends - starts).astype(np.uint64) * np.uint64(_BASES[1 - seed]))


class Words:
    """The words of a run of texts: byte spans, and where each text's words begin.

    `first[i]:first[i + 1]` are the words of text i.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = LOWER_ASCII[data] if lower else data
        inside = ~SPACES[self.data]
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        cuts = offsets[offsets < len(data)]
        before[cuts] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        after[cuts[cuts > 0] - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return span_hashes(self.data.astype(np.uint64) + np.uint64(1), self.starts, self.ends, seed)

    def windows(self, length: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Starts (word numbers) and hashes of all windows of `length` words
        that lie in one text."""
        n = len(self.starts)
        whole = np.zeros(n + 1, dtype=np.int64)
        last = np.maximum(self.first[1:] - length + 1, self.first[:-1])
        np.add.at(whole, self.first[:-1], 1)
        np.add.at(whole, last, -1)
        at = np.flatnonzero(np.cumsum(whole[:n]) > 0)
        return at, span_hashes(self.hashes(seed), at, at + length, seed)


def text_runs(column: pa.Array, most_bytes: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of texts of at most
    `most_bytes` bytes, or of one longer text. Nulls are empty texts."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + most_bytes, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def _let_go() -> None:
    """Give back memory that is no longer used. A Python worker lives as long as the
    application, beside the workers of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """`run`, over Arrow batches, that gives back its memory at the end of a task."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _let_go()

    return tidied


def tidy_group(run: Callable) -> Callable:
    """`run`, over one table or two, that gives back its memory after each group."""

    def one(table: pa.Table) -> pa.Table:
        out = run(table)
        _let_go()
        return out

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left, right)
        _let_go()
        return out

    return one if len(signature(run).parameters) == 1 else two
