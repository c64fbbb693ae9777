"""Words of whole texts as numpy arrays, straight from Arrow's string buffers.

A word is a run of bytes other than ASCII white space, which is the same as a run of such characters
in UTF-8. Texts of a batch are taken in slices of about ``SLICE_BYTES``, so memory does not depend on
how many texts a batch has; one longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Odd, so it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = (values ^ (values >> np.uint64(33))) * _MIX[0]
    values = (values ^ (values >> np.uint64(33))) * _MIX[1]
    return values ^ (values >> np.uint64(33))


def _byte_values(fold: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    if fold:
        values[65:91] = values[97:123]
    return values


_VALUES = {fold: _byte_values(fold) for fold in (False, True)}


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(base: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return powers(_BASE), powers(pow(_BASE, -1, 1 << 64))


class Slice:
    """Some texts of a batch: rows ``low`` to ``high``, their bytes, and the words in them."""

    def __init__(self, low: int, data: np.ndarray, bounds: np.ndarray, like: Slice | None = None):
        """``like`` is a slice with the same words, whose bytes ``data`` replaces."""
        self.low, self.high, self.data, self.bounds = low, low + len(bounds) - 1, data, bounds
        self.starts, self.ends, self.edges = (like.starts, like.ends, like.edges) if like else self.runs(SPACE)

    def runs(self, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the runs between separators; those of text i are edges[i] to edges[i + 1]."""
        data, bounds, space = self.data, self.bounds, separators[self.data]
        word = ~space
        first, last = word.copy(), word.copy()
        first[1:] &= space[:-1]
        last[:-1] &= space[1:]
        inside = bounds[(bounds > 0) & (bounds < len(data))]
        first[inside] = word[inside]
        last[inside - 1] = word[inside - 1]
        starts = np.flatnonzero(first)
        return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)

    def text(self, row: int) -> bytes:
        return self.data[self.bounds[row] : self.bounds[row + 1]].tobytes()

    def hashes(self, fold: bool) -> np.ndarray:
        """A 64-bit hash per word; ``fold`` takes A-Z as a-z."""
        return self.run_hashes(self.starts, self.ends, fold)

    def run_hashes(self, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
        """A 64-bit hash of the bytes of each run."""
        if not len(starts) or not len(self.data):
            return np.zeros(len(starts), np.uint64)
        size = max(SLICE_BYTES, 1 << (len(self.data) - 1).bit_length())
        up, down = _powers(size)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_VALUES[fold][self.data] * up[: len(self.data)], out=sums[1:])
        value = (sums[ends] - sums[starts]) * down[np.minimum(starts, size - 1)]
        return mix(value + (ends - starts).astype(np.uint64))

    def sums(self, counted: np.ndarray) -> np.ndarray:
        """For each text, the sum over its bytes of a value per byte."""
        return np.diff(np.concatenate([[0], np.cumsum(counted, dtype=np.int64)])[self.bounds])


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """Slices of a string column; a null counts as an empty text."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    count = len(column)
    if not count:
        return
    bounds = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + count + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    low = 0
    while low < count:
        high = int(np.searchsorted(bounds, bounds[low] + size, "right")) - 1
        high = min(max(high, low + 1), count)
        yield Slice(low, data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
        low = high


def windows(hashes: np.ndarray, edges: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside one text, and the edges of each text's runs."""
    if len(hashes) < width:
        return np.empty(0, np.uint64), np.zeros(len(edges), np.int64)
    total = np.zeros(len(hashes) - width + 1, np.uint64)
    for i in range(width):
        total += hashes[i : i + len(total)] * np.uint64((_BASE * (2 * i + 1) + 2 * i) % (1 << 64))
    total = mix(total)
    counts = np.maximum(np.diff(edges) - (width - 1), 0)
    new_edges = np.concatenate([[0], np.cumsum(counts)])
    keep = np.repeat(edges[:-1] - new_edges[:-1], counts) + np.arange(new_edges[-1])
    return total[keep], new_edges
