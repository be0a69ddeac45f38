"""Vectorised helpers over the UTF-8 bytes of Arrow string columns."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32

#: Odd base of the polynomial hashes modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and their offsets; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, data = column.buffers()
    if where is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(where, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def powers(count: int, base: int = BASE) -> np.ndarray:
    """base**0 .. base**(count - 1) modulo 2**64."""
    steps = np.full(max(count, 1), base & _MASK, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)[:count]


def inverse_powers(count: int, base: int = BASE) -> np.ndarray:
    return powers(count, pow(base, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit (as in SplitMix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_hashes(data: np.ndarray, offsets: np.ndarray, block: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and document number of every word of lower-cased texts, in order.

    Works in blocks that end at white space or between texts, so that memory follows the block and not the batch.
    """
    hashes, owners = [], []
    start, n = 0, len(data)
    edges = np.zeros(n + 1, bool)
    edges[offsets] = True
    while start < n:
        stop = min(n, start + block)
        while stop < n and not (edges[stop] or IS_SPACE[data[stop]]):
            step = IS_SPACE[data[stop : stop + 4096]] | edges[stop : min(stop + 4096, n)]
            found = int(step.argmax())
            stop = stop + found if step[found] else min(n, stop + 4096)
        part = TO_LOWER[data[start:stop]]
        solid = ~IS_SPACE[part]
        edge = edges[start:stop]
        first = solid.copy()
        first[1:] &= ~solid[:-1] | edge[1:]
        starts = np.flatnonzero(first)
        if len(starts):
            ends_here = np.empty(len(solid), bool)
            ends_here[:-1] = solid[:-1] & (~solid[1:] | edge[1:])
            ends_here[-1] = solid[-1]
            lengths = np.flatnonzero(ends_here) + 1 - starts
            table = powers(int(lengths.max()))
            where = np.flatnonzero(solid)
            first_of = np.cumsum(lengths) - lengths
            inside = np.arange(len(where)) - np.repeat(first_of, lengths)
            terms = (part[where].astype(np.uint64) + np.uint64(1)) * table[inside]
            h = np.add.reduceat(terms, first_of)
            hashes.append(mix(h + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
            owners.append(np.searchsorted(offsets, starts + start, side="right") - 1)
        start = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def trimmed(step: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``step`` whose worker gives freed memory back to the system when the task ends; idle workers then hold little."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)

    return run


def batches_of(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``limit`` bytes (one longer text stays whole)."""
    _, offsets = flat(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop
