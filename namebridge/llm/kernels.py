"""Numpy steps over the UTF-8 bytes of many texts at once."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes that end a word: blank, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_BASE = U64(0x9E3779B97F4A7C15)
_PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * _BASE)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_PIECE + 1, int(_BASE) | 1)
_INV = _powers(_PIECE + 1, pow(int(_BASE) | 1, -1, 1 << 64))


def release() -> None:
    """Gives memory that is free, but kept by the allocators, back to the system: Spark keeps workers between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_KEPT: dict = {}


def kept(key, make: Callable):
    """What a worker keeps from task to task; one such thing at a time."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def tidy(run: Callable, limit: int = 1 << 23, keeps: bool = False) -> Callable:
    """A function of batches that releases memory after large batches and at the end of its task.

    Unless it ``keeps`` something itself, it drops what tasks of another kind have left in the worker.
    """

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            _KEPT.clear()
        try:
            held = 0
            for batch in run(batches):
                held += batch.nbytes
                yield batch
                del batch
                if held > limit:
                    release()
                    held = 0
        finally:
            release()

    return inner


def tidy_groups(run: Callable, schema: pa.Schema) -> Callable:
    """A function of a group's data frame as one of its batches (``applyInArrow``) that releases memory after each group.

    With ``applyInPandas`` Spark holds the group's frame until after the function, so that it cannot be released.
    """

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            out = run(pa.Table.from_batches(batches).to_pandas())
            yield from pa.Table.from_pandas(out, schema=schema, preserve_index=False).to_batches()
            del out
        finally:
            release()

    return inner


def binary_views(column: pa.Array, dtype: type) -> list[np.ndarray]:
    """Each value of a binary column without nulls as an array over the column's own memory."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return []
    _, raw, data = column.buffers()
    offsets = np.frombuffer(raw, np.int64, len(column) + 1, column.offset * 8)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return [bytes_[a:b].view(dtype) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def text_chunks(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about ``limit`` bytes; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, raw, data = column.buffers()
    offsets = np.frombuffer(raw, np.int64, n + 1, column.offset * 8)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        stop = min(stop, n)
        yield start, bytes_[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; a run never crosses a text's end."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < n)]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, of its length too. Works in pieces, so memory is bounded."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        upto = max(at + 1, int(np.searchsorted(ends, base + _PIECE, "right")))
        if int(ends[at]) - base > _PIECE:  # one span longer than a piece
            h = np.zeros(1, U64)
            for p in range(base, int(ends[at]), _PIECE):
                part = BYTE_CODES[data[p : min(p + _PIECE, int(ends[at]))]]
                h = mix(h + (part * _POW[: len(part)]).sum(dtype=U64))
            out[at] = h[0]
            upto = at + 1
        else:
            s, e = starts[at:upto] - base, ends[at:upto] - base
            size = int(e[-1])
            sums = np.zeros(size + 1, U64)
            np.cumsum(BYTE_CODES[data[base : base + size]] * _POW[:size], out=sums[1:])
            out[at:upto] = (sums[e] - sums[s]) * _INV[s]
        at = upto
    return mix(out + (ends - starts).astype(U64) * _BASE)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words between blanks, and each text's first word (one entry more)."""
    starts, ends = spans(~SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words, and each text's first run (one entry more).

    A text of fewer words has one run, of all its words; one without words has none.
    """
    n = np.diff(first)
    count = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    begin = np.concatenate([[0], np.cumsum(count)])
    where = np.repeat(first[:-1] - begin[:-1], count) + np.arange(begin[-1])
    length = np.repeat(np.minimum(n, width), count)
    out = length.astype(U64)
    padded = np.concatenate([hashes, np.zeros(width, U64)])
    for k in range(width):
        out = mix(out * _BASE + np.where(k < length, padded[where + k], U64(0)))
    return out, begin
