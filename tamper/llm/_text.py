"""Vectorised helpers over Arrow string batches: whole texts as one byte array,
words as (start, end) offsets, 64-bit word hashes. Everything works on numpy
arrays of one bounded chunk of rows; nothing here knows Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
CHUNK_BYTES = 6 << 20


def separators(*parts) -> np.ndarray:
    """Byte look-up table: True for a separator. ``parts`` are ints or (first, last)."""
    table = np.zeros(256, dtype=bool)
    for p in parts:
        first, last = p if isinstance(p, tuple) else (p, p)
        table[first:last + 1] = True
    return table


WHITE = separators(0x20, (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and the n + 1 row offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most ``limit`` text bytes (a longer row stands alone)."""
    if batch.num_rows == 0:
        return
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def words(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray):
    """(starts, ends, first) of the words; ``first[i]`` is row i's first word, n + 1 entries."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = ~sep[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cut = offsets[:-1][offsets[:-1] < n]
    begin[cut] = inside[cut]
    starts = np.flatnonzero(begin)
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    stop[last] = inside[last]
    ends = np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), so that every bit is usable."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               base: int = 0x9E3779B97F4A7C15, long: int = 48) -> np.ndarray:
    """64-bit hash of each byte span: a polynomial over its bytes, then ``mix``.
    Spans over ``long`` bytes go through XXH64, so one long word costs its own length."""
    lengths = ends - starts
    h = lengths.astype(np.uint64) + U64(base & 0xFFFF)
    live = np.flatnonzero(lengths <= long)
    r, j = U64(base | 1), 0
    while len(live):
        live = live[lengths[live] > j]
        h[live] = (h[live] * r) + data[starts[live] + j] + U64(1)
        j += 1
    for i in np.flatnonzero(lengths > long):
        h[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes(), base & 0xFFFF)
    return mix(h)


def owners(first: np.ndarray) -> np.ndarray:
    """Row number of each word, from ``first``."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
