"""Packed exchange: many small integers travel as one binary row for each chunk of input
and target part, so that a shuffle moves few rows and its compression sees byte planes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tamper.llm import _text as X

U64 = np.uint64
SCHEMA = "kind int, part long, blob binary"


def pack(*columns: np.ndarray) -> bytes:
    """Columns of integers as byte planes, high bytes first: sorted or small values leave
    planes that the shuffle's compression removes."""
    return b"".join(c.astype(f">u{c.itemsize}").view(np.uint8).reshape(-1, c.itemsize)
                    .T.tobytes() for c in columns)


def unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    n = len(blob) // sum(sizes) if blob else 0
    flat, at, out = np.frombuffer(blob, np.uint8), 0, []
    for k, s in zip(kinds, sizes, strict=True):
        planes = flat[at:at + n * s].reshape(s, n).T
        out.append(np.ascontiguousarray(planes).view(f">u{s}")[:, 0].astype(k))
        at += n * s
    return out


def run_starts(sorted_keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal values."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))


def packed_rows(kind: int, part_of: np.ndarray, planes: list[np.ndarray], count: int):
    """One row (kind, part, blob) for each part that has entries; entries stay in order."""
    if not len(part_of):
        return []
    order = np.argsort(part_of.astype(np.uint16) if count <= 1 << 16 else part_of, kind="stable")
    cuts = run_starts(part_of[order])
    ends = np.append(cuts[1:], len(order))
    return [(kind, int(part_of[order[a]]), pack(*(p[order[a:b]] for p in planes)))
            for a, b in zip(cuts, ends, strict=True)]


def packed_batch(found) -> pa.RecordBatch:
    kind, part, blob = zip(*found, strict=True) if found else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(part, pa.int64()), pa.array(blob, pa.binary())],
        names=["kind", "part", "blob"])


def part_of_ids(ids: np.ndarray, parts: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (X.mix(ids.view(U64)) % U64(parts)).astype(np.int64)
