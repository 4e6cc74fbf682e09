"""Operator 4: substring dedup by Rabin-Karp hashes of every fixed-length token window.

Every window of ``window`` consecutive words of every text gets two rolling hashes. The
first deals it to a bucket, 56 bits of the second identify it there; the number of buckets
grows with the corpus, so a bucket stays at a bounded number of windows and the total
number of identifying bits grows too (64 at 256 buckets). Windows travel packed: one row
per chunk of texts and bucket, with columns of bytes (hash, doc_id, position).

Within a chunk only the windows of the smallest doc_id of each hash travel; the others are
already known to repeat. So a passage that a third of all documents share costs one entry
per chunk, not one per document. A bucket reports, for each window that also starts in a
document with a smaller id, its (doc_id, position); positions are then merged per document
into maximal removal intervals, and only documents that may have one are joined with them.

Defined cases: null text has no words and nothing is removed; texts shorter than a window
keep everything; rows with a null id are neither a source nor removed from (a null id is
not smaller than another); rows that share an id do not repeat each
other, each is cut by itself; an empty table gives an empty result; extra columns are ignored. Windows are
judged on the input, so the order of removal does not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamper.llm import _text as X
from tamper.llm._packed import SCHEMA, packed_batch, packed_rows, part_of_ids, run_starts, unpack
from tamper.llm._spark import arrow_batches, bitmap_filter, row_bitmap, table, with_copy, written

U64 = np.uint64
WINDOW = 50
WINDOWS_PER_BUCKET = 1 << 20
BASES = (U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F))
BITMAP_BITS = 23
COPY = 40  # a position's high bits tell apart rows that share an id


def _inverse(r: int) -> int:
    return pow(r, -1, 1 << 64)


def rolling(word_hash: np.ndarray, window: int, base) -> np.ndarray:
    """Rabin-Karp hash modulo 2^64 of each run of ``window`` word hashes."""
    n = len(word_hash)
    with np.errstate(over="ignore"):
        power = np.full(n, base, U64)
        power[0] = 1
        power = np.cumprod(power)
        back = np.full(n, U64(_inverse(int(base))), U64)
        back[0] = 1
        back = np.cumprod(back)
        total = np.concatenate((np.zeros(1, U64), np.cumsum(word_hash * power)))
        return X.mix((total[window:] - total[:-window]) * back[:n - window + 1])


def windows(part: pa.RecordBatch, window: int):
    """(bucket hash, 56-bit identity, doc_id, position) of every window of a chunk."""
    known = part.filter(part.column("doc_id").is_valid())
    data, offsets = X.text_bytes(known.column("text"))
    starts, ends, first = X.words(data, offsets, X.WHITE)
    if len(starts) < window:
        none = np.zeros(0, U64)
        return none, none, none.astype(np.int64), none.astype(np.int64)
    word_hash = X.hash_spans(data, starts, ends)
    row = X.owners(first)
    begin = np.flatnonzero(row[:len(row) - window + 1] == row[window - 1:])
    deal = rolling(word_hash, window, BASES[0])[begin]
    same = rolling(word_hash, window, BASES[1])[begin] >> U64(8)
    ids = known.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
    copy = known.column("copy").to_numpy(zero_copy_only=False).astype(np.int64) << COPY
    return deal, same, ids[row[begin]], begin - first[row[begin]] + copy[row[begin]]


def _later(keys: np.ndarray, ids: np.ndarray):
    """Order by key, and for each entry in that order whether its id is over the least
    id of its key."""
    order = np.argsort(keys, kind="stable")
    runs = run_starts(keys[order])
    least = np.minimum.reduceat(ids[order], runs) if len(runs) else ids[:0]
    return order, ids[order] > np.repeat(least, np.diff(np.append(runs, len(keys))))


ENTRY, FOUND = 0, 1


def _window_batches(window: int, buckets: int):
    """Chunk -> its packed windows by bucket (kind ENTRY), and by document part the
    positions already known to repeat (kind FOUND)."""
    def run(batches):
        for batch in batches:
            for part in X.chunks(batch):
                deal, same, ids, pos = windows(part, window)
                if not len(ids):
                    continue
                bucket = (deal % U64(buckets)).astype(np.int64)
                with np.errstate(over="ignore"):
                    key = same ^ (bucket.astype(U64) * U64(0x9E3779B97F4A7C15))
                order, later = _later(key, ids)
                send, found = order[~later], order[later]
                by_id = found[np.lexsort((pos[found], ids[found]))]
                send = send[np.argsort(same[send], kind="stable")]
                yield packed_batch(
                    packed_rows(ENTRY, bucket[send], [(same << U64(8))[send], ids[send].view(U64),
                                                pos[send].view(U64)], buckets)
                    + packed_rows(FOUND, part_of_ids(ids[by_id], buckets),
                            [ids[by_id].view(U64), pos[by_id].view(U64)], buckets))
    return run


def _bucket_group(buckets: int):
    """One bucket's packed windows -> the repeated positions by document part. FOUND
    rows pass through."""
    def run(group: pa.Table) -> pa.Table:
        kinds, blobs = group.column("kind").to_numpy(), group.column("blob")
        rows = [(FOUND, p.as_py(), b.as_py()) for k, p, b in
                zip(kinds, group.column("part"), blobs, strict=True) if k == FOUND]
        entries = [unpack(b.as_py(), "u8", "u8", "u8")
                   for k, b in zip(kinds, blobs, strict=True) if k == ENTRY]
        if entries:
            same, ids, pos = (np.concatenate(c) for c in zip(*entries, strict=True))
            del entries
            ids = ids.view(np.int64)
            order, later = _later(same, ids)
            found = order[later]
            by_id = found[np.lexsort((pos[found], ids[found]))]
            rows += packed_rows(FOUND, part_of_ids(ids[by_id], buckets),
                          [ids[by_id].view(U64), pos[by_id]], buckets)
        return pa.Table.from_batches([packed_batch(rows)])
    return run


def merge(positions: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted window starts -> maximal [start, end) intervals of covered words."""
    cut = np.flatnonzero(np.diff(positions) > window)
    return (positions[np.concatenate(([0], cut + 1))],
            positions[np.concatenate((cut, [len(positions) - 1]))] + window)


def _interval_group(window: int):
    def run(group: pa.Table) -> pa.Table:
        ids, pos = (np.concatenate(c) for c in zip(
            *(unpack(b.as_py(), "u8", "u8") for b in group.column("blob")), strict=True))
        ids, pos = ids.view(np.int64), pos.astype(np.int64)
        order = np.lexsort((pos, ids))
        ids, pos = ids[order], pos[order]
        copy, pos = pos >> COPY, pos & ((1 << COPY) - 1)
        cuts = np.flatnonzero(np.concatenate(([True], (np.diff(ids) != 0) | (np.diff(copy) != 0))))
        out = [merge(pos[a:b], window) for a, b in zip(cuts, np.append(cuts[1:], len(ids)),
                                                       strict=True)]
        return pa.table({"doc_id": pa.array(ids[cuts]), "copy": pa.array(copy[cuts]),
                         "starts": pa.array([a.tolist() for a, _ in out], pa.list_(pa.int64())),
                         "ends": pa.array([b.tolist() for _, b in out], pa.list_(pa.int64()))})
    return run


def removal_intervals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, copy, starts, ends: for each row of ``docs`` (doc_id, copy, text) with
    repeated windows, the maximal intervals of word positions to remove."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(256, size // (6 * WINDOWS_PER_BUCKET))
    packed = (docs.select("doc_id", "copy", "text").mapInArrow(_window_batches(window, buckets), SCHEMA)
              .groupBy("part").applyInArrow(_bucket_group(buckets), SCHEMA))
    return packed.groupBy("part").applyInArrow(
        _interval_group(window), "doc_id long, copy long, starts array<long>, ends array<long>")


def cut(text: str | None, starts, ends) -> tuple[int, int, str]:
    """(words, removed words, kept words joined by one space) of a text."""
    got = _split(text)
    if starts is None or not len(starts):
        return len(got), 0, " ".join(got)
    keep, at = [], 0
    for a, b in zip(starts, ends, strict=True):
        keep += got[at:a]
        at = b
    keep += got[at:]
    return len(got), len(got) - len(keep), " ".join(keep)


_SPACE = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})


def _split(text: str | None) -> list[str]:
    return [w for w in (text or "").translate(_SPACE).split(" ") if w]


def _cut_batches(digest: bool):
    def run(batches):
        for batch in batches:
            texts, a, b = (batch.column(c).to_pylist() for c in ("text", "starts", "ends"))
            n, gone, kept = zip(*map(cut, texts, a, b), strict=True) if texts else ((), (), ())
            if digest:
                kept = [hashlib.sha256(k.encode()).hexdigest() for k in kept]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the text left, or its SHA-256) of every row."""
    spark = docs.sparkSession
    arrow_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = with_copy(docs.select("doc_id", "text"))
    found = written(removal_intervals(docs, window), "substring")
    index = F.expr(f"xxhash64(doc_id) & {(1 << BITMAP_BITS) - 1}L")
    # 2^23 bits at most: which documents can have an interval at all
    bitmap = row_bitmap(found, index)
    may = bitmap_filter(docs, bitmap, index).join(found, ["doc_id", "copy"], "left")
    clear = bitmap_filter(docs, bitmap, index, keep=False).select(
        "*", F.lit(None).cast("array<long>").alias("starts"),
        F.lit(None).cast("array<long>").alias("ends"))
    return may.unionByName(clear).mapInArrow(
        _cut_batches(digest), f"doc_id {kind}, n_words long, n_removed long, kept string")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return remove_repeats(docs, digest=True).withColumnRenamed("kept", "kept_sha256")
