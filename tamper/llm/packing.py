"""Operator 6: packing along a space-filling curve.

Every text becomes token ids; its hashed histogram of ids is projected to ``DIMS``
dimensions and quantised, and the Hilbert index of that cell is the document's place on
the curve. Documents are range-sorted by it (ties by a row number), and the stream of their
ids is cut every ``length`` ids: neighbours on the curve share sequences, and only the very
last sequence is padded.

Ids are computed once, into a table in the shared folder. The order is found on narrow
rows (key, row, count): a range sort, one count per range, and running sums within ranges;
one join brings the offsets back to the ids. No range depends on the number of equal keys,
since ties are split by the row number.

Defined cases: null text is empty; an empty text is the end id alone; repeated rows and
repeated or null ids are packed each; an empty table gives no pieces; extra columns are
ignored. A text of any length is cut into as many pieces as it needs.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamper.llm import _text as X
from tamper.llm._spark import arrow_batches, table, written
from tamper.llm._tokens import tokens

LENGTH, END_ID = 2048, 1
DIMS, BITS, BUCKETS = 4, 12, 256
SPREAD = 12.0


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer cells (n, dims): Gray-code undoing, bit by bit from the
    top, then the bits of all dimensions interleaved (after Skilling 2004)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for d in range(dims):
            up = (x[d] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap if d else 0
        q >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where(x[-1] & q, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> b) & 1)
    return key


def _projection() -> np.ndarray:
    return np.random.default_rng(11).standard_normal((BUCKETS, DIMS))


@lru_cache(maxsize=4)
def _buckets(n: int) -> np.ndarray:
    """The bucket of each id below n."""
    with np.errstate(over="ignore"):
        return (X.mix(np.arange(n, dtype=np.uint64)) >> np.uint64(56)).astype(np.int64)


def curve_keys(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Place on the curve of each document, from its ids."""
    n = len(first) - 1
    bucket = _buckets(1 << int(ids.max(initial=0)).bit_length())[ids]
    row = X.owners(first)
    hist = np.bincount(row * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
    share = hist / np.maximum(np.diff(first), 1)[:, None]
    place = np.tanh(SPREAD / 4 * (share - 1 / BUCKETS) @ _projection())
    top = (1 << BITS) - 1
    return hilbert(np.clip((place + 1) / 2 * top, 0, top).astype(np.int64))


def _id_batches(path: str, end_id: int):
    def run(batches):
        coder = tokens(path)
        for batch in batches:
            for part in X.chunks(batch, limit=2 << 20):
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids, first = coder.encode(texts)
                keys = curve_keys(ids, first)
                kind = np.uint16 if coder.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
                end = np.array([end_id], kind)
                blobs = [np.concatenate((ids[a:b].astype(kind), end)).tobytes()
                         for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(keys), pa.array(np.diff(first) + 1),
                     pa.array([kind().itemsize] * len(blobs), pa.int32()), pa.array(blobs, pa.binary())],
                    names=["doc_id", "key", "n", "width", "ids"])
    return run


def _piece_batches(length: int):
    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("doc", "start", "length", "crc", "n", "sequence", "offset")}
            for i, (at, n, width, blob) in enumerate(zip(
                    *(batch.column(c).to_pylist() for c in ("at", "n", "width", "ids")), strict=True)):
                ids = np.frombuffer(blob, f"<u{width}").astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    size = min(length - offset, n - start)
                    for k, v in zip(out, (i, start, size, zlib.crc32(ids[start:start + size].tobytes()),
                                          n, sequence, offset), strict=True):
                        out[k].append(v)
                    start += size
            ids = batch.column("doc_id").take(pa.array(out.pop("doc"), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(v, pa.int64()) for v in out.values())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def places(rows: DataFrame) -> DataFrame:
    """rid, at: ids before each row of (rid, key, n) in the order of (key, rid)."""
    ranged = written(rows.repartitionByRange("key", "rid")
                     .withColumn("part", F.spark_partition_id()), "packing-order")
    # one row a range: its number does not grow with a range's rows
    before = (ranged.groupBy("part").agg(F.sum("n").alias("total"))
              .select("part", F.coalesce(F.sum("total").over(
                  Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")))
    run = Window.partitionBy("part").orderBy("key", "rid").rowsBetween(Window.unboundedPreceding, -1)
    inner = ranged.withColumn("inner", F.coalesce(F.sum("n").over(run), F.lit(0)))
    return inner.join(F.broadcast(before), "part").select(
        "rid", (F.col("base") + F.col("inner")).cast("long").alias("at"))


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH,
         end_id: int = END_ID) -> DataFrame:
    """The pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    arrow_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = written(docs.select("doc_id", "text").mapInArrow(
        _id_batches(path or vocabulary(), end_id),
        f"doc_id {kind}, key long, n long, width int, ids binary")
        .withColumn("rid", F.monotonically_increasing_id()), "packing-ids", compression="zstd")
    placed = ids.join(places(ids.select("rid", "key", "n")), "rid")
    return placed.select("doc_id", "at", "n", "width", "ids").mapInArrow(
        _piece_batches(length), f"doc_id {kind}, start long, length long, ids_crc32 long, "
                                "doc_tokens long, sequence_id long, offset long")


def op6_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"))
