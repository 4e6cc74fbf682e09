"""Operator 2: SimHash near-duplicates by anchor-point covering.

Fingerprints are 64-bit SimHashes of word shingles. Two fingerprints link when they
differ in at most ``max_bits`` bits. Candidates come from a covering code: the product of
two perfect binary Golay [23, 12] codes over bits 0-22 and 23-45. Every fingerprint has a
home, its nearest codeword pair (at most the covering radius, 3, away in each block), and
is replicated to every anchor within covering radius plus threshold: with block distances
dA and dB, max(0, dA - 3) + max(0, dB - 3) <= max_bits. If x and y differ in at most
max_bits bits, y therefore reaches x's home and x reaches y's; only the smaller home of
the two needs the comparison, so a fingerprint goes to anchors up to its own home.

Exact copies of a fingerprint are one class before anything is replicated. An anchor that
is nobody's home needs no replicas: the occupied anchors are a bitmap of 2^24 bits, the
same 2 MB for any number of documents. The comparison per anchor is an equi-join on the
anchor, so Spark splits a hot anchor; it returns links, never the pairs of a class.

Defined cases: a null or empty text has no words and fingerprint zero, linked like any
other; fewer words than a shingle make one shingle; repeated rows and repeated or null
ids are separate documents; ``component_id`` is the smallest non-null id of the component
(null if it has none). An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamper.llm import _text as X
from tamper.llm._spark import (arrow_batches, bitmap_filter, boxed, components, row_bitmap, table,
                               unboxed, written)

U64 = np.uint64
SHINGLE, MAX_BITS, SEED = 3, 3, 42
BITMAP_BITS = 23

# The primes of XXH64 and the generator polynomial of the Golay code.
P1, P2, P3, P4, P5 = (U64(0x9E3779B185EBCA87), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9),
                      U64(0x85EBCA77C2B2AE63), U64(0x27D4EB2F165667C5))
GOLAY = 0xC75
N, K, RADIUS = 23, 12, 3


def _rot(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U64(r)) | (x >> U64(64 - r))


def _round(acc, lane):
    return _rot(acc + lane * P2, 31) * P1


def _xxh64_rows(rows: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of each row of a uint8 matrix: all rows of one length at once."""
    n, length = rows.shape
    seed = U64(seed)
    lanes = rows[:, :length // 8 * 8].copy().view("<u8") if length >= 8 else None
    at = 0
    if length >= 32:
        acc = [np.full(n, seed + P1 + P2), np.full(n, seed + P2), np.full(n, seed),
               np.full(n, seed - P1)]
        while at + 32 <= length:
            for k in range(4):
                acc[k] = _round(acc[k], lanes[:, at // 8 + k])
            at += 32
        h = _rot(acc[0], 1) + _rot(acc[1], 7) + _rot(acc[2], 12) + _rot(acc[3], 18)
        for a in acc:
            h = (h ^ _round(np.zeros(n, U64), a)) * P1 + P4
    else:
        h = np.full(n, seed + P5)
    h = h + U64(length)
    while at + 8 <= length:
        h = _rot(h ^ _round(np.zeros(n, U64), lanes[:, at // 8]), 27) * P1 + P4
        at += 8
    if at + 4 <= length:
        lane = rows[:, at:at + 4].copy().view("<u4")[:, 0].astype(U64)
        h = _rot(h ^ (lane * P1), 23) * P2 + P3
        at += 4
    while at < length:
        h = _rot(h ^ (rows[:, at].astype(U64) * P5), 11) * P1
        at += 1
    h = (h ^ (h >> U64(33))) * P2
    h = (h ^ (h >> U64(29))) * P3
    return h ^ (h >> U64(32))


def xxh64_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED,
                long: int = 128) -> np.ndarray:
    """XXH64 of each byte span, span lengths in groups; long spans one by one."""
    out = np.empty(len(starts), U64)
    lengths = ends - starts
    order = np.argsort(np.minimum(lengths, long + 1).astype(np.uint16), kind="stable")
    edges = np.searchsorted(lengths[order], np.arange(long + 2))
    with np.errstate(over="ignore"):
        for n in range(long + 1):
            for lo in range(edges[n], edges[n + 1], 1 << 17):
                pick = order[lo:min(lo + (1 << 17), edges[n + 1])]
                out[pick] = _xxh64_rows(data[starts[pick][:, None] + np.arange(n)], seed)
    for i in order[edges[long + 1]:]:
        out[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes(), seed)
    return out


def majority_bits(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per row, the bits set in over half its hashes (none: zero). Eight byte counters
    ride in one 64-bit word, over runs of at most 255 hashes."""
    out = np.zeros(len(first) - 1, U64)
    counts = np.diff(first)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    pieces = -(-counts[full] // 255)
    base = np.concatenate(([0], np.cumsum(pieces)[:-1]))
    within = np.arange(pieces.sum()) - np.repeat(base, pieces)
    cuts = np.repeat(first[:-1][full], pieces) + 255 * within
    for k in range(8):
        lanes = (hashes >> U64(k)) & U64(0x0101010101010101)
        runs = np.add.reduceat(lanes, cuts).view(np.uint8).reshape(-1, 8).astype(np.int64)
        ones = np.add.reduceat(runs, base, axis=0)
        for byte in range(8):
            big = 2 * ones[:, byte] > counts[full]
            out[full] |= big.astype(U64) << U64(8 * byte + k)
    return out


def fingerprints(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of every text of a string column, as unsigned 64-bit."""
    data, offsets = X.text_bytes(column)
    data = X.LOWER[data]
    starts, ends, first = X.words(data, offsets, X.WHITE)
    lengths = ends - starts
    # words joined by one space, as one byte array
    at = np.concatenate(([0], np.cumsum(lengths + 1)))
    joined = np.full(int(at[-1]), 0x20, np.uint8)
    put = np.repeat(at[:-1] - starts, lengths)
    take = np.arange(lengths.sum()) + np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    joined[take + put] = data[take]
    begin, end = at[:-1], at[:-1] + lengths
    n = np.diff(first)
    per = np.where(n == 0, 0, np.maximum(n - shingle + 1, 1))
    bounds = np.concatenate(([0], np.cumsum(per)))
    head = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], per)
    tail = np.minimum(head + shingle, np.repeat(first[1:], per)) - 1
    return majority_bits(xxh64_spans(joined, begin[head], end[tail]), bounds)


def _fingerprint_batches(shingle: int):
    """Adds ``fp`` and drops the text."""
    def run(batches):
        for batch in batches:
            keep = [c for c in batch.schema.names if c != "text"]
            for part in X.chunks(batch, limit=2 << 20):
                fp = fingerprints(part.column("text"), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(fp)],
                                                 names=[*keep, "fp"])
    return run


# --- covering code ---------------------------------------------------------

def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder modulo the generator, bit by bit from the top."""
    rest = words.astype(np.int64)
    for bit in range(N - 1, N - K - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - (N - K))), rest)
    return rest


@lru_cache(maxsize=2)
def coset_tables(max_bits: int) -> list[np.ndarray]:
    """For each excess j = 0..max_bits, table[syndrome] = the error patterns of weight
    RADIUS + j in that coset (for j = 0: the one of weight up to RADIUS), padded with -1."""
    tables = []
    for j in range(max_bits + 1):
        weights = range(RADIUS + 1) if j == 0 else (RADIUS + j,)
        pats = np.array([sum(1 << b for b in c) for w in weights
                         for c in itertools.combinations(range(N), w)], dtype=np.int64)
        syn = _syndromes(pats)
        order = np.argsort(syn, kind="stable")
        counts = np.bincount(syn, minlength=1 << (N - K))
        out = np.full((1 << (N - K), max(1, counts.max())), -1, np.int64)
        rank = np.arange(len(pats)) - np.repeat(np.cumsum(counts) - counts, counts)
        out[syn[order], rank] = pats[order]
        tables.append(out)
    return tables


def homes(fp: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Index (24 bits) of each fingerprint's nearest anchor."""
    t0 = coset_tables(max_bits)[0][:, 0]
    low, high = (fp & U64(0x7FFFFF)).astype(np.int64), ((fp >> U64(N)) & U64(0x7FFFFF)).astype(np.int64)
    a, b = low ^ t0[_syndromes(low)], high ^ t0[_syndromes(high)]
    return (a >> (N - K)) << K | (b >> (N - K))


def anchors_within(fp: np.ndarray, max_bits: int = MAX_BITS):
    """(row, anchor) of every anchor within covering radius plus ``max_bits``."""
    tables = coset_tables(max_bits)
    low, high = (fp & U64(0x7FFFFF)).astype(np.int64), ((fp >> U64(N)) & U64(0x7FFFFF)).astype(np.int64)
    sa, sb = _syndromes(low), _syndromes(high)
    for ja in range(max_bits + 1):
        ea = tables[ja][sa]
        a = np.where(ea >= 0, (low[:, None] ^ ea) >> (N - K), -1)
        for jb in range(max_bits + 1 - ja):
            eb = tables[jb][sb]
            b = np.where(eb >= 0, (high[:, None] ^ eb) >> (N - K), -1)
            both = np.where((a[:, :, None] >= 0) & (b[:, None, :] >= 0),
                            a[:, :, None] << K | b[:, None, :], -1).reshape(len(fp), -1)
            row, col = np.nonzero(both >= 0)
            yield row, both[row, col]


def _home_batches(max_bits: int):
    def run(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(U64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(homes(fp, max_bits)), batch.column("fp")], names=["anchor", "fp"])
    return run


def _replica_batches(max_bits: int, occupied):
    def run(batches):
        bits = np.frombuffer(occupied.value, np.uint8)
        for batch in batches:
            whole = batch.column("fp").to_numpy()
            for lo in range(0, len(whole), 1000):
                fp = whole[lo:lo + 1000]
                home = homes(fp.view(U64), max_bits)
                for row, anchor in anchors_within(fp.view(U64), max_bits):
                    ok = (anchor <= home[row]) & (bits[anchor >> 3] >> (anchor & 7) & 1).astype(bool)
                    row, anchor = row[ok], anchor[ok]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(fp[row]), pa.array(anchor == home[row])],
                        names=["anchor", "fp", "own"])
    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): all pairs of different fingerprints (column ``fp``, distinct) within
    ``max_bits`` bits, each once."""
    spark = fps.sparkSession
    if not 0 <= max_bits <= 3:
        raise ValueError("the covering tables are built for at most 3 bits")
    home = written(fps.select("fp").mapInArrow(_home_batches(max_bits), "anchor long, fp long"),
                   "simhash-homes")
    # 2^24 anchors: at most 262,144 words of 64 bits, whatever the input
    words = row_bitmap(home, F.col("anchor")).collect()
    bitmap = np.zeros(1 << (2 * K - 6), np.int64)
    for w in words:
        bitmap[w["word"]] = w["bits"]
    occupied = spark.sparkContext.broadcast(bitmap.tobytes())
    replicas = home.select("fp").mapInArrow(_replica_batches(max_bits, occupied),
                                            "anchor long, fp long, own boolean")
    x, y = home.alias("x"), replicas.alias("y")
    near = F.expr(f"bit_count(x.fp ^ y.fp) <= {int(max_bits)} and x.fp <> y.fp "
                  "and (not y.own or x.fp < y.fp)")
    return (x.join(y, (F.col("x.anchor") == F.col("y.anchor")) & near)
            .select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b")))


def _fingerprinted(docs: DataFrame, shingle: int) -> DataFrame:
    """The columns of ``docs`` but the text, and ``fp``; written."""
    arrow_batches(docs.sparkSession)
    schema = T.StructType([f for f in docs.schema if f.name != "text"]
                          + [T.StructField("fp", T.LongType())])
    return written(docs.mapInArrow(_fingerprint_batches(shingle), schema), "simhash")


def _rooted(each: DataFrame, max_bits: int) -> DataFrame:
    """(fp, least_id, root): every different fingerprint and its component."""
    classes = written(each.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-classes")
    comp = components(links(classes.select("fp"), max_bits), "simhash-cc")
    return classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of ``docs``
    (doc_id, text)."""
    each = _fingerprinted(docs.select("doc_id", "text"), shingle)
    rooted = _rooted(each, max_bits)
    best = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    label = rooted.join(best, "root").select("fp", "component_id")
    return (each.join(label, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def representatives(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their component: the smallest
    non-null doc_id, of repeated ids the first row as stored."""
    tagged = written(boxed(docs).withColumn("tag", F.monotonically_increasing_id()), "simhash-rows")
    each = _fingerprinted(tagged.select("doc_id", "tag", "text"), shingle)
    root = written(each.join(_rooted(each, max_bits).select("fp", "root"), "fp").select(
        "root", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag").alias("row")), "simhash-roots")
    first = root.groupBy("root").agg(F.min("row").alias("best"), F.count("*").alias("n")).where("n > 1")
    losers = written(root.join(first, "root").where("row.tag <> best.tag").select("row.tag"), "simhash-out")
    index = F.expr(f"xxhash64(tag) & {(1 << BITMAP_BITS) - 1}L")
    bitmap = row_bitmap(losers, index)
    kept = bitmap_filter(tagged, bitmap, index, keep=False).unionByName(
        bitmap_filter(tagged, bitmap, index).join(losers, "tag", "left_anti"))
    return unboxed(kept, docs.columns)


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
