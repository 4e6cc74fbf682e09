"""Operator 9: line dedup by a segment-partition edit join.

Lines are near duplicates when they are equal or within ``max_edits`` edits (insert, delete
or replace one code point). A line is cut into max_edits + 1 segments; of two lines within
max_edits edits, one segment of the shorter stands unchanged in the longer, near its place.
So every line indexes its segments under (segment number, length, content), and probes, for
each length from its own down by max_edits, the substrings that the position windows of
the partition allow. Entries meet in buckets (packed, one row for each chunk and bucket);
equal keys whose letter parities differ in at most 2 * max_edits bits are candidates, and
candidates of different lines are verified on their texts with a banded bit-parallel edit
distance: one small integer per error count, a bit for each diagonal of the band.

Equal lines are one class before anything is joined (a min per line hash, combined
map-side); links between different lines are joined to classes by connected components.
Each class keeps its first line, by (doc_id, copy, line number), and every other one is
removed. Equal lines of any length are a class; lines shorter than ``min_chars`` take no
part in the edit join, where two edits would change too much of them. Shorter lines of
white space alone separate others and stay.

Skew: a line in a third of all documents is one class row after map-side combining; each
chunk sends a line's entries once. A key that many lines share (crowded) is never gathered.
Chunks that hold many of its entries deal them to salted parts and send its bucket only a
mark; a bucket that meets a mark, or counts more than CROWD entries of a key while it reads
its blobs one by one, passes them on as rows. Of such lines the shared segment is cut out:
what is left of two lines within max_edits edits is within max_edits edits again (the edits
before the segment and those after it), so the same partition is made of the rests, with
segments that split the differing positions of that key's lines evenly instead of their
length, and the key is refined by them until it is no longer crowded. Keys of bounded size
are compared with their texts in one group, which returns links that connect them; keys
that cannot be refined (hardly any text left) in one group for each pair of blocks.

Defined cases: null text has no lines; an empty text is one empty line; rows with a null
id are neither source nor changed; rows that share an id are told apart by a hash of their
text; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamper.llm import _text as X
from tamper.llm._packed import SCHEMA, packed_batch, packed_rows, run_starts, unpack
from tamper.llm._skew import lookup
from tamper.llm._spark import (arrow_batches, bitmap_filter, boxed, components, row_bitmap, table,
                               unboxed, with_copy, written)

U64 = np.uint64
MAX_EDITS, MIN_CHARS = 2, 20
ENTRIES_PER_BUCKET = 1 << 20
BLOCK, PAIRS_PER_LINE = 1 << 11, 2
# entries of a key: in one chunk before they are salted, in all before the key is refined
LOCAL, CROWD = 1 << 9, 1 << 12
HELD = 1 << 21  # entries that a bucket holds before it looks for crowded keys
GROUP_BYTES = 8 << 20  # of the lines of one group
SPLIT_CHARS = 1 << 20  # of the rests that one worker splits or samples at a time
SAMPLE = 256  # lines of a crowded key that its cuts are chosen from; any cuts are right
MARK = 0xFFFF
BITMAP_BITS = 23
BASE = 0x9FB21C651E98DF25
INDEX, PROBE = 0, 1


def lines_of(texts: list, min_chars: int, short: bool = False):
    """(row, line number, line) of every line of at least ``min_chars`` code points; with
    ``short`` also of every shorter one that is not blank."""
    return [(row, number, line) for row, text in enumerate(texts) if text
            for number, line in enumerate(text.split("\n"))
            if len(line) >= min_chars or short and line.strip()]


def identities(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each line as two halves: the first names it, both identify it."""
    both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in lines), ">u8").reshape(-1, 2)
    return both[:, 1].astype(U64), both[:, 0].astype(U64)


class Prefix:
    """Polynomial hashes of any span of an array of code points."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        with np.errstate(over="ignore"):
            power, back = np.full(n + 1, U64(BASE)), np.full(n + 1, U64(pow(BASE, -1, 1 << 64)))
            power[0] = back[0] = 1
            power = np.cumprod(power)
            self.back = np.cumprod(back)
            mixed = X.mix(points.astype(U64) + U64(1))
            self.total = np.concatenate((np.zeros(1, U64), np.cumsum(mixed * power[:n])))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return X.mix((self.total[end] - self.total[start]) * self.back[start]
                         + (end - start).astype(U64))


def segments(length: np.ndarray, parts: int) -> tuple[list, list]:
    """Offsets and lengths of ``parts`` even segments, the longer ones last."""
    short, longer = length // parts, length % parts
    sizes = [short + (i >= parts - longer) for i in range(parts)]
    at, places = np.zeros_like(length), []
    for s in sizes:
        places.append(at)
        at = at + s
    return places, sizes


def signatures(prefix: Prefix, start: np.ndarray, end: np.ndarray, max_edits: int):
    """(line, key, code): index keys of every segment, probe keys of every substring that
    can equal a segment of a line up to max_edits shorter. The code holds the role and
    where the span lies (segment, how much shorter, how far moved)."""
    parts, length = max_edits + 1, end - start
    lines, keys, codes = [], [], []

    def add(pick, part, indexed, at, size, role, shorter=0, move=0):
        h = prefix(start[pick] + at, start[pick] + at + size)
        with np.errstate(over="ignore"):
            key = X.mix(h ^ ((indexed.astype(U64) * U64(64) + U64(part)) * U64(0x9E3779B97F4A7C15)))
        lines.append(pick)
        keys.append(key)
        codes.append(np.full(len(pick), role | part << 1 | shorter << 4 | move + max_edits << 7, np.uint16))

    every = np.arange(len(start))
    places, sizes = segments(length, parts)
    for i in range(parts):
        add(every, i, length, places[i], sizes[i], INDEX)
    for shorter in range(max_edits + 1):
        indexed = length - shorter
        ok = np.flatnonzero(indexed >= parts)
        places, sizes = segments(indexed[ok], parts)
        for i in range(parts):
            low = max(-i, shorter - (max_edits - i))
            high = min(i, shorter + (max_edits - i))
            for move in range(low, high + 1):
                at = places[i] + move
                fit = (at >= 0) & (at + sizes[i] <= length[ok])
                add(ok[fit], i, indexed[ok][fit], at[fit], sizes[i][fit], PROBE, shorter, move)
    return np.concatenate(lines), np.concatenate(keys), np.concatenate(codes)


def rest_of(line: str, code: int, max_edits: int) -> str:
    """The line without the span of an entry."""
    part, shorter, move = code >> 1 & 7, code >> 4 & 7, (code >> 7) - max_edits
    short, longer = divmod(len(line) - shorter, max_edits + 1)
    even = max_edits + 1 - longer  # segments before the longer ones
    at = part * short + max(0, part - even) + move
    return line[:at] + line[at + short + (part >= even):]


def parities(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """32 bits for each span: the parity of the counts of code points by hash class."""
    bit = np.left_shift(np.uint32(1), (X.mix(points.astype(U64)) >> U64(59)).astype(np.uint32))
    total = np.concatenate((np.zeros(1, np.uint32), np.bitwise_xor.accumulate(bit)))
    return total[end] ^ total[start]


def _entry_batches(max_edits: int, min_chars: int, buckets: int):
    def run(batches):
        for batch in batches:
            for part in X.chunks(batch, limit=2 << 20):
                lines = list({x for _, _, x in lines_of(part.column("text").to_pylist(), min_chars)})
                if not lines:
                    continue
                name, _ = identities(lines)
                points = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
                end = np.cumsum([len(x) for x in lines])
                start = np.concatenate(([0], end[:-1]))
                prefix = Prefix(points)
                parity = parities(points, start, end)
                line, key, code = signatures(prefix, start, end, max_edits)
                order = np.argsort(key, kind="stable")
                line, key, code = line[order], key[order], code[order]
                first = run_starts(key)
                times = np.diff(np.append(first, len(key)))
                crowded, salt = first[times >= LOCAL], np.repeat(times >= LOCAL, times)
                with np.errstate(over="ignore"):
                    dealt = np.where(salt, X.mix(key ^ name[0]), key)
                bucket = (dealt % U64(buckets)).astype(np.int64) + np.where(salt, buckets, 0)
                marks = len(crowded)
                planes = [np.concatenate((key[crowded], key)),
                          np.concatenate((np.zeros(marks, U64), name[line])),
                          np.concatenate((np.zeros(marks, np.uint32), parity[line])),
                          np.concatenate((np.full(marks, MARK, np.uint16), code))]
                bucket = np.concatenate(((key[crowded] % U64(buckets)).astype(np.int64), bucket))
                yield packed_batch(packed_rows(0, bucket, planes, 2 * buckets))
    return run


CANDIDATES = "a long, b long, g long, code int, parity long"


def _close(parity, name, own, ask, max_edits: int):
    """Index pairs (into own, ask) of different lines whose parities allow max_edits."""
    i, j = np.nonzero((np.bitwise_count(parity[own][:, None] ^ parity[ask]) <= 2 * max_edits)
                      & (name[own][:, None] != name[ask]))
    return own[i], ask[j]


def _member_rows(key, name, parity, code) -> pa.RecordBatch:
    """Entries as rows (a, g, code, parity) without b."""
    return pa.RecordBatch.from_arrays(
        [pa.array(name.view(np.int64)), pa.nulls(len(name), pa.int64()), pa.array(key.view(np.int64)),
         pa.array(code.astype(np.int32)), pa.array(parity.astype(np.int64))],
        names=["a", "b", "g", "code", "parity"])


def _distinct(held: list, crowded: np.ndarray, most: int):
    """Entries in order of key and name, each once, and the crowded keys: those marked or
    known, and those with more than ``most`` entries."""
    key, name, parity, code = (np.concatenate(c) for c in zip(*held, strict=True))
    crowded = np.union1d(crowded, key[code == MARK])
    order = np.lexsort((code, name, key))
    key, name, parity, code = key[order], name[order], parity[order], code[order]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (name[1:] != name[:-1]) | (code[1:] != code[:-1])))
    new = new[:len(key)] & (code != MARK)
    key, name, parity, code = key[new], name[new], parity[new], code[new]
    cuts = np.append(run_starts(key), len(key))
    return (key, name, parity, code), np.union1d(crowded, key[cuts[:-1][np.diff(cuts) > most]])


def _candidate_group(max_edits: int, buckets: int):
    """One bucket's entries -> candidates. A key with few close pairs gives them as
    (a, b). A key with many, or with many entries, gives its lines instead, as members
    (a, code, parity) of group g: links are then found among them with their texts at
    hand, and no pair of the group is written. Entries of a crowded key leave the bucket
    as they are read, so memory holds the others alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = tuple(np.zeros(0, k) for k in (U64, U64, np.uint32, np.uint16))
        held, size, limit, crowded = [none], 0, HELD, none[0]
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("blob"), strict=True):
                entries = unpack(blob.as_py(), "u8", "u8", "u4", "u2")
                if part >= buckets:
                    yield _member_rows(*entries)
                    continue
                held.append(entries)
                size += len(entries[0])
                if size >= limit:
                    entries, crowded = _distinct(held, crowded, CROWD)
                    out = np.isin(entries[0], crowded)
                    yield _member_rows(*(x[out] for x in entries))
                    held = [tuple(x[~out] for x in entries)]
                    size = len(held[0][0])
                    limit = max(HELD, 2 * size)
        entries, crowded = _distinct(held, crowded, CROWD)
        out = np.isin(entries[0], crowded)
        key, name, parity, code = (x[~out] for x in entries)
        cuts = np.append(run_starts(key), len(key))
        pairs, members = [], [np.flatnonzero(out)]
        place = np.flatnonzero(~out)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a < 2 or name[a] == name[b - 1]:
                continue
            own = np.flatnonzero((code[a:b] & 1) == INDEX) + a
            ask = np.flatnonzero((code[a:b] & 1) == PROBE) + a
            if len(own) * len(ask) <= BLOCK:
                p, q = _close(parity, name, own, ask, max_edits)
                if len(p) <= PAIRS_PER_LINE * (b - a):
                    pairs.append((np.minimum(name[p], name[q]), np.maximum(name[p], name[q])))
                    continue
            members.append(place[a:b])
        at = np.concatenate(members)
        yield _member_rows(*(x[at] for x in entries))
        x, y = (np.concatenate(c) for c in zip(*pairs, strict=True)) if pairs else (np.zeros(0, U64),) * 2
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.view(np.int64)), pa.array(y.view(np.int64)), pa.nulls(len(x), pa.int64()),
             pa.nulls(len(x), pa.int32()), pa.nulls(len(x), pa.int64())],
            names=["a", "b", "g", "code", "parity"])
    return run


MEMBERS = "g long, a long, role int, parity long, size int, rest string"


def _rest_batches(max_edits: int):
    def run(batches):
        for batch in batches:
            code = batch.column("code").to_pylist()
            line = batch.column("line").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("g"), batch.column("a"), pa.array([c & 1 for c in code], pa.int32()),
                 batch.column("parity"), pa.array([len(x.encode()) for x in line], pa.int32()),
                 pa.array([rest_of(x, c, max_edits) for x, c in zip(line, code, strict=True)], pa.string())],
                names=["g", "a", "role", "parity", "size", "rest"])
    return run


def even_cuts(mass: np.ndarray, parts: int) -> list[int]:
    """Cuts between ``parts`` segments, none empty, of about equal mass. There are at
    least as many positions as segments."""
    total, n = np.cumsum(mass), len(mass)
    cuts = []
    for i in range(1, parts):
        cut = int(np.searchsorted(total, total[-1] * i / parts * (1 - 1e-9))) + 1
        cuts.append(max(cut, (cuts[-1] if cuts else 0) + 1))
    return [min(c, n - parts + 1 + i) for i, c in enumerate(cuts)]


def differing_cuts(rests: list[str], parts: int) -> list[int]:
    """Cuts for rests of one length that split the positions where they differ evenly."""
    points = np.stack([np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in rests])
    points.sort(axis=0)
    mass = np.log2(1 + (points[1:] != points[:-1]).sum(axis=0))
    return even_cuts(mass if mass.any() else np.ones(len(mass)), parts)


def _cuts_group(parts: int):
    def run(group: pa.Table) -> pa.Table:
        cuts = differing_cuts(group.column("rest").to_pylist(), parts)
        return pa.table({"g": group.column("g").slice(0, 1), "cuts": pa.array([cuts], pa.list_(pa.int32()))})
    return run


def _refined_batches(max_edits: int):
    """Members of crowded keys -> members of the keys that their rests' segments make."""
    parts = max_edits + 1
    names = ("g", "a", "role", "parity", "size", "rest")
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string())

    def members(rows):
        columns = zip(*rows, strict=True) if rows else ((),) * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches):
        for batch in batches:
            out, chars = [], 0
            for row in zip(*(batch.column(c) for c in
                             ("g", "a", "role", "parity", "size", "rest", "r", "cuts")), strict=True):
                g, a, role, parity, size, rest, r, cuts = (x.as_py() for x in row)
                chars += len(rest)
                if chars > SPLIT_CHARS and out:
                    yield members(out)
                    out, chars = [], len(rest)
                edges = [0, *(cuts or even_cuts(np.ones(r), parts)), r]
                shorter = len(rest) - r
                for i in range(parts):
                    low = max(-i, shorter - (max_edits - i)) if role == PROBE else 0
                    high = min(i, shorter + (max_edits - i)) if role == PROBE else 0
                    for move in range(low, high + 1):
                        at, end = edges[i] + move, edges[i + 1] + move
                        if 0 <= at and end <= len(rest):
                            key = xxhash.xxh3_64_intdigest(f"{g}:{r}:{i}:{rest[at:end]}".encode())
                            out.append((key - (1 << 63), a, role, parity, size, rest[:at] + rest[end:]))
            yield members(out)
    return run


def settled_members(rows: DataFrame, max_edits: int, name: str = "lines-crowd") -> DataFrame:
    """(g, a, role, parity, rest): the members ``rows`` in groups of bounded size; any two that
    share a key and are within max_edits edits share a group, one as INDEX, one as PROBE."""
    parts, done, level = max_edits + 1, [], 0
    while True:
        level += 1
        n = rows.count()
        keys = written(
            rows.groupBy("g").agg(
                F.count("*").alias("n"), F.count_if(F.col("role") == INDEX).alias("own"),
                F.min("a").alias("lo"), F.max("a").alias("hi"), F.sum("size").alias("bytes"),
                F.min(F.when(F.col("role") == INDEX, F.char_length("rest"))).alias("r"))
            .where("own > 0 and own < n and lo < hi")
            .withColumn("blocks", F.greatest(F.ceil(F.col("n") / CROWD), F.ceil(F.col("bytes") / GROUP_BYTES)))
            .select("g", F.col("n").alias("load"), "own", "r", "blocks"), f"{name}-keys-{level}")
        # a rest of so few characters is compared as it is
        crowded = (F.col("blocks") > 1) & (F.col("load") > 64) & (F.col("r") >= 2 * parts)
        few = lookup(rows, keys.where(~crowded).select("g", "load", "blocks"), ["g"], "load", n)
        block = F.expr("pmod(xxhash64(a, g), blocks)")
        spread = (few.where("blocks > 1").withColumn("lo", block)
                  .withColumn("hi", F.explode(F.expr("sequence(0L, blocks - 1)")))
                  .withColumn("g", F.when(F.col("role") == INDEX, F.xxhash64("g", "lo", "hi"))
                              .otherwise(F.xxhash64("g", "hi", "lo"))))
        done += [x.select("g", "a", "role", "parity", "rest") for x in (few.where("blocks = 1"), spread)]
        if keys.where(crowded).isEmpty():
            break
        dense = written(lookup(rows, keys.where(crowded).select("g", "load", "own", "r"), ["g"], "load", n),
                        f"{name}-dense-{level}")
        cuts = (dense.where((F.col("role") == INDEX) & (F.char_length("rest") == F.col("r")))
                .where(F.expr(f"pmod(xxhash64(a, g), own) < least({SAMPLE}, greatest(1, {SPLIT_CHARS} div r))"))
                .select("g", "rest").groupBy("g").applyInArrow(_cuts_group(parts), "g long, cuts array<int>"))
        cuts = written(cuts.join(keys.select("g", "load"), "g"), f"{name}-cuts-{level}")
        rows = written(lookup(dense, cuts, ["g"], "load", n, "left")
                       .select("g", "a", "role", "parity", "size", "rest", "r", "cuts")
                       .mapInArrow(_refined_batches(max_edits), MEMBERS).distinct(), f"{name}-{level}")
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.distinct()


def _split(own: list, ask: list, max_edits: int):
    """Indexed and probing (place, rest) of one key, dealt once more by the segments of
    their rests: (own, ask) of every new key with both."""
    parts = max_edits + 1
    r = min(len(x) for _, x in own)
    edges = [0, *differing_cuts([x for _, x in own if len(x) == r][:64], parts), r]
    found: dict = {}
    for place, x in own:
        for i in range(parts):
            at, end = edges[i], edges[i + 1]
            found.setdefault((i, x[at:end]), ([], []))[0].append((place, x[:at] + x[end:]))
    for place, x in ask:
        shorter = len(x) - r
        for i in range(parts):
            for move in range(max(-i, shorter - (max_edits - i)), min(i, shorter + (max_edits - i)) + 1):
                at, end = edges[i] + move, edges[i + 1] + move
                if 0 <= at and end <= len(x) and (i, x[at:end]) in found:
                    found[i, x[at:end]][1].append((place, x[:at] + x[end:]))
    return [(o, a) for o, a in found.values() if a]


def _member_group(max_edits: int, few: int = 256, depth: int = 4):
    """The lines of one group, with texts -> links that connect what is connected among
    them: a pair whose lines are already joined is not looked at again. A group of more
    than ``few`` pairs is split by the segments of the rests first, after one line has
    been compared with all, which joins the copies of a line at once."""
    def run(group: pa.Table) -> pa.Table:
        name, role = group.column("a").to_pylist(), group.column("role").to_pylist()
        parity, text = group.column("parity").to_pylist(), group.column("line").to_pylist()
        rest = group.column("rest").to_pylist()
        root = {n: n for n in name}

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []

        def compare(own, ask):
            for i, _ in own:
                for j, _ in ask:
                    if (parity[i] ^ parity[j]).bit_count() <= 2 * max_edits:
                        p, q = top(name[i]), top(name[j])
                        if p != q and within(text[i], text[j], max_edits) is not None:
                            root[max(p, q)] = min(p, q)
                            out.append((min(name[i], name[j]), max(name[i], name[j])))

        places = [(i, rest[i]) for i in range(len(name))]
        todo = [([x for x in places if role[x[0]] == INDEX], [x for x in places if role[x[0]] == PROBE], 0)]
        while todo:
            own, ask, level = todo.pop()
            small = len(own) * len(ask) <= few or level == depth
            if small or sum(len(x) for _, x in own + ask) > SPLIT_CHARS or min((len(x) for _, x in own), default=0) < 2 * (max_edits + 1):
                compare(own, ask)
                continue
            compare(own[:1], ask)
            one = top(name[own[0][0]])
            if any(top(name[i]) != one for i, _ in own + ask):
                todo += [(o, a, level + 1) for o, a in _split(own, ask, max_edits)]
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()),
                         "b": pa.array([y for _, y in out], pa.int64())})
    return run


def within(a: str, b: str, max_edits: int) -> int | None:
    """Edit distance of two strings if at most ``max_edits``, else None.

    Bit k of level d says: the characters read so far reach diagonal k - max_edits with
    at most d edits. A level is one small integer; a step is a few shifts on each."""
    if abs(len(a) - len(b)) > max_edits:
        return None
    lead, most = 0, min(len(a), len(b))
    while lead < most and a[lead] == b[lead]:
        lead += 1
    tail = 0
    while tail < most - lead and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[lead:len(a) - tail], b[lead:len(b) - tail]
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for j, c in enumerate(b):
        where[c] = where.get(c, 0) | 1 << j
    band = (1 << (2 * max_edits + 1)) - 1
    level = [((1 << (d + 1)) - 1) << max_edits & band for d in range(max_edits + 1)]
    for i, c in enumerate(a):
        at = where.get(c, 0) << max_edits >> i & band  # diagonals where b continues with c
        new = []
        for d, old in enumerate(level):
            now = old & at
            if d:
                now |= level[d - 1] | level[d - 1] >> 1 | new[d - 1] << 1
            new.append(now & band)
        level = new
        if not level[-1]:
            return None
    goal = 1 << (len(b) - len(a) + max_edits)
    return next((d for d, reached in enumerate(level) if reached & goal), None)


def _verify_batches(max_edits: int):
    def run(batches):
        for batch in batches:
            ok = [within(s, t, max_edits) is not None for s, t in
                  zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _occurrence_batches(min_chars: int):
    def run(batches):
        for batch in batches:
            for part in X.chunks(batch, limit=2 << 20):
                part = part.filter(part.column("doc_id").is_valid())
                found = lines_of(part.column("text").to_pylist(), min_chars, short=True)
                row, number, lines = zip(*found, strict=True) if found else ((), (), ())
                a, b = identities(lines)
                row = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(row), part.column("copy").take(row), pa.array(number, pa.int64()),
                     pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                    names=["doc_id", "copy", "number", "a", "b"])
    return run


def _text_batches(min_chars: int, wanted):
    """Texts of the lines whose name is in the bitmap."""
    def run(batches):
        bits = np.frombuffer(wanted.value, np.uint8)
        for batch in batches:
            for part in X.chunks(batch, limit=2 << 20):
                lines = list({x for _, _, x in lines_of(part.column("text").to_pylist(), min_chars)})
                name, _ = identities(lines)
                slot = (name & U64((1 << BITMAP_BITS) - 1)).astype(np.int64)
                pick = np.flatnonzero(bits[slot >> 3] >> (slot & 7) & 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[pick].view(np.int64)), pa.array([lines[i] for i in pick], pa.string())],
                    names=["name", "line"])
    return run


def near_links(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(a, b): links between different lines (by name) within ``max_edits`` edits; every
    two lines that such links connect are connected by the links returned."""
    spark = docs.sparkSession
    if min_chars <= max_edits:
        raise ValueError("min_chars has to exceed max_edits")
    if not 0 <= max_edits <= 7:
        raise ValueError("an entry's code holds at most 7 edits")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # about 15 entries for each line of some 200 bytes
    buckets = max(256, size // 200 * 15 // ENTRIES_PER_BUCKET)
    known = docs.where("doc_id is not null").select("text")
    found = written(known.mapInArrow(_entry_batches(max_edits, min_chars, buckets), SCHEMA)
                    .groupBy("part").applyInArrow(_candidate_group(max_edits, buckets), CANDIDATES)
                    .distinct(), "lines-candidates")
    pairs, members = found.where("b is not null").select("a", "b"), found.where("b is null")
    names = found.select(F.col("a").alias("name")).union(pairs.select("b"))
    # 2^23 bits, whatever the number of pairs
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for w in row_bitmap(names, F.expr(f"name & {(1 << BITMAP_BITS) - 1}L")).collect():
        bitmap[w["word"]] = w["bits"]
    wanted = spark.sparkContext.broadcast(bitmap.tobytes())
    texts = written(known.mapInArrow(_text_batches(min_chars, wanted), "name long, line string")
                    .groupBy("name").agg(F.min("line").alias("line")), "lines-texts")
    both = (pairs.join(texts.select(F.col("name").alias("a"), F.col("line").alias("ta")), "a")
            .join(texts.select(F.col("name").alias("b"), F.col("line").alias("tb")), "b"))
    alone = both.select("a", "b", "ta", "tb").mapInArrow(_verify_batches(max_edits), "a long, b long")
    named = texts.select(F.col("name").alias("a"), "line")
    rests = written(members.select("a", "g", "code", "parity").join(named, "a")
                    .mapInArrow(_rest_batches(max_edits), MEMBERS), "lines-crowd")
    crowd = (settled_members(rests, max_edits).join(named, "a")
             .select("g", "a", "role", "parity", "rest", "line")
             .groupBy("g").applyInArrow(_member_group(max_edits), "a long, b long"))
    return alone.union(crowd)


def line_classes(docs: DataFrame, max_edits: int = MAX_EDITS,
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """For every line (doc_id, copy, number) of a class with more than one line: class_id
    and ``first`` (the line that stays). ``docs`` has doc_id, copy and text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    each = written(docs.select("doc_id", "copy", "text").mapInArrow(
        _occurrence_batches(min_chars), f"doc_id {kind}, copy long, number long, a long, b long"),
        "lines-each")
    link = written(near_links(docs, max_edits, min_chars), "lines-links")
    comp = written(components(link, "lines-cc"), "lines-roots")
    place = F.struct("doc_id", "copy", "number")
    equal = each.groupBy("a", "b").agg(F.min(place).alias("least"), F.count("*").alias("n"))
    known = (equal.join(comp.withColumnRenamed("node", "a"), "a", "left")
             .where("n > 1 or root is not null")
             .withColumn("class_id", F.coalesce("root", F.xxhash64("a", "b"))))
    first = known.groupBy("class_id").agg(F.min("least").alias("least"))
    known = written(known.select("a", "b", "class_id").join(first, "class_id"), "lines-classes")
    return each.join(known, ["a", "b"]).select(
        "doc_id", "copy", "number", "class_id", (place == F.col("least")).alias("first"))


def _cut_batches(digest: bool):
    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("n_lines", "n_removed", "kept")}
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                lines = [] if text is None else text.split("\n")
                drop = set(gone or ())
                kept = "\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text
                out["n_lines"].append(len(lines))
                out["n_removed"].append(len(drop))
                out["kept"].append(hashlib.sha256((kept or "").encode()).hexdigest() if digest else kept)
            keep = [c for c in batch.schema.names if c not in ("text", "gone")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(out["n_lines"], pa.int64()),
                 pa.array(out["n_removed"], pa.int64()), pa.array(out["kept"], pa.string())],
                names=[*keep, "n_lines", "n_removed", "kept"])
    return run


def _cut(docs: DataFrame, max_edits: int, min_chars: int, digest: bool) -> DataFrame:
    """Every row of ``docs`` (doc_id, text and any further columns, which are kept) with
    line_classes, n_lines, n_removed and kept instead of the text."""
    arrow_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != "text"]
    docs = with_copy(docs)
    classes = line_classes(docs, max_edits, min_chars)
    per_doc = written(classes.groupBy("doc_id", "copy").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "class_id"))),
                                 lambda x: F.concat_ws(":", x["number"], x["class_id"])), ",").alias("line_classes"),
        F.collect_list(F.when(~F.col("first"), F.col("number"))).alias("gone")), "lines-docs")
    index = F.expr(f"xxhash64(doc_id) & {(1 << BITMAP_BITS) - 1}L")
    bitmap = row_bitmap(per_doc, index)
    may = bitmap_filter(docs, bitmap, index).join(per_doc, ["doc_id", "copy"], "left")
    clear = bitmap_filter(docs, bitmap, index, keep=False).select(
        "*", F.lit(None).cast("string").alias("line_classes"),
        F.lit(None).cast("array<long>").alias("gone"))
    rows = may.unionByName(clear).select(
        *keep, F.coalesce("line_classes", F.lit("")).alias("line_classes"), "text", "gone")
    schema = T.StructType([f for f in rows.schema if f.name not in ("text", "gone")]
                          + [T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType()),
                             T.StructField("kept", T.StringType())])
    return rows.mapInArrow(_cut_batches(digest), schema)


def dedup_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS,
                digest: bool = False) -> DataFrame:
    """doc_id, line_classes (``line number:class`` of every line in a class,
    comma-joined), n_lines, n_removed, kept (text left, or its SHA-256) of every row."""
    return _cut(docs.select("doc_id", "text"), max_edits, min_chars, digest)


def without_repeats(docs: DataFrame, max_edits: int = MAX_EDITS,
                    min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, with repeated lines taken out of their texts."""
    got = _cut(boxed(docs), max_edits, min_chars, digest=False)
    return unboxed(got.select("doc_id", F.col("kept").alias("text"), "rest"), docs.columns)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return dedup_lines(docs, digest=True).withColumnRenamed("kept", "kept_sha256")
