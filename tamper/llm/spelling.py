"""Operator 12: spelling variants by K-d trees over letter-count vectors.

Words of all documents are counted. Two words are near if one inserted, deleted or replaced
letter separates them. One replacement moves a word's vector of letter counts by exactly 2
in L1, one insertion by exactly 1. So words of length m search the words of length m
within distance 2 and those of length m + 1 within distance 1; every pair of lengths is
searched once, by box-pruned descent, and the letter order of what is found is verified.

A tree has two storeys. The upper one splits a length into cells of some ``CELL`` words;
it is fitted on a bounded sample (``SAMPLE`` words of each of the ``TREES`` most frequent
lengths; every word is indexed). A word is data in its own cell and travels as a query to
every cell whose region its radius touches; with equal lengths only to cells from its own
on. The lower storey is built inside a cell, with tight boxes, down to ``LEAF`` words.
Queries of a length are dealt to as many groups a cell as the length has millions of
words, so no group grows with the table; data of a cell go in blocks of ``CELL``.

A word's form is its near word of largest count, if that is at least twice its own. Counts
double along forms, so roots are reached in log2(count) steps at most; each step hands a
root down to the words whose form it has just reached (a word has a bounded number of near
words, so no key is hot).

Defined cases: null and empty texts have no words; a null id gives an empty id in the
checksum; rows that share an id are separate documents; runs and texts of any length are
taken whole; equal words are one word; an empty table has no words; extra columns are
ignored. Anagrams are never near (distance 0), but a pair of anagram classes at distance
2 is verified word by word.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamper.llm import _text as X
from tamper.llm._spark import arrow_batches, table, written

MIN_LETTERS, MIN_COUNT = 5, 3
VARIANT = 97
CELL, LEAF = 1 << 15, 32
SAMPLE, TREES = 1 << 14, 64
LETTERS = 26 + 64  # a-z and U+00C0 to U+00FF


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


CRC = _crc_table()
CONTINUES = (np.arange(256) & 0xC0) == 0x80
LETTER = np.zeros(256, bool)
LETTER[0x61:0x7B] = LETTER[0xC3] = True
GAP = np.array([True, False])


# --- words -----------------------------------------------------------------

def crc_spans(data, starts, ends, before, long: int = 48) -> np.ndarray:
    """CRC-32 of each byte span, going on from the checksum ``before``."""
    lengths = ends - starts
    state = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    live, j = np.flatnonzero(lengths <= long), 0
    while len(live):
        live = live[lengths[live] > j]
        s = state[live]
        state[live] = CRC[(s ^ data[starts[live] + j]) & np.uint32(0xFF)] ^ (s >> np.uint32(8))
        j += 1
    state ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > long):
        state[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes(), int(before[i]))
    return state


def chunk_words(ids: list, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The different words of a chunk of documents, and how often each occurs."""
    data, offsets = X.text_bytes(texts)
    data = X.LOWER[data]
    inside = LETTER[data]
    inside[1:] |= data[:-1] == 0xC3  # the second byte of U+00C0 to U+00FF
    starts, ends, first = X.words(inside.view(np.uint8), offsets, GAP)
    if not len(starts):
        return pa.array([], pa.string()), pa.array([], pa.int64())
    prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    crc = crc_spans(data, starts, ends, prefix[X.owners(first)])
    extra = np.concatenate(([0], np.cumsum(CONTINUES[data])))
    letters = (ends - starts) - (extra[ends] - extra[starts])
    changed = crc % VARIANT == 0
    at = np.concatenate(([0], np.cumsum(ends - starts)))
    whole = pa.StringArray.from_buffers(len(starts), pa.py_buffer(at.astype(np.int32)),
                                        pa.py_buffer(data[inside]))
    cut = []
    for i in np.flatnonzero(changed & (letters > MIN_LETTERS)):
        word = data[starts[i]:ends[i]].tobytes().decode()
        k = int(crc[i]) % len(word)
        cut.append(word[:k] + word[k + 1:])
    kept = whole.filter(pa.array(~changed & (letters >= MIN_LETTERS)))
    counts = pa.chunked_array([kept, pa.array(cut, pa.string())]).combine_chunks().value_counts()
    return counts.field("values"), counts.field("counts")


def _word_batches(batches):
    for batch in batches:
        for part in X.chunks(batch):
            words, n = chunk_words(part.column("doc_id").to_pylist(), part.column("text"))
            for lo in range(0, len(words), 1 << 16):
                yield pa.RecordBatch.from_arrays([words[lo:lo + (1 << 16)], n[lo:lo + (1 << 16)].cast(pa.int64())],
                                                 names=["word", "n"])


def word_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n, letters) of the words with at least ``min_count`` occurrences."""
    return (docs.select("doc_id", "text").mapInArrow(_word_batches, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
            .withColumn("letters", F.length("word")))


# --- vectors and trees -----------------------------------------------------

def codes(words: list[str], letters: int) -> np.ndarray:
    """Words of one length as rows of letter numbers."""
    c = np.array(words, f"<U{letters}").view(np.uint32).reshape(len(words), letters)
    return np.where(c < 128, c - 97, c - 0xC0 + 26).astype(np.uint8)


def vectors(c: np.ndarray) -> np.ndarray:
    """Letter counts of rows of letter numbers."""
    out = np.zeros((len(c), LETTERS), np.int8 if c.shape[1] < 128 else np.int32)
    rows = np.arange(len(c))
    for j in range(c.shape[1]):
        out[rows, c[:, j]] += 1
    return out


class KdTree:
    """Boxes and children of a K-d tree over count vectors. ``tight`` boxes enclose the
    points of a node; else they are the node's region, which holds unseen points too."""

    def __init__(self, points: np.ndarray, leaf: int, tight: bool):
        top = np.iinfo(points.dtype).max
        self.lo, self.hi, self.child, self.members = [], [], [], []
        todo = [(np.arange(len(points)), np.zeros(LETTERS, points.dtype), np.full(LETTERS, top, points.dtype), None)]
        while todo:
            rows, lo, hi, parent = todo.pop()
            me, p = len(self.lo), points[rows]
            if parent is not None:
                self.child[parent[0]][parent[1]] = me
            if tight and len(rows):
                lo, hi = p.min(0), p.max(0)
            self.lo.append(lo)
            self.hi.append(hi)
            self.child.append([-1, -1])
            self.members.append(rows)
            if len(rows) <= leaf:
                continue
            best = (len(rows), 0, 0)
            for t in range(int(p.max())):
                under = (p <= t).sum(0)
                miss = np.abs(2 * under - len(rows))
                d = int(miss.argmin())
                best = min(best, (int(miss[d]), d, t))
            miss, d, t = best
            if miss >= len(rows):
                continue  # all vectors are equal
            left = p[:, d] <= t
            cut_hi, cut_lo = hi.copy(), lo.copy()
            cut_hi[d], cut_lo[d] = t, t + 1
            todo += [(rows[~left], cut_lo, hi, (me, 1)), (rows[left], lo, cut_hi, (me, 0))]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)
        self.child = np.array(self.child)
        self.leaf = self.child[:, 0] < 0

    def leaves(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf node) wherever a leaf's box is within ``radius`` of a query."""
        used = np.flatnonzero((self.lo != self.lo[0]).any(0) | (self.hi != self.hi[0]).any(0)
                              | (self.lo[0] > 0) | (self.hi[0] < queries.max(0, initial=0)))
        lo, hi, queries = self.lo[:, used], self.hi[:, used], queries[:, used]
        q, node, found = np.arange(len(queries)), np.zeros(len(queries), np.int64), []
        while len(q):
            near = np.zeros(len(q), bool)
            for a in range(0, len(q), 1 << 15):
                x = queries[q[a:a + (1 << 15)]]
                k = node[a:a + (1 << 15)]
                off = np.maximum(np.maximum(lo[k] - x, x - hi[k]), 0)
                near[a:a + (1 << 15)] = off.sum(1, dtype=np.int32) <= radius
            q, node = q[near], node[near]
            end = self.leaf[node]
            found.append((q[end], node[end]))
            q, node = np.repeat(q[~end], 2), self.child[node[~end]].reshape(-1)
        if not found:
            return q, node
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def within(self, points: np.ndarray, queries: np.ndarray, distance: int):
        """Blocks of (query, point) with exactly this L1 distance."""
        q, node = self.leaves(queries, distance)
        sizes = np.array([len(m) for m in self.members])[node]
        cuts = np.searchsorted(np.cumsum(sizes), np.arange(1 << 15, sizes.sum() + (1 << 15), 1 << 15))
        for a, b in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(q)])), strict=True):
            if a == b:
                continue
            i = np.repeat(q[a:b], sizes[a:b])
            j = np.concatenate([self.members[k] for k in node[a:b]])
            ok = np.abs(queries[i] - points[j]).sum(1, dtype=np.int32) == distance
            yield i[ok], j[ok]


def one_replaced(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x != y).sum(1) == 1


def one_inserted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether row y is row x with one more letter."""
    ones = np.ones((len(x), 1), bool)
    head = np.hstack((ones, np.logical_and.accumulate(x == y[:, :-1], axis=1)))
    tail = np.hstack((np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1)[:, ::-1], ones))
    return (head & tail).any(1)


# --- cells -----------------------------------------------------------------

DATA, SAME, SHORTER = 0, 1, 2
PACKED = "letters int, cell int, part int, kind int, words binary, ns binary"


def _cell_batches(trees: dict[int, KdTree], parts: dict[int, int]):
    """Words (word, n, letters) -> packed rows of the cells where they are data or queries."""
    def send(rows, letters, cell, part, kind, words, n, pick):
        rows.append((letters, int(cell), int(part), kind, " ".join(words[pick]).encode(),
                     n[pick].astype("<i8").tobytes()))

    def deal(words, n, letters):
        rows = []
        for m in np.unique(letters):
            w, k = words[letters == m], n[letters == m]
            v = vectors(codes(w.tolist(), int(m)))
            deal_of = np.array([zlib.crc32(x.encode()) for x in w.tolist()], np.int64)
            own = None
            for size, kind, radius in ((int(m), SAME, 2), (int(m) + 1, SHORTER, 1)):
                tree, count = trees.get(size), parts.get(size, 0)
                if not count:
                    continue
                q, cell = (tree.leaves(v, radius) if tree else
                           (np.arange(len(w)), np.zeros(len(w), np.int64)))
                if kind == SAME:
                    own = np.zeros(len(w), np.int64)
                    if tree:
                        i, c = tree.leaves(v, 0)  # regions part the space
                        own[i] = c
                    later = cell > own[q]
                    q, cell = q[later], cell[later]
                    for c in np.unique(own):
                        for p in range(count):
                            send(rows, size, c, p, DATA, w, k, np.flatnonzero(own == c))
                key = cell * count + deal_of[q] % count
                order = np.argsort(key, kind="stable")
                cuts = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0))) if len(key) else []
                for a, b in zip(cuts, np.append(cuts[1:], len(key)) if len(key) else [], strict=True):
                    c, p = divmod(int(key[order[a]]), count)
                    send(rows, size, c, p, kind, w, k, q[order[a:b]])
        return rows

    def flush(held):
        t = pa.Table.from_batches(held)
        rows = deal(np.array(t.column("word").to_pylist(), object), t.column("n").to_numpy(),
                    t.column("letters").to_numpy())
        kinds = [pa.int32()] * 4 + [pa.binary()] * 2
        names = ["letters", "cell", "part", "kind", "words", "ns"]
        for a in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in
                                              zip(zip(*rows[a:a + 256], strict=True), kinds, strict=True)], names=names)

    def run(batches):
        held = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 1 << 16:
                yield from flush(held)
                held = []
        if sum(b.num_rows for b in held):
            yield from flush(held)
    return run


def _cell_group(parts: dict[int, int]):
    """One cell's words and queries -> (word, near, n of near) of every near pair, both ways."""
    def unpack(group, kind):
        pick = group.filter(pc.equal(group.column("kind"), kind))
        words = b" ".join(pick.column("words").to_pylist()).decode().split()
        n = np.frombuffer(b"".join(pick.column("ns").to_pylist()), "<i8")
        return words, n

    def pairs(words, c, v, tree, queries, distance, verify, letters):
        """(query, word) that are near, queries in blocks."""
        for a in range(0, len(queries), 1 << 13):
            qc = codes(queries[a:a + (1 << 13)], letters)
            for i, j in tree.within(v, vectors(qc).astype(v.dtype), distance):
                for b in range(0, len(i), max(1, (1 << 22) // letters)):
                    s = slice(b, b + max(1, (1 << 22) // letters))
                    ok = verify(qc[i[s]], c[j[s]])
                    yield i[s][ok] + a, j[s][ok]

    def run(group: pa.Table) -> pa.Table:
        letters, part = group.column("letters")[0].as_py(), group.column("part")[0].as_py()
        data, n = unpack(group, DATA)
        out = []
        same, n_same = unpack(group, SAME)
        shorter, n_shorter = unpack(group, SHORTER)
        count = parts[letters]
        mine = [i for i, w in enumerate(data) if count == 1 or zlib.crc32(w.encode()) % count == part]
        here, n_here = [data[i] for i in mine], n[mine]
        for lo in range(0, len(data), CELL):
            words, n_words = data[lo:lo + CELL], n[lo:lo + CELL]
            c = codes(words, letters)
            v = vectors(c)
            tree = KdTree(v, LEAF, tight=True)
            wa = np.array(words, object)
            for queries, n_q, distance, verify, size in ((here, n_here, 2, one_replaced, letters),
                                                         (same, n_same, 2, one_replaced, letters),
                                                         (shorter, n_shorter, 1, one_inserted, letters - 1)):
                qa = np.array(queries, object)
                for i, j in pairs(words, c, v, tree, queries, distance, verify, size):
                    x, y = qa[i], wa[j]
                    if queries is here:
                        once = x < y
                        i, j, x, y = i[once], j[once], x[once], y[once]
                    out.append((np.concatenate((x, y)), np.concatenate((y, x)),
                                np.concatenate((n_words[j], n_q[i]))))
        columns = [np.concatenate(k) for k in zip(*out, strict=True)] if out else [[], [], []]
        return pa.table({"word": pa.array(columns[0], pa.string()), "near": pa.array(columns[1], pa.string()),
                         "near_n": pa.array(columns[2], pa.int64())})
    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every near pair of ``words`` (word, n, letters), both ways."""
    sizes = {r["letters"]: r["count"] for r in words.groupBy("letters").count().collect()}
    big = sorted((m for m in sizes if sizes[m] > CELL), key=lambda m: -sizes[m])[:TREES]
    rank = F.row_number().over(Window.partitionBy("letters").orderBy(F.xxhash64("word"), "word"))
    sample = {}
    for r in (words.where(F.col("letters").isin(big)).withColumn("r", rank).where(f"r <= {SAMPLE}")
              .select("word", "letters").collect() if big else []):
        sample.setdefault(r["letters"], []).append(r["word"])
    trees = {}
    for m, picked in sample.items():
        cells = min(-(-sizes[m] // CELL), SAMPLE // 16)
        trees[m] = KdTree(vectors(codes(picked, m)), max(8, -(-len(picked) // cells)), tight=False)
        trees[m].members = None
    parts = {m: max(1, n // (32 * CELL)) for m, n in sizes.items()}
    packed = words.mapInArrow(_cell_batches(trees, parts), PACKED)
    return packed.groupBy("letters", "cell", "part").applyInArrow(
        _cell_group(parts), "word string, near string, near_n long")


def spelling_forms(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of ``docs`` (doc_id, text)."""
    arrow_batches(docs.sparkSession)
    words = written(word_counts(docs), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = F.col("best.n") <= -2 * F.col("n")
    each = written(words.select("word", "n").join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("best.word")).alias("form"),
        F.when(formed, -F.col("best.n")).alias("form_n")), "spelling-forms")
    reached = each.where("form is null").withColumn("root", F.col("word"))
    done, step = reached, 0
    frontier = reached.select(F.col("word").alias("form"), "root")
    while True:
        step += 1
        reached = written(each.where("form is not null").join(frontier, "form").select(*each.columns, "root"),
                          f"spelling-step-{step}")
        if reached.isEmpty():
            return done
        done = done.unionByName(reached)
        frontier = reached.select(F.col("word").alias("form"), "root")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(table(spark, sf_dir, "documents", "doc_id", "text"))
