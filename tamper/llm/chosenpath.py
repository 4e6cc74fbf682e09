"""Operator 13: near-duplicates by a chosen-path set similarity join.

A document is its set of distinct word shingles; two link when the Jaccard similarity of
the full sets is at least ``percent`` / 100. Equal sets are one class. A class is embedded
by ``WIDTH`` min-hashes. From the root of each of ``TREES`` independent trees it goes to a
child for every min-hash token that a hash of (path, token) selects, with probability
``BRANCH`` / (threshold * WIDTH): a pair at the threshold shares BRANCH = 1.5 selected
tokens a level on average, so it stays together to any depth in a tree with probability
0.58 or more (the fixed point of s = 1 - exp(-1.5 s)), and misses all 14 trees with
probability 5e-6 or less; more similar pairs with less. A pair below similarity 0.53 has
under one common child a level and dies out.

Nodes of up to ``LEAF`` classes are compared exhaustively on their embeddings (one byte a
min-hash). In a larger node whose members are of one label but for up to ``ASK``, these
few are compared with every member, in blocks. Members of other large nodes are first
compared with ``PIVOTS`` of them and then branch again. What is still large is compared
exhaustively in pairs of blocks after ``DEPTH`` levels, or as soon as that takes at most
``LEAF`` comparisons for each class of the table. Comparisons yield *loose* links (half of the min-hashes agree; a pair at 0.8
fails this with probability under 1e-8), reduced to a forest in each node. Classes that
are loosely linked already have one label, and a node whose members share one is done:
two trees of one level give first labels, the other trees only look for links between
different labels. So a large group of copies is found once, and not in every node of every
tree. Components of loose links are small groups. Only there do the full sets travel, one for
each class, and links are confirmed on them exactly. A group of over ``BLOCK`` sets or
``BLOCK_BYTES`` is dealt to blocks, each with the same pivot; what did not join the
pivot's component then meets every block. So copies in any number cost a star, not
all pairs, no task holds more than two blocks, and no link between components is left out.

Skew: a text shared by many rows is one class; a token shared by many classes is a large
node, joined by ``lookup`` and split by branching.

Defined cases: null, empty and wordless texts have the empty set and link with nothing,
each is its own component; fewer words than a shingle are one shingle; repeated rows and
repeated or null ids are separate documents; ``component_id`` is the smallest non-null id
of the component (null if it has none) and ``kept`` tells whether the row has that id
(null equals null); an empty table gives an empty result; extra columns are ignored.
Shingles are known by 64 bits, sets by their size and 128 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamper.llm import _text as X
from tamper.llm._forest import forest, forest_roots
from tamper.llm._skew import lookup
from tamper.llm._spark import arrow_batches, row_bitmap, table, written

U64 = np.uint64
SHINGLE, PERCENT = 4, 80
WIDTH, TREES, BRANCH = 64, 14, 1.5
FIRST_TREES, PIVOTS = 2, 8
ASK, ASK_BLOCK = 1024, 4096
LEAF, DEPTH = 1024, 10
LOOSE = WIDTH // 2
BLOCK, BLOCK_BYTES = 1024, 32 << 20
MAX_BITMAP = 27
SET = ["n", "x", "s"]

ODD = X.mix(np.arange(1, WIDTH + 1, dtype=U64)) | U64(1)
PLACE = np.arange(WIDTH, dtype=U64) << U64(32)
SALT = U64(0x5851F42D4C957F2D)


# --- sets ------------------------------------------------------------------

def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after the other, and the n + 1
    offsets."""
    data, offsets = X.text_bytes(texts)
    data = X.LOWER[data]
    starts, ends, first = X.words(data, offsets, X.WHITE)
    h, n = X.hash_spans(data, starts, ends), np.diff(first)
    per = np.where(n == 0, 0, np.maximum(n - shingle + 1, 1))
    row = np.repeat(np.arange(len(n)), per)
    head = np.arange(per.sum()) + np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(per)[:-1])), per)
    last = first[1:][row]
    value = np.minimum(n[row], shingle).astype(U64)
    for k in range(shingle):
        at = head + k
        value = value * U64(0x9E3779B97F4A7C15) + np.where(at < last, h[np.minimum(at, len(h) - 1)], U64(0))
    value = X.mix(value)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(len(n) + 1))


def per_set(op: np.ufunc, values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``op`` reduced over each set; zero for an empty one."""
    out = np.zeros(len(first) - 1, values.dtype)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = op.reduceat(values, first[:-1][full])
    return out


def identity(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each set and 128 bits that identify it."""
    return (np.diff(first), per_set(np.bitwise_xor, values, first).view(np.int64),
            per_set(np.add, X.mix(values ^ SALT), first).view(np.int64))


def embeddings(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``WIDTH`` min-hashes (32 bits) of each set."""
    out = np.empty((len(first) - 1, WIDTH), np.uint32)
    for k in range(WIDTH):
        out[:, k] = per_set(np.minimum, values * ODD[k], first) >> U64(32)
    return out


def fixed(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    flat = np.ascontiguousarray(rows)
    at = np.arange(len(flat) + 1, dtype=np.int32) * (flat.shape[1] * flat.itemsize)
    return pa.BinaryArray.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(at), pa.py_buffer(flat)])


def matrix(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, WIDTH)


def _set_batches(shingle: int):
    def run(batches):
        for batch in batches:
            for part in X.chunks(batch, limit=2 << 20):
                values, first = shingle_sets(part.column("text"), shingle)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, identity(values, first)),
                     fixed(embeddings(values, first))], names=["doc_id", *SET, "sig"])
    return run


def _blob_batches(shingle: int, bits: int, wanted):
    """The full sets whose identity may be wanted."""
    def run(batches):
        bitmap = np.frombuffer(wanted.value, np.uint8)
        for batch in batches:
            for part in X.chunks(batch, limit=2 << 20):
                values, first = shingle_sets(part.column("text"), shingle)
                n, x, s = identity(values, first)
                at = (x.view(U64) >> U64(64 - bits)).astype(np.int64)
                ok = np.flatnonzero((n > 0) & (bitmap[at >> 3] >> (at & 7) & 1).astype(bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(n[ok]), pa.array(x[ok]), pa.array(s[ok]),
                     pa.array([values[first[i]:first[i + 1]].tobytes() for i in ok], pa.binary())],
                    names=[*SET, "blob"])
    return run


# --- trees -----------------------------------------------------------------

def _branches(node: np.ndarray, sig: np.ndarray, percent: int):
    """(row, child) of the tokens selected at each row's node."""
    limit = U64(int(min(1.0, BRANCH * 100 / (percent * WIDTH)) * (2 ** 64 - 1)))
    child = X.mix(X.mix(sig.astype(U64) + PLACE) ^ X.mix(node)[:, None])
    row, col = np.nonzero(X.mix(child ^ SALT) < limit)
    return row, child[row, col]


NODES = "node long, cls long, lab long"


def _root_batches(percent: int, trees: range):
    def run(batches):
        for batch in batches:
            sig, cls = matrix(batch.column("sig"), np.uint32), batch.column("cls").to_numpy()
            lab = batch.column("lab").to_numpy()
            for t in trees:
                row, child = _branches(np.full(len(sig), t + 1, U64), sig, percent)
                yield _node_batch(child, cls[row], lab[row])
    return run


def _branch_batches(percent: int):
    def run(batches):
        for batch in batches:
            sig, cls = matrix(batch.column("sig"), np.uint32), batch.column("cls").to_numpy()
            row, child = _branches(batch.column("node").to_numpy().view(U64), sig, percent)
            yield _node_batch(child, cls[row], batch.column("lab").to_numpy()[row])
    return run


def _node_batch(node, cls, lab):
    return pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(cls), pa.array(lab)],
                                      names=["node", "cls", "lab"])


def _pivot_batches(batches):
    """Members of large nodes beside their node's pivots -> links with pivots of other
    labels, and the member's new label: that of the first pivot it resembles."""
    for batch in batches:
        n = batch.num_rows
        cls, lab = batch.column("cls").to_numpy(), batch.column("lab").to_numpy()
        flat = batch.column("pivots").flatten()
        sig = matrix(batch.column("sig"), np.uint32)
        row = np.repeat(np.arange(n), np.diff(batch.column("pivots").offsets.to_numpy()))
        p_cls, p_lab = flat.field("cls").to_numpy(), flat.field("lab").to_numpy()
        p_sig = matrix(flat.field("sig"), np.uint32)
        near = np.zeros(len(row), bool)
        for lo in range(0, len(row), 1 << 14):
            s = slice(lo, lo + (1 << 14))
            near[s] = (sig[row[s]] == p_sig[s]).sum(1) >= LOOSE
        hit = np.flatnonzero(near)
        first = hit[np.unique(row[hit], return_index=True)[1]]
        new = lab.copy()
        new[row[first]] = p_lab[first]
        link = hit[(lab[row[hit]] != p_lab[hit])]
        # one link for each pair of labels is enough
        link = link[np.unique(np.stack((lab[row[link]], p_lab[link])), axis=1, return_index=True)[1]]
        to = np.full(n, -1, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([batch.column("node"), pa.array(np.zeros(len(link), np.int64))]),
             pa.array(np.concatenate((cls, cls[row[link]]))), pa.array(np.concatenate((new, lab[row[link]]))),
             pa.array(np.concatenate((to, p_cls[link])))], names=["node", "cls", "lab", "pivot"])


def _leaf_edges(g: np.ndarray, cls: np.ndarray, lab: np.ndarray, sig: np.ndarray):
    """Loose links between different labels in the runs of equal ``g``, as a forest."""
    a, b = [], []
    for k in range(1, len(g)):
        i = np.flatnonzero(g[k:] == g[:-k])
        if not len(i):
            break
        i = i[lab[i] != lab[i + k]]
        for lo in range(0, len(i), 1 << 16):
            j = i[lo:lo + (1 << 16)]
            j = j[(sig[j] == sig[j + k]).sum(1) >= LOOSE]
            a.append(j)
            b.append(j + k)
    if not a:
        return cls[:0], cls[:0]
    root = forest(np.concatenate(a), np.concatenate(b), len(g))
    pick = np.flatnonzero(root != np.arange(len(g)))
    return cls[pick], cls[root[pick]]


def _leaf_batches(batches):
    """Rows (g, cls, lab, sketch) sorted by g -> loose links; a run may go on in the next batch."""
    held = None
    for batch in batches:
        rows = [batch.column("g").to_numpy(), batch.column("cls").to_numpy(), batch.column("lab").to_numpy(),
                matrix(batch.column("sketch"), np.uint8)]
        if held is not None:
            rows = [np.concatenate(c) for c in zip(held, rows, strict=True)]
        if not len(rows[0]):
            continue
        cut = int(np.searchsorted(rows[0], rows[0][-1]))
        held = [c[cut:] for c in rows]
        if cut:
            yield _edge_batch(*_leaf_edges(*(c[:cut] for c in rows)))
    if held is not None:
        yield _edge_batch(*_leaf_edges(*held))


def _edge_batch(a, b):
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _mixed(rows: DataFrame, n: int, name: str) -> DataFrame:
    """The rows (node, cls, lab) of nodes with more than one label, with the node's size m,
    its most frequent label ``main`` and that label's members k."""
    each = rows.groupBy("node", "lab").agg(F.count("*").alias("k"))
    sizes = (each.groupBy("node").agg(F.sum("k").alias("m"), F.count("*").alias("labels"),
                                      F.max_by("lab", F.struct("k", "lab")).alias("main"), F.max("k").alias("k"))
             .where("labels > 1").drop("labels").withColumn("load", F.col("m")))
    return written(lookup(rows, sizes, ["node"], "load", n), name)


def _pivoted(big: DataFrame, classes: DataFrame, name: str) -> DataFrame:
    """Rows of large nodes with their embedding -> (node, cls, lab, pivot): relabelled rows
    (pivot -1) and links with pivots (node 0)."""
    members = written(big.join(classes.select("cls", "sig"), "cls"), f"{name}-members")
    pick = [F.min_by(F.struct("cls", "lab", "sig"), F.xxhash64("cls", F.lit(k))) for k in range(PIVOTS)]
    pivots = members.groupBy("node").agg(F.count("*").alias("load"), F.array(*pick).alias("pivots"))
    beside = lookup(members, pivots, ["node"], "load", members.count())
    return written(beside.mapInArrow(_pivot_batches, f"{NODES}, pivot long"), f"{name}-pivots")


def _settled(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(leaves, rest)`` of mixed nodes. Small ones are one leaf. Where all but ``ASK``
    members have one label, only those few have to meet the others: they go to every block
    of the node, the others to one, which settles the node. ``rest``: the other nodes."""
    small, few = F.col("m") <= LEAF, F.col("k") >= F.col("m") - ASK
    blocks = F.when(small, F.lit(1)).otherwise(F.ceil(F.col("m") / ASK_BLOCK))
    block = F.explode(F.when(F.col("lab") != F.col("main"), F.sequence(F.lit(0).cast("long"), blocks - 1))
                      .otherwise(F.array(F.pmod(F.xxhash64("cls"), blocks))))
    leaves = rows.where(small | few).select("node", "cls", "lab", block.alias("block")).select(
        F.xxhash64("node", "block").alias("g"), "cls", "lab")
    return leaves, rows.where(~(small | few)).select("node", "cls", "lab", "m")


def _pairs(rest: DataFrame) -> DataFrame:
    """Every pair of blocks of each node as a leaf: the exact way."""
    blocks = F.ceil(F.col("m") / LEAF)
    mine = F.pmod(F.xxhash64("cls", "node"), blocks)
    pair = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    return rest.select("node", "cls", "lab", mine.alias("i"), pair.alias("j")).select(
        F.xxhash64("node", F.least("i", "j"), F.greatest("i", "j")).alias("g"), "cls", "lab")


def _tree_links(classes: DataFrame, percent: int, trees: range, depth: int, name: str) -> DataFrame:
    """(a, b): loose links between different labels of classes (cls, lab, sig) that some
    of the trees brings together; with ``depth`` 1 large nodes are only compared with
    their pivots."""
    cur = written(classes.mapInArrow(_root_batches(percent, trees), NODES), f"{name}-1")
    cheap = LEAF * classes.count()
    n = cur.count()
    leaves, edges = [], []

    def over(rest: DataFrame, last: bool) -> bool:
        """Whether no node of ``rest`` has to branch: there is none, or all are compared."""
        pairs = rest.agg(F.sum("m")).first()[0]
        if pairs is None:
            return True
        if depth > 1 and (last or pairs <= cheap):
            leaves.append(_pairs(rest))
            return True
        return False

    for level in range(1, depth + 1):
        asked, rest = _settled(_mixed(cur, n, f"{name}-sized-{level}"))
        leaves.append(asked)
        if over(rest, 1 < level == depth):
            break
        looked = _pivoted(rest.drop("m"), classes, f"{name}-{level}")
        edges.append(looked.where("pivot >= 0").select(F.col("cls").alias("a"), F.col("pivot").alias("b")))
        if depth == 1:
            break
        asked, rest = _settled(_mixed(looked.where("pivot < 0").drop("pivot"), n, f"{name}-left-{level}"))
        leaves.append(asked)
        if over(rest, False):
            break
        cur = written(rest.join(classes.select("cls", "sig"), "cls").mapInArrow(_branch_batches(percent), NODES),
                      f"{name}-{level + 1}")
        n = max(n, cur.count())
    rows = leaves[0]
    for more in leaves[1:]:
        rows = rows.unionByName(more)
    found = (rows.join(_sketches(classes), "cls").repartition("g").sortWithinPartitions("g")
             .mapInArrow(_leaf_batches, "a long, b long"))
    for more in edges:
        found = found.unionByName(more)
    return written(found, f"{name}-links")


def loose_links(classes: DataFrame, percent: int = PERCENT, trees: int = TREES) -> DataFrame:
    """(a, b): links of classes (cls, sig) whose embeddings agree in half of their places,
    enough of them to join what all such links would join (as far as trees bring them
    together)."""
    first = _tree_links(classes.select("cls", F.col("cls").alias("lab"), "sig"), percent,
                        range(trees, trees + FIRST_TREES), 1, "paths-first")
    label = forest_roots(first, "paths-labels").select(F.col("node").alias("cls"), "root")
    labelled = written(classes.select("cls", "sig").join(label, "cls", "left").select(
        "cls", F.coalesce("root", "cls").alias("lab"), "sig"), "paths-labelled")
    return first.unionByName(_tree_links(labelled, percent, range(trees), DEPTH, "paths-trees"))


def _sketch_batches(batches):
    for batch in batches:
        sig = matrix(batch.column("sig"), np.uint32)
        yield pa.RecordBatch.from_arrays([batch.column("cls"), fixed((sig & 0xFF).astype(np.uint8))],
                                         names=["cls", "sketch"])


def _sketches(classes: DataFrame) -> DataFrame:
    return classes.select("cls", "sig").mapInArrow(_sketch_batches, "cls long, sketch binary")


# --- exact links -----------------------------------------------------------

class Sets:
    """The full sets of one group, with their tokens numbered."""

    def __init__(self, blobs: list[bytes], sig: np.ndarray, percent: int):
        self.sig, self.percent = sig, percent
        self.n = np.array([len(b) // 8 for b in blobs])
        tokens, self.token = np.unique(np.frombuffer(b"".join(blobs), U64), return_inverse=True)
        self.at = np.concatenate(([0], np.cumsum(self.n)))
        self.mark = np.zeros(len(tokens), bool)

    def linked(self, x: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that link with set x."""
        n = self.n[others]
        others = others[(100 * np.minimum(n, self.n[x]) >= self.percent * np.maximum(n, self.n[x]))
                        & ((self.sig[others] == self.sig[x]).sum(1) >= LOOSE)]
        if not len(others):
            return others
        mine = self.token[self.at[x]:self.at[x + 1]]
        self.mark[mine] = True
        n = self.n[others]
        first = np.concatenate(([0], np.cumsum(n)))
        at = np.arange(first[-1]) + np.repeat(self.at[others] - first[:-1], n)
        both = np.add.reduceat(self.mark[self.token[at]], first[:-1], dtype=np.int64)
        self.mark[mine] = False
        return others[100 * both >= self.percent * (n + self.n[x] - both)]


def _grown(sets: Sets, cls: np.ndarray):
    """A spanning forest of the links among all sets: each component grows from one
    member, and members found are compared only with sets not yet found."""
    left, out = np.arange(len(cls)), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            hit = sets.linked(x, left)
            out += [(cls[x], cls[y]) for y in hit]
            queue += hit.tolist()
            left = np.setdiff1d(left, hit, assume_unique=True)
    return out


def _met(sets: Sets, cls: np.ndarray, label: np.ndarray, asks: np.ndarray):
    """Links of the asking sets with sets of other components, one for each component."""
    label, out = label.copy(), []
    for x in np.flatnonzero(asks):
        for y in sets.linked(x, np.flatnonzero(label != label[x])):
            if label[y] != label[x]:
                out.append((cls[x], cls[y]))
                label[label == label[y]] = label[x]
    return out


LINK, ASKS = 0, 1


def _exact_group(percent: int):
    """One block of full sets -> links (a, b); of a group with several blocks also the
    members that are not connected with its pivot inside the block: (member, label)."""
    def run(group: pa.Table) -> pa.Table:
        cls, first = np.unique(group.column("cls").to_numpy(), return_index=True)
        asks = np.zeros(len(cls), bool)
        asks[np.searchsorted(cls, group.column("cls").to_numpy()[group.column("asks").to_numpy()])] = True
        root, blocks = group.column("root")[0].as_py(), group.column("blocks")[0].as_py()
        group = group.take(first)
        sets = Sets(group.column("blob").to_pylist(), matrix(group.column("sig"), np.uint32), percent)
        out = _met(sets, cls, group.column("label").to_numpy(), asks) if asks.any() else _grown(sets, cls)
        a, b = (np.array(c, np.int64) for c in zip(*out, strict=True)) if out else (cls[:0], cls[:0])
        kind = np.zeros(len(a), np.int32)
        if blocks > 1 and not asks.any():
            label = forest(np.searchsorted(cls, a), np.searchsorted(cls, b), len(cls))
            apart = np.flatnonzero(label != label[np.searchsorted(cls, root)])
            a, b = np.concatenate((a, cls[apart])), np.concatenate((b, cls[label[apart]]))
            kind = np.concatenate((kind, np.full(len(apart), ASKS, np.int32)))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "kind": pa.array(kind)})
    return run


def _links_in(blocks: DataFrame, percent: int) -> DataFrame:
    return (blocks.select("root", "block", "blocks", "cls", "label", "asks", "sig", "blob").groupBy("root", "block")
            .applyInArrow(_exact_group(percent), "a long, b long, kind int"))


def _by_largest(large: DataFrame, links: DataFrame) -> DataFrame:
    """``large`` with the label of each member's component so far, and ``apart``: the same
    where it is not the largest of its group."""
    comp = forest_roots(links, "paths-inner").withColumnRenamed("node", "cls").withColumnRenamed("root", "label")
    labelled = written(large.join(comp, "cls", "left").withColumn("label", F.coalesce("label", "cls")), "paths-inner-labels")
    main = (labelled.groupBy("root", "label").agg(F.count("*").alias("members")).groupBy("root")
            .agg(F.max_by("label", F.struct("members", "label")).alias("main"), F.sum("members").alias("load")))
    return written(lookup(labelled, main, ["root"], "load", labelled.count()).withColumn(
        "apart", F.when(F.col("label") != F.col("main"), F.col("label"))).drop("main"), "paths-largest")


def exact_links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): links confirmed on the full sets, which join the same classes as all links
    do. ``sets``: (cls, root, n, sig, blob), one row for each class of a loose group."""
    size = sets.groupBy("root").agg(F.count("*").alias("load"), F.sum("n").alias("tokens"))
    size = size.withColumn("blocks", F.greatest(F.ceil(F.col("load") / BLOCK),
                                                F.ceil(F.col("tokens") * 8 / BLOCK_BYTES)))
    dealt = written(lookup(sets, size, ["root"], "load", sets.count()), "paths-sets")
    home = F.pmod(F.xxhash64("cls"), F.col("blocks"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    as_row = [F.col("cls").alias("label"), F.lit(False).alias("asks")]
    inside = dealt.select("*", home.alias("block"), *as_row).unionByName(
        dealt.where("blocks > 1 and cls = root").select("*", every.alias("block"), *as_row))
    found = written(_links_in(inside, percent), "paths-links")
    links, apart = found.where(f"kind = {LINK}"), found.where(f"kind = {ASKS}")
    if apart.isEmpty():
        return links.drop("kind")
    # what is not connected with the pivot inside its block meets all blocks of its group
    label = apart.select(F.col("a").alias("cls"), F.col("b").alias("apart"))
    labelled = written(dealt.where("blocks > 1").join(label, "cls", "left")
                       .withColumn("label", F.coalesce("apart", "root")), "paths-labelled")
    if labelled.where("apart is not null").count() > labelled.count() // 4:
        # a pivot that resembles few: the largest component of all blocks takes its place
        labelled = _by_largest(labelled.drop("apart", "label"), links)
    meet = labelled.select("*", home.alias("block"), F.lit(False).alias("asks")).unionByName(
        labelled.where("apart is not null").select("*", every.alias("block"), F.lit(True).alias("asks")))
    return links.unionByName(written(_links_in(meet, percent), "paths-met")).drop("kind")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                    trees: int = TREES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    arrow_batches(spark)
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    each = written(docs.mapInArrow(_set_batches(shingle), f"doc_id {kind}, n long, x long, s long, sig binary"),
                   "paths-docs")
    classes = written(each.where("n > 0").groupBy(*SET).agg(
        F.min("doc_id").alias("least_id"), F.count("*").alias("load"), F.first("sig").alias("sig"))
        .withColumn("cls", F.monotonically_increasing_id()), "paths-classes")
    loose = written(forest_roots(loose_links(classes, percent, trees), "paths-loose")
                    .withColumnRenamed("node", "cls"), "paths-groups")
    wanted = written(classes.select(*SET, "cls", "sig").join(loose, "cls"), "paths-wanted")
    bits = min(MAX_BITMAP, max(10, int(8 * wanted.count()).bit_length()))
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    # at most 2^27 bits, 16 MB, whatever the input
    for w in row_bitmap(wanted, F.shiftrightunsigned("x", 64 - bits)).collect():
        bitmap[w["word"]] = w["bits"]
    held = spark.sparkContext.broadcast(bitmap.tobytes())
    blobs = (docs.select("text").mapInArrow(_blob_batches(shingle, bits, held), "n long, x long, s long, blob binary")
             .groupBy(*SET).agg(F.first("blob").alias("blob")))
    sets = written(wanted.join(blobs, SET).select("cls", "root", "n", "sig", "blob"), "paths-full")
    comp = written(forest_roots(exact_links(sets, percent), "paths-cc").withColumnRenamed("node", "cls"), "paths-comp")
    rooted = written(classes.select(*SET, "cls", "least_id", "load").join(comp, "cls", "left").withColumn(
        "root", F.coalesce("root", "cls")), "paths-rooted")
    best = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("copies"))
    named = lookup(rooted, best, ["root"], "copies", rooted.count()).select(*SET, "component_id", "load")
    some = each.where("n > 0").select("doc_id", *SET)
    full = lookup(some, named, SET, "load", some.count()).select("doc_id", "n", "component_id")
    return (full.unionByName(each.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def op13_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
