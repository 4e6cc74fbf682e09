"""Operator 11: prefix trie of conversations by whole-sequence collapse.

Turns are rebuilt (a number of first turns comes from another conversation), identical
rebuilt conversations collapse to one weighted sequence with the list of its members, and
only the different sequences are expanded to prefixes. A sequence that is a proper prefix
of another falls out by an anti-join; the rest are the leaves. Weighted prefixes are then
aggregated to nodes. A prefix is known by its depth and two 64-bit exclusive ors over
hashes of (place, turn), a turn by the MD5 of role and text.

Sums over a subtree need no walk: the smallest member of a node is also the smallest of
the nodes below it on that member's own path, so the nodes a sequence owns are one chain
down to its end. A node's subtree is the rest of its own chain plus the whole chain of
every other sequence through it that starts deeper, which is one more aggregation of the
paths.

Skew: places and prefixes are running values over range-sorted turns, so one conversation
of any length is dealt over many tasks; groups are aggregated map-side; joins on a
conversation, a sequence or a parent split their hot keys (``lookup``). The list of a
sequence's members is hashed as one stream, as SHA-256 demands: sorted ids are joined to
blobs of 1 MB in parallel, and one task reads the blobs of a sequence.

Defined cases: a null role or text is empty; turns with the same number are ordered by the
MD5 of role and text (equal rows are separate turns); rows with a null conversation id
belong to none and are left out; a conversation may rebuild to no turns and is then a
member of the root alone; an empty table has no nodes; extra columns are ignored. Ids are
taken as numbers; ``%`` has the sign of the id.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamper.llm._skew import lookup, running
from tamper.llm._spark import arrow_batches, table, written

BLOCK, HEADS = 20, 3
BLOB = 1 << 20
WORDS = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "g1", "g2"]


def turns(conversations: DataFrame) -> DataFrame:
    """(c, turn, t, w): turns by digest and number of words, without their texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("t"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("w"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(turns, convs)``: (c, q, t, w) turns of the rebuilt conversations, and (c, length)
    of all of them. Conversation c gets the first h turns of conversation c - c % 20, then
    its own after its first h; h = crc32(decimal c) % 4."""
    own = written(running(turns(conversations), "c", ["turn", "t"], "trie-turns"), "trie-own")
    heads = [F.max(F.when(F.col("pos") == i, F.struct("t", "w"))).alias(f"head{i}") for i in range(HEADS)]
    convs = written(own.groupBy("c").agg(F.count("*").alias("n"), *heads), "trie-convs")
    first = convs.select(F.col("c").alias("base"), F.col("n").alias("base_n"),
                         *[F.col(f"head{i}").alias(f"base{i}") for i in range(HEADS)])
    # a base serves the twenty ids of its block at most
    info = written(convs.select("c", "n", (F.crc32(F.col("c").cast("string").cast("binary")) % 4)
                                .alias("h"), (F.col("c") - F.col("c") % BLOCK).alias("base"))
                   .join(first, "base", "left")
                   .withColumn("b", F.least("h", F.coalesce("base_n", F.lit(0)))), "trie-info")
    taken = (info.select("c", "b", F.posexplode(F.array(*[f"base{i}" for i in range(HEADS)])))
             .where("pos < b").select("c", F.col("pos").cast("long").alias("q"), "col.t", "col.w"))
    total = own.count()
    kept = (lookup(own, info.select("c", "h", "b", "n"), ["c"], "n", total).where("pos >= h")
            .select("c", (F.col("pos") - F.col("h") + F.col("b")).alias("q"), "t", "w"))
    return (taken.unionByName(kept),
            info.select("c", (F.col("b") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))


def _joined_ids(batches):
    """Rows sorted by (depth, g1, g2, c) -> blobs of comma-joined ids of one sequence."""
    key, ids, start, held = None, [], None, 0

    def blob():
        return (*key, start, ",".join(ids))

    for batch in batches:
        out = []
        for *k, c in zip(*(batch.column(x).to_pylist() for x in [*NODE, "c"]), strict=True):
            if k != key or held > BLOB:
                if key is not None:
                    out.append(blob())
                key, ids, start, held = k, [], c, 0
            ids.append(str(c))
            held += len(ids[-1]) + 1
        if out:
            yield _blob_batch(out)
    if key is not None:
        yield _blob_batch([blob()])


def _blob_batch(rows):
    names = [*NODE, "start", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(v, pa.string() if n == "ids" else pa.int64())
                                       for n, v in zip(names, zip(*rows, strict=True), strict=True)], names=names)


def _hashed(batches):
    """Blobs sorted by sequence and first id -> the SHA-256 of each sequence's list."""
    key, sha = None, None
    for batch in batches:
        out = []
        for *k, ids in zip(*(batch.column(x).to_pylist() for x in [*NODE, "ids"]), strict=True):
            if k == key:
                sha.update(b",")
            else:
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = k, hashlib.sha256()
            sha.update(ids.encode())
        if out:
            yield _sha_batch(out)
    if key is not None:
        yield _sha_batch([(*key, sha.hexdigest())])


def _sha_batch(rows):
    names = [*NODE, "ends"]
    return pa.RecordBatch.from_arrays([pa.array(v, pa.string() if n == "ends" else pa.int64())
                                       for n, v in zip(names, zip(*rows, strict=True), strict=True)], names=names)


def member_lists(members: DataFrame) -> DataFrame:
    """(depth, g1, g2, ends): SHA-256 of the ids of each sequence of ``members``
    (depth, g1, g2, c), ascending and joined by commas."""
    blobs = (members.repartitionByRange(*NODE, "c").sortWithinPartitions(*NODE, "c")
             .mapInArrow(_joined_ids, "depth long, g1 long, g2 long, start long, ids string"))
    return (blobs.repartition(*NODE).sortWithinPartitions(*NODE, "start")
            .mapInArrow(_hashed, "depth long, g1 long, g2 long, ends string"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations: conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    arrow_batches(conversations.sparkSession)
    steps, convs = rebuilt(conversations)
    steps = written(steps.select("c", "q", "w", F.xxhash64("q", "t").alias("x"),
                                 F.xxhash64(F.lit(1), "q", "t").alias("y")), "trie-steps")
    # identical conversations: one weighted sequence
    whole = written(steps.select("c", "x", "y", F.lit(1).alias("one")).unionByName(
        convs.select("c", F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), F.lit(0).alias("one")))
        .groupBy("c").agg(F.sum("one").alias("depth"), F.bit_xor("x").alias("g1"),
                          F.bit_xor("y").alias("g2")), "trie-whole")
    seqs = written(whole.groupBy(*NODE).agg(F.min("c").alias("c"), F.count("*").alias("weight")),
                   "trie-sequences")
    own_steps = lookup(steps, seqs.select("c", "weight", F.col("depth").alias("length"),
                                          F.col("depth").alias("load")), ["c"], "load", steps.count())
    prefixes = running(own_steps, "c", ["q"], "trie-prefixes", xors=["x", "y"])
    zero = F.lit(0).cast("long")
    paths = written(prefixes.select(
        "c", "weight", "length", (F.col("q") + 1).alias("depth"), F.col("x_run").alias("g1"),
        F.col("y_run").alias("g2"), F.col("x_run").bitwiseXOR(F.col("x")).alias("p1"),
        F.col("y_run").bitwiseXOR(F.col("y")).alias("p2"), "w").unionByName(seqs.select(
            "c", "weight", F.col("depth").alias("length"), zero.alias("depth"), zero.alias("g1"),
            zero.alias("g2"), zero.alias("p1"), zero.alias("p2"), zero.alias("w"))), "trie-paths")
    proper = paths.where("depth < length").select(*NODE).distinct()
    leaves = seqs.join(proper, NODE, "left_anti").select("c", F.lit(1).alias("leaf"))

    nodes = written(paths.groupBy(*NODE).agg(
        F.sum("weight").alias("n_convs"), F.min("c").alias("conv_id"), F.max("w").alias("w"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"))
        .withColumn("value", (F.col("n_convs") - 1) * F.col("w")), "trie-nodes")
    chains = written(running(nodes, "conv_id", ["depth"], "trie-chains", sums=["value"]), "trie-owned")
    owners = written(chains.groupBy("conv_id").agg(
        F.min("depth").alias("top"), F.sum("value").alias("chain"), F.count("*").alias("load")), "trie-owners")
    # a sequence may own no node: a longer one with a smaller member passes its end
    about = written(seqs.select("c", (F.col("depth") + 1).alias("load"))
                    .join(owners.select(F.col("conv_id").alias("c"), "top", "chain"), "c", "left")
                    .join(leaves, "c", "left").fillna(0, ["chain", "leaf"]), "trie-about")
    n_paths = paths.count()
    below = (lookup(paths.select("c", *NODE), about, ["c"], "load", n_paths).groupBy(*NODE)
             .agg(F.sum(F.when(F.col("depth") < F.col("top"), F.col("chain")).otherwise(0)).alias("under"),
                  F.sum("leaf").alias("n_leaves")))
    children = (nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"),
                                                 F.col("p1").alias("g1"), F.col("p2").alias("g2"))
                .agg(F.count("*").alias("n_children")))
    # what is left of the own chain from this node on
    tail = lookup(chains, owners.select("conv_id", "chain", "load"), ["conv_id"], "load", n_paths).select(
        *NODE, "conv_id", "p1", "p2", "n_convs", "pos",
        (F.col("chain") - F.col("value_run") + F.col("value")).alias("under"))
    parts = (tail.unionByName(below, True).unionByName(children, True)
             .unionByName(member_lists(whole), True))
    done = written(parts.groupBy(*NODE).agg(
        F.sum("under").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"),
        F.coalesce(F.sum("n_children"), zero).alias("n_children"),
        F.coalesce(F.max("ends"), F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        *[F.max(c).alias(c) for c in ("conv_id", "p1", "p2", "n_convs", "pos")]), "trie-done")
    # on a chain the parent has the same smallest member; at its top it has another
    up = done.select((F.col("depth") + 1).alias("depth"), F.col("g1").alias("p1"),
                     F.col("g2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    tops = written(done.where("pos = 0 and depth > 0"), "trie-tops")
    rest = done.where("pos > 0 or depth = 0").withColumn(
        "parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    named = lookup(tops.withColumnRenamed("n_children", "children"), up, ["depth", "p1", "p2"], "n_children",
                   done.count()).withColumnRenamed("children", "n_children")
    return rest.unionByName(named).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
