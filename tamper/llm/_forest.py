"""Connected components by spanning forests of chunks, small stars and pointer jumps.

Every task reduces the edges it reads, ``CHUNK`` at a time, to a forest of stars: each node
but the smallest of its tree has one edge, to that smallest node. So a node has at most one
lesser neighbour from each chunk, and all its lesser neighbours may be gathered. A round
links a node and its lesser neighbours with the least of them, sends each edge on to the
least neighbour of its smaller end (a pointer jump) and reduces again. A hub, the smaller
end of many edges, has none of them gathered. Least neighbours never grow and rounds that
change none are the last; the depth of a tree halves in each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamper.llm._spark import written

__all__ = ["forest", "forest_roots"]

CHUNK = 1 << 19
BROADCAST_ROWS = 1 << 16


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of n indices over the edges (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable over the edges) of every node but those smallest."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    root = forest(at[:len(a)], at[len(a):], len(nodes))
    pick = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[pick], nodes[root[pick]]


def _star_batches(batches):
    """Edges (a, b) -> stars of up to CHUNK edges at a time."""
    held, n = [], 0
    for batch in batches:
        held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        n += batch.num_rows
        if n >= CHUNK:
            yield _star_batch(held)
            held, n = [], 0
    if n:
        yield _star_batch(held)


def _star_batch(held: list) -> pa.RecordBatch:
    a, b = _stars(*map(np.concatenate, zip(*held, strict=True)))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _nodes(edges: DataFrame, name: str) -> DataFrame:
    """(u, lows, below) of each node: its lesser neighbours in the stars of the chunks, and
    whether it is the lesser neighbour of another."""
    end = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("low")),
                            F.struct(F.col("b").alias("u"), F.lit(None).cast("long").alias("low"))))
    return written(edges.mapInArrow(_star_batches, "a long, b long").select(end.alias("end")).select("end.*")
                   .groupBy("u").agg(F.collect_set("low").alias("lows"), F.min("low").alias("low"),
                                     F.max(F.col("low").isNull()).alias("below")), name)


def forest_roots(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: long, not null), root the smallest
    node reachable: a stored table. Self-loops and repeated edges are allowed; no edges,
    no rows. The driver sees two numbers of each round."""
    nodes = _nodes(edges.select("a", "b").where("a <> b"), f"{name}-0")
    step = 0
    while True:
        left = nodes.agg(F.count_if(F.size("lows") > 1).alias("many"),
                         F.count_if(F.col("low").isNotNull() & F.col("below")).alias("deep")).first()
        if not left["many"] and not left["deep"]:
            return nodes.select(F.col("u").alias("node"), F.coalesce("low", "u").alias("root"))
        step += 1
        near = nodes.where("low is not null").select(
            F.explode(F.concat(F.array("u"), F.array_remove("lows", F.col("low")))).alias("a"), F.col("low").alias("b"))
        jump = nodes.where("low is not null and below").select(F.col("u").alias("b"), F.col("low").alias("on"))
        if left["deep"] <= BROADCAST_ROWS:
            jump = F.broadcast(jump)
        nodes = _nodes(near.join(jump, "b", "left").select("a", F.coalesce("on", "b").alias("b")), f"{name}-{step}")
