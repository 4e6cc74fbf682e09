"""Training rows shared by the two classifiers: a bounded sample of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TRAIN = 4000


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str,
                  max_train: int = MAX_TRAIN) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, y) of at most ``max_train`` labelled documents outside the held-out
    third, half of each class at most, chosen by a hash of the id; and the counts of the
    classes over all such labels (for the prior). Null labels and documents with
    contradictory labels teach nothing."""
    known = (labels.select("doc_id", F.col(label).cast("int").alias("y"))
             .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("top"))
             .where("y = top").drop("top"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pick = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train // 2)
        pick = part if pick is None else pick.union(part)
    # at most max_train rows: a documented bound
    return docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id"), counts
