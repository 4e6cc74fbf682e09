"""Operator 3: sharding by vector bin packing.

Groups of equal texts are vectors (bytes, tokens, rows). Each goes, in decreasing size, to
the shard where the dot product of its vector with the residual capacity is highest, which
balances all three jointly. Law ``bytes``: the shards' sizes come out near equal.

The packing is distributed. Cells that hold at least a ``FINE``-th of a shard in some
dimension are placed first, on the driver: by that bound there are at most
6 * shards * FINE of them, whatever the input. A group over a ``SPLIT``-th of a shard is
split into cells by a hash of the row, so a text that a third of all rows share spreads
over all shards; smaller groups stay whole. Bytes weigh most in the product. The small cells are dealt to tasks by hash, and each task packs its cells into its share of the
residual capacity. Slots are numbered from counts per (shard, sub-range).

Tokens are estimated as blank-separated words. Defined cases: null text has 8 bytes (its
row) and crc 0; repeated rows and repeated or null ids are separate rows; ties go to the
lower shard; fewer rows than shards leave shards empty; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamper.llm._spark import table, written

SHARDS, ROW_BYTES = 24, 8
FINE, SPLIT = 64, 8
WEIGHTS = np.array([4.0, 1.0, 1.0])
CELLS_PER_TASK = 20_000
ROWS_PER_SLOT_RANGE = 50_000
GROUP = ["g", "text_crc32", "size"]
DIMS = ["bytes", "tokens", "rows"]


def place(items: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Shard of each item (n, dims): largest first, each where its dot product with the
    residual capacity (shards, dims) is highest. ``residual`` is used up."""
    out = np.empty(len(items), np.int64)
    for i in np.argsort(-items.max(axis=1), kind="stable"):
        shard = int(np.argmax(residual @ (WEIGHTS * items[i])))
        residual[shard] -= items[i]
        out[i] = shard
    return out


def _place_task(share: list[list[float]], totals: list[float]):
    share, totals = np.array(share), np.array(totals)

    def run(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values([*GROUP, "chunk"], kind="stable")
        items = cells[DIMS].to_numpy(float) / totals
        cells["shard"] = place(items, share * items.sum(axis=0)).astype(np.int32)
        return cells[[*GROUP, "chunk", "shard"]]
    return run


def shard_cells(rows: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their cell's chunk, and (group, chunk, shard) of every cell."""
    groups = rows.groupBy(*GROUP).agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                                      F.count("*").alias("rows"))
    total = groups.agg(*[F.sum(d).alias(d) for d in DIMS]).first()
    totals = [max(float(total[d] or 0), 1.0) for d in DIMS]
    limits = dict(zip(DIMS, [t / (shards * FINE) for t in totals], strict=True))
    pieces = F.greatest(*[F.ceil(F.col(d) / F.lit(limits[d] * FINE / SPLIT)) for d in DIMS])
    # at most 3 * shards * SPLIT groups are that large
    split = groups.where((pieces > 1) & (F.col("rows") > 1)).select(
        *GROUP, F.least(pieces, F.col("rows")).alias("pieces"))
    rows = rows.join(F.broadcast(split), GROUP, "left").withColumn(
        "chunk", F.coalesce(F.pmod(F.xxhash64("rid"), F.col("pieces")), F.lit(0)).cast("int"))
    cells = written(rows.groupBy(*GROUP, "chunk").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")),
        "sharding-cells")
    large = F.greatest(*[F.col(d) / F.lit(limits[d] / 2) for d in DIMS]) >= 1
    first = cells.where(large).orderBy(*GROUP, "chunk").toPandas()
    residual = np.full((shards, len(DIMS)), 1.0 / shards)
    first["shard"] = place(first[DIMS].to_numpy(float) / totals, residual).astype(np.int32)
    residual = np.maximum(residual, 1e-12)
    share = residual / residual.sum(axis=0)
    count = cells.count()
    tasks = max(1, -(-count // CELLS_PER_TASK))
    schema = "g long, text_crc32 long, size long, chunk int, shard int"
    small = (cells.where(~large).withColumn("task", F.pmod(F.xxhash64(*GROUP, "chunk"), F.lit(tasks)))
             .groupBy("task").applyInPandas(_place_task(share.tolist(), totals), schema))
    spark = rows.sparkSession
    placed = small if first.empty else small.union(
        spark.createDataFrame(first[[*GROUP, "chunk", "shard"]], schema))
    return rows, placed


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs``."""
    raw = F.coalesce(F.octet_length("text"), F.lit(0))
    rows = written(docs.select(
        "doc_id", (raw + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(raw - F.octet_length(F.replace("text", F.lit(" "), F.lit(""))) + 1,
                   F.lit(0)).cast("long").alias("tokens"),
        F.xxhash64("text").alias("g")).withColumn("rid", F.monotonically_increasing_id()),
        "sharding-rows")
    cell_rows, placed = shard_cells(rows, shards)
    dealt = cell_rows.join(placed, [*GROUP, "chunk"]).select(
        "doc_id", "size", "text_crc32", "shard", "rid")
    ranges = max(16, -(-rows.count() // (shards * ROWS_PER_SLOT_RANGE)))
    dealt = written(dealt.withColumn("sub", F.pmod(F.xxhash64("rid"), F.lit(ranges))), "sharding-dealt")
    counts = dealt.groupBy("shard", "sub").agg(F.count("*").alias("n"))
    # shards * ranges rows
    base = counts.select("shard", "sub", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("base"))
    number = F.row_number().over(Window.partitionBy("shard", "sub").orderBy("doc_id", "rid")) - 1
    return (dealt.withColumn("number", number).join(base, ["shard", "sub"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("base") + F.col("number")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def op3_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents", "doc_id", "text"))
