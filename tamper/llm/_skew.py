"""Joins and running totals whose hot keys are split: a key may hold a third of all rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamper.llm._spark import written

__all__ = ["lookup", "running"]

HOT_ROWS = 1 << 16
HOT_KEYS = 10_000


def lookup(rows: DataFrame, table: DataFrame, on: list[str], load: str, n: int,
           how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has one row for each key and in ``load`` the
    number of rows of ``rows`` that hold it (``n`` in all). Keys of over
    max(HOT_ROWS, n / HOT_KEYS) rows are at most HOT_KEYS, whatever the input: those are
    broadcast, so their rows stay where they are; the others are shuffled, at most that
    many to a key. ``rows`` is read twice and should be a stored table; null keys match
    nothing."""
    limit = max(HOT_ROWS, n // HOT_KEYS)
    if n <= HOT_ROWS:
        return rows.join(table.drop(load), on, how)
    hot = table.where(F.col(load) > limit).drop(load)
    marked = rows.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), on, "left")
    cold = marked.where("__hot is null").select(*rows.columns).join(
        table.where(F.col(load) <= limit).drop(load), on, how)
    return marked.where("__hot").drop("__hot").unionByName(cold)


def _local_runs(xors: list[str], sums: list[str]):
    """Sorted batches of one partition -> running values since the start of the key in
    this partition; ``pos`` counts from 0."""
    def run(batches):
        key, held = None, {c: 0 for c in ["pos", *xors, *sums]}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            c = batch.column("c").to_numpy()
            first = np.concatenate(([True], c[1:] != c[:-1]))
            at = np.flatnonzero(first)[np.cumsum(first) - 1]
            head = np.cumsum(first) == 1  # rows that may go on with the key of the last batch
            goes_on = head & (c == key) if key is not None else np.zeros(n, bool)
            out = {"pos": np.arange(n) - at}
            out["pos"][goes_on] += held["pos"]
            for name in xors:
                v = batch.column(name).to_numpy()
                total = np.bitwise_xor.accumulate(v)
                out[name] = total ^ np.where(at > 0, total[at - 1], 0)
                out[name][goes_on] ^= held[name]
            for name in sums:
                total = np.cumsum(batch.column(name).to_numpy())
                out[name] = total - np.where(at > 0, total[at - 1], 0)
                out[name][goes_on] += held[name]
            key, held = c[-1], {k: v[-1] for k, v in out.items()}
            held["pos"] += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(v.astype(np.int64)) for v in out.values())],
                names=[*batch.schema.names, *(f"{k}_run" if k != "pos" else k for k in out)])
    return run


def running(df: DataFrame, key: str, order: list[str], name: str, xors=(), sums=()) -> DataFrame:
    """``df`` with ``pos``, the place of a row in its key (from 0, by ``order``, which has
    to be total up to equal rows), and for each long column x of ``xors`` and ``sums`` the
    running exclusive or / sum ``x_run``, its own row included. ``key`` is a long that is
    not null.

    The rows are range-sorted by key and order, so a key of any size is dealt over many
    tasks; each task keeps running values and a key that goes on in the next task starts
    there with what the tasks before hold: one row for each task reaches the driver."""
    spark = df.sparkSession
    xors, sums = list(xors), list(sums)
    runs = ["pos", *(f"{c}_run" for c in [*xors, *sums])]
    sorted_rows = (df.withColumnRenamed(key, "c").repartitionByRange("c", *order)
                   .sortWithinPartitions("c", *order).withColumn("pid", F.spark_partition_id()))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sorted_rows.schema)
    local = written(sorted_rows.mapInArrow(
        _local_runs(xors, sums), schema + "".join(f", {r} long" for r in runs)), name)
    tasks = local.groupBy("pid").agg(
        F.min("c").alias("lo"), F.max("c").alias("hi"),
        F.max_by(F.struct(*runs), F.struct("c", "pos")).alias("last")).orderBy("pid").collect()
    held_key, held, starts = None, None, []
    for t in tasks:
        last = t["last"].asDict()
        last["pos"] += 1
        start = dict.fromkeys(runs, 0)
        if held_key is not None and t["lo"] == held_key:
            start = held
            starts.append((t["pid"], t["lo"], *(start[r] for r in runs)))
        if t["lo"] == t["hi"]:
            last = {r: start[r] ^ last[r] if r[:-4] in xors else start[r] + last[r] for r in runs}
        held_key, held = t["hi"], last
    if starts:
        offsets = spark.createDataFrame(starts, "pid int, c long, " + ", ".join(
            f"__{r} long" for r in runs))
        add = {r: (F.col(r).bitwiseXOR(F.coalesce(f"__{r}", F.lit(0))) if r[:-4] in xors
                   else F.col(r) + F.coalesce(f"__{r}", F.lit(0))) for r in runs}
        local = local.join(F.broadcast(offsets), ["pid", "c"], "left").withColumns(add).drop(
            *(f"__{r}" for r in runs))
    return local.drop("pid").withColumnRenamed("c", key)
