"""Tables stored by a hash of their key: no shuffle where equal keys meet, the same rows."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from tamper.operators import buckets
from tamper.operators.clean import latest_per_key
from tamper.plans import layers, loads, registry
from tamper.schemas import ORDER_SCHEMA, SEQ_FIELDS
from tamper.sources import ingest, staged
from tamper.streaming import pipeline as P

from test_ingest_stream import AS_OF

SF = "/root/testdata/sf0.001"
WRITTEN = layers.written


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def landed(spark, batches=(0, 1), keys=40):
    """Landed orders: every batch holds each of its keys twice, some keys of other batches, a
    NULL key and a row without a batch."""
    schema = T.StructType([*ORDER_SCHEMA.fields, *SEQ_FIELDS, T.StructField("BATCH_ID", T.LongType())])
    rows = []
    for b in (*batches, None):
        for k in (*range(b or 0, keys, 1 + (b or 0)), None) if b is not None else (3, keys + 1):
            for seq in (0, 1):
                values = {"TXID": None if k is None else f"t-{k}", "ITEM": f"item {b} {seq}", "SEQ1": seq, "SEQ2": 0,
                          "DELIVERY_STATUS": f"s{b}{seq}", "PURCHASE_TIME": dt.date(2025, 1, 1), "BATCH_ID": b,
                          "DELIVERED_DATE": None if seq else dt.date(2025, 1, 2),
                          "INGEST_TS": dt.datetime(2025, 1, 1, seq)}
                rows.append(tuple(values.get(f.name) for f in schema))
    return spark.createDataFrame(rows, schema).repartition(3)


def rows(df):
    return sorted(map(str, df.collect()))


def test_rows_by_bucket_are_grouped_without_a_shuffle(spark, scratch):
    df = landed(spark)
    out = buckets.stored(df, f"{scratch}/t", "TXID", "BATCH_ID")
    w = latest_per_key(out.where("BATCH_ID = 1"), "TXID")
    assert "Exchange" not in executed(w)
    assert rows(out) == rows(df)
    assert rows(w) == rows(latest_per_key(df.where("BATCH_ID = 1"), "TXID"))
    assert buckets.stored(df.limit(0), f"{scratch}/empty", "TXID", "BATCH_ID").count() == 0


def test_a_crowded_table_is_read_as_plain_files(spark, scratch, monkeypatch):
    monkeypatch.setattr(buckets, "CROWDED_ROWS", 5)
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("K"),
                                 F.col("id").alias("SEQ"))
    out = buckets.stored(df, f"{scratch}/hot", "K", buckets=20)
    w = latest_per_key(out, "K", ["SEQ"])
    assert re.search(r"Exchange hashpartitioning\(K", executed(w)) and "WindowGroupLimit" in executed(w)
    assert {r.K: r.SEQ for r in w.collect()}["hot"] == 297 and w.count() == 201
    even = buckets.stored(df.where("K <> 'hot'"), f"{scratch}/even", "K", buckets=20)
    assert "Exchange" not in executed(latest_per_key(even, "K", ["SEQ"]))


def test_files_of_an_earlier_run_are_opened_by_bucket(spark, scratch):
    df = landed(spark)
    buckets.write(df.drop("BATCH_ID"), f"{scratch}/t", "TXID", 8)
    again = buckets.open_table(spark, f"{scratch}/t", df.drop("BATCH_ID").schema, "TXID", 8)
    assert "Exchange" not in executed(latest_per_key(again, "TXID")) and rows(again) == rows(df.drop("BATCH_ID"))
    files = [f for f in os.listdir(f"{scratch}/t") if f.endswith(".parquet")]
    assert all(re.search(buckets.BUCKET_FILE, f) and "zstd" in f for f in files)
    ids = again.select(F.regexp_extract(again.metadataColumn("_metadata")["file_name"], buckets.BUCKET_FILE, 1).cast("int")
                       .alias("f"), buckets.bucket_id("TXID", 8).alias("b"))
    assert ids.where("f <> b").count() == 0


@pytest.mark.parametrize("chain", [layers.gold_chain, layers.serving_chain])
def test_chains_shuffle_no_batch(spark, chain):
    """GOLD's merges meet both batches where they are; the serving merge shuffles GOLD alone."""
    raw = landed(spark, (0, 1)).where("BATCH_ID IS NOT NULL")
    out = chain("orders", raw, AS_OF)
    assert executed(out).count("Exchange hashpartitioning") == (0 if chain is layers.gold_chain else 1)
    assert rows(out) == rows(layers.fold_two_batches("orders", raw, AS_OF))


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_measured_merges_shuffle_and_store_no_batch(spark, limit, monkeypatch):
    stored = []
    monkeypatch.setattr(layers, "written", lambda *a: stored.append(a) or WRITTEN(*a))
    raw = landed(spark, (0, 1)).where("BATCH_ID IS NOT NULL")
    out = layers.upsert_two_batches("orders", raw, AS_OF, broadcast_bytes=limit)
    assert "Exchange hashpartitioning(TXID" not in executed(out) and not stored
    assert ("BroadcastHashJoin" in executed(out)) == bool(limit)
    assert rows(out) == rows(layers.fold_two_batches("orders", raw, AS_OF))


def test_chain_over_batches_without_an_id(spark):
    raw = landed(spark, (0, 1, 2))
    out = layers.gold_chain("orders", raw, AS_OF)
    assert rows(out) == rows(layers.upsert_two_batches("orders", raw, AS_OF))


def test_freshness_stored_writes_its_layers_without_a_shuffle_of_rows(spark, scratch, monkeypatch):
    plans = []
    snapshot = layers.silver_snapshot
    monkeypatch.setattr(registry.layers, "silver_snapshot", lambda *a: plans.append(snapshot(*a)) or plans[-1])
    out = E.queries()["freshness_stored"](spark, SF).collect()
    assert len(plans) == 2 and all("Exchange" not in executed(p) for p in plans)
    raw = registry.raw_orders(spark, SF)
    got = {r.layer: r.row_count for r in out}
    assert got == {"RAW": raw.count(), "SILVER": raw.select("TXID").distinct().count(),
                   "GOLD": raw.where("BATCH_ID = 0").select("TXID").distinct().count()}


def test_no_hop_of_a_bucketed_layout_shuffles_rows(spark):
    """Every layer of the stream is in the buckets of its key; only distinct bucket numbers and
    counts are exchanged."""
    layout, out = loads.streamed(spark, SF)
    n = P.log_buckets(spark, layout)
    assert n == 64
    for layer in ("silver", "gold", "serving"):
        files = [f for _, _, fs in os.walk(layout.path(layer)) for f in fs if f.endswith(".parquet")]
        assert files and all(re.search(buckets.BUCKET_FILE, f) for f in files)
    folder = f"{layout.path('gold')}/BATCH_ID=0"
    names = []
    rows_0 = P.open_files(spark, layout, "gold", [f"{folder}/{f}" for f in os.listdir(folder) if f.endswith(".parquet")], n, names)
    assert len(names) == 1 and "Exchange" not in executed(latest_per_key(rows_0, "TXID", ["LAST_BATCH"]))
    assert rows_0.count() == P.read_layer(spark, layout, "gold").where("BATCH_ID = 0").count()
    some = P.open_files(spark, layout, "gold", [f"{folder}/{f}" for f in sorted(os.listdir(folder)) if f.endswith(".parquet")][:3],
                        n, names)  # a part of a batch
    assert len(names) == 1 and "Exchange hashpartitioning(TXID" in executed(some) and 0 < some.count() < rows_0.count()
    buckets.drop(spark, names)
    assert not [t for t in spark.catalog.listTables() if t.name in names]
    assert rows(out) == rows(P.layer_state(spark, layout, "gold"))
    assert rows(out.drop("METADATA")) == rows(loads.streamed(spark, SF, max_files_per_trigger=2)[1].drop("METADATA"))


def test_a_crowded_stream_keeps_plain_layers(spark, monkeypatch):
    monkeypatch.setattr(buckets, "crowded", lambda *a: True)
    layout, out = loads.streamed(spark, SF, "emissions")
    assert P.log_buckets(spark, layout) is None
    assert not any(re.search(buckets.BUCKET_FILE, f) for _, _, fs in os.walk(layout.path("gold")) for f in fs)
    monkeypatch.undo()
    assert rows(out) == rows(loads.streamed(spark, SF, "emissions")[1])


@pytest.mark.parametrize("n", [None, 16])
def test_a_publish_writes_once_and_its_replay_finishes_it(spark, scratch, n):
    """New buckets are moved: those that a dead publish left beside the copy, and, folded from
    GOLD, those that are in neither place."""
    layout = P.Layout(scratch, "orders")
    if n:
        P.bucket_layout(spark, layout, n)
    raw = landed(spark, (0,)).where("BATCH_ID = 0").drop("BATCH_ID")
    raw.write.parquet(f"{layout.path('raw')}/BATCH_ID=0")
    out = P.run_pipeline(spark, layout, AS_OF)
    expected = rows(out)
    assert len(expected) == 40 and out.select("ITEM").distinct().collect()[0][0] == "Item 0 1"
    serving, fresh = layout.path("serving"), f"{layout.path('serving_next')}/BATCH_ID=0"
    assert not [f for _, _, fs in os.walk(fresh) for f in fs if f.endswith(".parquet")]
    there = sorted(d for d in os.listdir(serving) if d.startswith("BUCKET="))
    for d in there[:4]:
        os.rename(f"{serving}/{d}", f"{fresh}/{d}")
    for d in there[4:7]:
        os.rename(f"{serving}/{d}", f"{scratch}/{d}")
    gold = P.read_layer(spark, layout, "gold")
    assert P.serving_batch(layout)(gold.repartition(n, "TXID") if n else gold, 0) == 40
    assert rows(P.read_serving(spark, layout, serving)) == expected
    runs = spark.read.parquet(layout.runs).where("HOP = 'serving'").collect()
    assert [r.ROWS for r in runs] == [40]


def test_a_staged_stream_writes_both_sides_in_buckets(spark, scratch):
    """The layers of a staged stream are in buckets from RAW on; a replay replaces both sides."""
    layout, plain = P.Layout(f"{scratch}/b", "orders"), P.Layout(f"{scratch}/p", "orders")
    P.bucket_layout(spark, layout, 8)
    df = landed(spark, (0,)).where("BATCH_ID = 0 AND TXID IS NOT NULL").select(*ORDER_SCHEMA.names)
    bad = df.withColumn("PURCHASE_TIME", F.lit(None).cast("date")).limit(3)
    for i, part in enumerate((df, bad.unionByName(df.where("TXID = 't-1'")))):
        part.coalesce(1).write.parquet(f"{scratch}/stage/{i}")
    out = {}
    for at in (layout, plain):
        P.drain(spark, at, "staged", landing=f"{scratch}/stage", max_files_per_trigger=1)
        out[at] = P.run_pipeline(spark, at, AS_OF)
    assert rows(out[layout].select("TXID", "PURCHASE_TIME")) == rows(out[plain].select("TXID", "PURCHASE_TIME"))
    for side, count in (("raw", 82), ("quarantine", 3)):
        got = spark.read.parquet(layout.path(side))
        assert got.count() == spark.read.parquet(plain.path(side)).count() == count
        assert got.select(F.input_file_name()).where(~F.input_file_name().rlike(buckets.BUCKET_FILE)).count() == 0
    assert P._write_sides(layout, staged.read_files(spark, [f for f in staged.list_files(spark, f"{scratch}/stage/0")],
                                                    "orders")[0], 1, None) == 80  # batch 1 again, from other files
    assert P.read_layer(spark, layout, "raw").where("BATCH_ID = 1").count() == 80
    assert os.listdir(layout.path("quarantine")) == []
    runs = spark.read.parquet(layout.runs).where("HOP = 'staged'").collect()
    assert sorted(r.ROWS for r in runs) == sorted(r.ROWS for r in spark.read.parquet(plain.runs).where("HOP = 'staged'").collect())


def test_raw_with_a_crowded_bucket_is_read_as_plain_files(spark, scratch, monkeypatch):
    layout = P.Layout(scratch, "orders")
    P.bucket_layout(spark, layout, 16)
    raw = landed(spark, (0,)).where("BATCH_ID = 0").drop("BATCH_ID")
    hot = raw.where("TXID = 't-5'").crossJoin(spark.range(200)).drop("id")
    buckets.write(raw.unionByName(hot), f"{layout.path('raw')}/BATCH_ID=0", "TXID", 16)
    monkeypatch.setattr(buckets, "CROWDED_ROWS", 20)
    files, names = staged.list_files(spark, layout.path("raw")), []
    df = P.open_files(spark, layout, "raw", files, 16, names)
    assert not names and "WindowGroupLimit" in executed(latest_per_key(df, "TXID")).split("Exchange")[1]
    assert P.run_pipeline(spark, layout, AS_OF).count() == 40
    monkeypatch.undo()
    P.open_files(spark, layout, "raw", files, 16, names)
    assert len(names) == 1
    buckets.drop(spark, names)


def test_a_file_of_a_stage_is_dealt_to_several_tasks(spark, scratch, monkeypatch):
    """Layers and stages are cut into row groups, so that two files a trigger use all cores."""
    monkeypatch.setattr(ingest, "ROW_GROUP", 1 << 17)
    df = spark.range(60000).selectExpr("uuid() AS TXID", "uuid() AS ITEM").coalesce(1)
    ingest.write_batch(df, f"{scratch}/log", 0)
    (f,) = [f for f in staged.list_files(spark, f"{scratch}/log") if f.endswith(".parquet")]
    import pyarrow.parquet as pq
    assert pq.ParquetFile(f.removeprefix("file:")).num_row_groups > 4


def test_limited_streams_are_fed_few_files(spark, scratch, monkeypatch):
    """Small files of a batch arrive merged, and a hop with a file limit writes no file for each
    task of its shuffle."""
    layout = P.Layout(scratch, "orders")
    raw = landed(spark, (0,)).where("BATCH_ID = 0").drop("BATCH_ID")
    monkeypatch.setattr(P, "FEW_FILES", 3)
    for i, files in enumerate((6, 2)):
        raw.repartition(files).write.parquet(f"{scratch}/in{i}")
        P.merge_files(spark, f"{scratch}/in{i}", f"{layout.path('raw')}/BATCH_ID={i}", raw.schema)
        got = spark.read.schema(raw.schema).parquet(f"{layout.path('raw')}/BATCH_ID={i}")
        assert rows(got) == rows(raw) and len(got.inputFiles()) == min(files, 3)
        assert not os.path.exists(f"{scratch}/in{i}")
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100b",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        out = P.run_pipeline(spark, layout, AS_OF, max_files_per_trigger=2)
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "100b"
    finally:
        for k in small:
            spark.conf.unset(k)
    silver = [len([f for f in os.listdir(f"{layout.path('silver')}/{d}") if f.endswith(".parquet")])
              for d in os.listdir(layout.path("silver")) if d.startswith("BATCH_ID=")]
    assert len(silver) == 3 and max(silver) < 8  # 8 partitions hold rows
    assert out.count() == 40
