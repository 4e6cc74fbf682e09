"""Forms that hold at scale: quantiles over ranges, one-pass histograms, merges over stored
states, freshness from footers, sketches that merge, one snapshot for all reports, VARIANT."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamper.operators.aggregates import box_stats, histogram, quantile_columns, running_weights
from tamper.plans import layers, monitoring, quality, reports
from tamper.plans.layers import ENTITIES
from tamper.schemas import ORDER_SCHEMA, SEQ_FIELDS
from tamper.streaming import pipeline as P

from test_ingest_stream import AS_OF, emission, order, write_lines


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def many_tasks(spark):
    """Ranges stay apart: no merging of small shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_quantiles_of_a_group_with_a_third_of_all_rows(spark, many_tasks):
    """All values of the large group differ, and it is dealt over several ranges."""
    rng = np.random.default_rng(1)
    rows = [("big", float(v)) for v in rng.permutation(4000) / 7]
    rows += [(f"g{i % 40}", float(v)) for i, v in enumerate(rng.integers(0, 50, 8000))]
    rows += [(None, 1.0), (None, 2.0), ("one", 5.0), ("g0", None), ("void", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    weights = running_weights(df, ["k"], "v")
    assert weights.where("k = 'big'").select("pid").distinct().count() > 2
    got = {r.k: r for r in weights.groupBy("k").agg(*quantile_columns([0, .1, .5, .99, 1])).collect()}
    values = {}
    for k, v in rows:
        if v is not None:
            values.setdefault(k, []).append(v)
    assert set(got) == set(values)
    for k, r in got.items():
        np.testing.assert_allclose([r[f"q{i}"] for i in range(5)], np.quantile(values[k], [0, .1, .5, .99, 1]), rtol=1e-12)
    box = {r.k: r for r in box_stats(df, ["k"], "v").collect()}
    q1, q3 = np.quantile(values["big"], [.25, .75])
    inside = [v for v in values["g3"] if v is not None]
    assert box["big"].n == 4000 and box["big"].n_outliers == 0 and abs(box["big"].q3 - q3) < 1e-9 and abs(box["big"].q1 - q1) < 1e-9
    assert box["g3"].min == min(inside) and box["one"].whisker_low == box["one"].whisker_high == 5.0
    assert {r.k for r in box_stats(df, ["k"], "v", exact=False).collect()} == set(values)


def test_histogram_reads_its_input_once_and_builds_without_a_job(spark):
    spark.range(1000).selectExpr("id % 37 as x").createOrReplaceTempView("hist_in")
    tracker = spark.sparkContext.statusTracker()
    df = spark.table("hist_in").withColumn("x", F.col("x").cast("double"))
    spark.sparkContext.setJobGroup("hist", "build")
    out = histogram(df, "x")
    assert tracker.getJobIdsForGroup("hist") == []
    rows = out.collect()
    values = [i % 37 for i in range(1000)]
    counts, edges = np.histogram(values, 20)
    assert [r.n_rows for r in sorted(rows, key=lambda r: r.bin)] == counts.tolist()
    np.testing.assert_allclose([r.bin_start for r in sorted(rows, key=lambda r: r.bin)], edges[:-1])
    text = executed(out)
    final = text.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in text or "ReusedSubquery" in final
    empty = histogram(df.where("x < 0"), "x").collect()
    assert len(empty) == 20 and all(r.n_rows == 0 and r.bin_start is None for r in empty)
    one = {r.bin: r.n_rows for r in histogram(df.where("x = 3"), "x").collect()}
    assert one[10] == 27 or one[9] == 27


def _landed(spark, batches):
    """Orders of several batches, one shared key and one of its own each."""
    schema = T.StructType([*ORDER_SCHEMA.fields, *SEQ_FIELDS, T.StructField("BATCH_ID", T.LongType())])
    rows = []
    for b in batches:
        for key in ("t-0", f"t-{b}x"):
            values = {"TXID": key, "ITEM": f"item {b}", "DELIVERY_STATUS": f"s{b}", "SEQ1": b, "SEQ2": 0, "BATCH_ID": b,
                      "PURCHASE_TIME": dt.date(2025, 1, 1), "INGEST_TS": dt.datetime(2025, 1, 1)}
            rows.append(tuple(values.get(f.name) for f in schema))
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("broadcast_bytes", [None, 1 << 20])
def test_six_merges_read_one_table_and_one_batch(spark, broadcast_bytes):
    raw = _landed(spark, range(6))
    out = layers.upsert_two_batches("orders", raw, AS_OF, broadcast_bytes=broadcast_bytes)
    assert executed(out).count("FileScan") <= 6  # however many batches came before
    got = {r.TXID: (r.ITEM, r.DELIVERY_STATUS) for r in out.collect()}
    assert got["t-0"] == ("Item 5", "s0") and len(got) == 7 and got["t-3x"] == ("Item 3", "s3")
    again = layers.fold_two_batches("orders", raw, AS_OF)
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
    assert layers.upsert_two_batches("orders", raw.limit(0), AS_OF).count() == 0


def test_stored_freshness_reads_footers_only(spark, scratch):
    raw = _landed(spark, range(4)).withColumn("DELIVERED_DATE", F.date_add("PURCHASE_TIME", F.col("BATCH_ID").cast("int")))
    raw.write.parquet(f"{scratch}/raw")
    raw.where("BATCH_ID < 2").write.parquet(f"{scratch}/gold")
    tables = [("RAW", "RAW_ORDERS", f"{scratch}/raw"), ("GOLD", "GOLD_ORDERS", f"{scratch}/gold")]
    out = monitoring.stored_freshness(spark, tables, "2025-01-10")
    text = executed(out)
    assert text.count("PushedAggregation: [COUNT(*), MAX(DELIVERED_DATE)]") >= 2
    got = {r.layer: r for r in out.collect()}
    assert (got["RAW"].row_count, got["GOLD"].row_count) == (8, 4)
    assert got["RAW"].max_event_date == dt.date(2025, 1, 4) and got["GOLD"].max_event_date == dt.date(2025, 1, 2)
    assert got["GOLD"].lag_min - got["RAW"].lag_min == 2 * 1440  # the stale copy shows
    assert got["RAW"].last_load_time is not None
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_sketches_of_batches_add_up(spark):
    raw = spark.range(30000).select(
        F.concat(F.lit("t-"), F.col("id") % 20000).alias("TXID"), F.when(F.col("id") % 10 != 0, F.lit("c")).alias("CUSTOMER_ID"),
        F.lit(dt.date(2030, 1, 1)).alias("PURCHASE_TIME"), (F.col("id") % 5).alias("BATCH_ID"))
    sketches = quality.key_sketches(raw, AS_OF)
    got, exact = quality.dq_orders_merged(sketches).first(), quality.dq_orders(raw, AS_OF).first()
    assert sketches.count() == 5
    for c in ("N", "N_NULL_CUSTOMER", "N_NULL_TXID", "N_FUTURE_PURCHASES"):
        assert got[c] == exact[c]
    assert abs(got.N_DISTINCT_TXID - 20000) < 600
    assert quality.dq_orders_merged(sketches.limit(0)).first().N_DISTINCT_TXID == 0


def test_reports_share_one_snapshot(spark):
    built, now = [], [0.0]

    def source():
        built.append(1)
        return layers.silver_snapshot("orders", _landed(spark, range(2)), AS_OF)

    session = reports.Reports({"orders": source}, clock=lambda: now[0])
    first = session.table("orders", version=7)
    rows = reports.sales_dashboard(first)
    assert {r.report for r in rows.collect()} >= {"sales_kpis", "delivery_status", "sales_histogram"}
    assert session.table("orders", version=7) is first and len(built) == 1
    session.table("orders", version=8)
    assert len(built) == 2
    session.table("orders")
    now[0] = 59.0
    session.table("orders")
    assert len(built) == 3
    now[0] = 61.0
    session.table("orders")
    assert len(built) == 4
    assert "lineitem" not in executed(rows)


def test_variant_columns_round_trip(spark, scratch):
    layout = P.Layout(f"{scratch}/o", "orders")
    write_lines(layout.path("landing"), "a.jsonl", [
        order("t-1", metadata={"device": {"id": 7}, "tags": ["a", "b"]}), order("t-2"), order("t-3", metadata="plain words")])
    serving = P.run_pipeline(spark, layout, AS_OF, with_ingest=True)
    assert isinstance(serving.schema["METADATA"].dataType, T.VariantType)
    got = {r.TXID: r for r in serving.select("TXID", F.try_variant_get("METADATA", "$.device.id", "int").alias("id"),
                                             F.try_variant_get("METADATA", "$.tags[1]", "string").alias("tag"),
                                             F.to_json("METADATA").alias("text")).collect()}
    assert (got["t-1"].id, got["t-1"].tag) == (7, "b")
    assert got["t-2"].text is None and json.loads(got["t-3"].text) == "plain words"
    layout = P.Layout(f"{scratch}/e", "emissions")
    rec = json.loads(emission("r-1")) | {"raw_payload": {"kwh": 3.5}, "metadata": {"v": 1}}
    write_lines(layout.path("landing"), "a.jsonl", [json.dumps(rec)])
    served = P.run_pipeline(spark, layout, AS_OF, with_ingest=True).select(
        F.variant_get("RAW_PAYLOAD", "$.kwh", "double").alias("kwh"), F.col("METADATA").isNull().alias("unset")).first()
    assert (served.kwh, served.unset) == (3.5, True)
    assert "METADATA" not in ENTITIES["emissions"]["insert"]
