"""How often the rows of the layers are shuffled and written, and that the results stay."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from tamper.operators.clean import latest_per_key
from tamper.operators.merge import changed_rows, fold, post_images, upsert
from tamper.plans import layers, loads
from tamper.schemas import ORDER_SCHEMA, SEQ_FIELDS
from tamper.sources import ingest
from tamper.sources import testdata as TD
from tamper.streaming import pipeline as P

from test_ingest_stream import AS_OF, order, write_lines

SF = "/root/testdata/sf0.001"
COLS = ["K", "ITEM", "STATUS"]


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_landing_shuffles_carry_no_names(spark):
    """The fact rows meet orders and parts before the names of nations and regions."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(TD.orders_landing(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = plan[re.search(r"Exchange hashpartitioning\(l_partkey", plan).start():]
    facts = below[:below.index("Exchange hashpartitioning(p_partkey")]
    assert "l_orderkey" in facts and "n_name" not in facts and "r_name" not in facts


def test_fold_finds_the_winners_itself(spark):
    rows = [("a", 0, 1, "i1", "s1"), ("a", 0, 2, "i2", "s2"), ("a", 1, 5, "i3", "s3"), ("a", 1, 4, "i4", "s4"),
            ("b", None, 1, "i5", "s5"), ("c", 1, None, "i6", "s6"), ("c", 1, 0, None, "s7"), (None, 1, 1, "i8", "s8")]
    df = spark.createDataFrame(rows, "K string, BATCH_ID int, SEQ int, ITEM string, STATUS string")
    one = fold(df, "K", ["ITEM"], COLS, COLS, order_by=["SEQ"])
    two = fold(latest_per_key(df, ["K", "BATCH_ID"], ["SEQ"]), "K", ["ITEM"], COLS, COLS)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert {r.K: (r.ITEM, r.STATUS) for r in one.collect()} == {"a": ("i3", "s2"), "b": (None, None), "c": (None, "s7")}


@pytest.mark.parametrize("insert", [COLS, ["K", "STATUS"]])
def test_fold_by_column_equals_the_fold_of_rows(spark, insert):
    rows = [("a", 0, 1, "i1", "s1"), ("a", 0, 2, "i2", None), ("a", 1, 5, None, "s3"), ("a", 1, 4, "i4", "s4"),
            ("b", None, 1, "i5", "s5"), ("c", 1, None, "i6", "s6"), ("c", 1, 0, None, "s7"), (None, 1, 1, "i8", "s8")]
    df = spark.createDataFrame(rows, "K string, BATCH_ID int, SEQ int, ITEM string, STATUS string")
    by_row, by_column = (fold(df, "K", ["ITEM"], insert, COLS, order_by=["SEQ"], bounds=True, by_column=b)
                         for b in (False, True))
    assert by_row.schema == by_column.schema
    assert sorted(map(str, by_column.collect())) == sorted(map(str, by_row.collect()))


def test_freshness_all_shuffles_no_column_that_it_does_not_read(spark):
    plan = executed(E.queries()["freshness_all"](spark, SF))
    folds = re.findall(r"Exchange hashpartitioning\((?:TXID|RECORD_ID)[^\n]*\n[^\n]*partial_max_by[^\n]*", plan)
    assert len(folds) == 2
    for line in folds:
        assert "DELIVERED_DATE" in line or "REPORTING_MONTH" in line
        assert not re.search("ITEM|CUSTOMER_ID|PAYMENT_STATUS|WAREHOUSE_NAME|SHIPMENTS_COUNT", line)


def test_fold_orders_shuffles_the_fact_rows_once(spark):
    assert len(re.findall(r"Exchange hashpartitioning\(TXID", executed(E.queries()["fold_orders"](spark, SF)))) == 1


@pytest.mark.parametrize("insert", [COLS, ["K", "ITEM"], ["K", "STATUS"]])
def test_post_images_are_the_changed_rows(spark, insert):
    target = spark.createDataFrame([("a", "i1", "s1"), ("b", "i2", None), ("c", None, "s3"), (None, "i0", "s0")],
                                   "K string, ITEM string, STATUS string")
    source = spark.createDataFrame([("b", None, "t2"), ("c", "j3", "t3"), ("d", "j4", "t4"), (None, "j0", "t0")],
                                   target.schema)
    merged = upsert(target, source, "K", ["ITEM"], insert, COLS, broadcast_bytes=None)
    expected = changed_rows(merged, source, "K").select(*COLS)
    got = post_images(target, source, "K", ["ITEM"], insert, COLS)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_merge_of_two_batches_shuffles_each_once(spark):
    schema = T.StructType([*ORDER_SCHEMA.fields, *SEQ_FIELDS, T.StructField("BATCH_ID", T.LongType())])
    rows = []
    for b in (0, 1):
        for key, seq in (("t-0", 1), ("t-0", 2), (f"t-{b}x", 1)):
            values = {"TXID": key, "ITEM": f"item {b}{seq}", "DELIVERY_STATUS": f"s{b}{seq}", "SEQ1": seq, "BATCH_ID": b,
                      "PURCHASE_TIME": dt.date(2025, 1, 1)}
            rows.append(tuple(values.get(f.name) for f in schema))
    out = layers.upsert_two_batches("orders", spark.createDataFrame(rows, schema), AS_OF)
    assert executed(out).count("Exchange hashpartitioning(TXID") == 2
    assert executed(out).count("Exchange hashpartitioning") == 2
    assert {r.TXID: (r.ITEM, r.DELIVERY_STATUS) for r in out.collect()} == {
        "t-0": ("Item 12", "s02"), "t-0x": ("Item 01", "s01"), "t-1x": ("Item 11", "s11")}


def test_gold_folds_only_where_a_key_may_repeat(spark, scratch, monkeypatch):
    folds = []
    monkeypatch.setattr(P, "fold_log", lambda *a, **k: folds.append(1) or fold_log(*a, **k))
    from tamper.operators.merge import fold_log

    layout = P.Layout(scratch, "orders")
    for i, item in enumerate(["first", "second"]):
        write_lines(layout.path("landing"), f"{i}.jsonl", [order("t-1", item=item), order(f"t-{i}x")], tick=i)
        P.drain(spark, layout, "ingest")
        P.drain(spark, layout, "silver", AS_OF)
        if i == 0:
            P.drain(spark, layout, "gold")
    P.drain(spark, layout, "gold")
    assert not folds
    silver = P.read_layer(spark, layout, "silver")
    assert P.gold_batch(layout)(silver, 7) == 3 and folds
    got = {r.TXID: r.ITEM for r in P.read_layer(spark, layout, "gold").where("BATCH_ID = 7").collect()}
    assert got["t-1"] == "Second" and len(got) == 3


def test_batches_arrive_by_a_move(spark):
    layout, out = loads.streamed(spark, SF, "emissions")
    assert out.count() == P.layer_state(spark, layout, "gold").count()
    left = [f for _, _, fs in os.walk(layout.path("staging").removeprefix("file:")) for f in fs if f.endswith(".parquet")]
    assert left == []


def test_landed_json_is_gzipped_and_read_again(spark, scratch):
    df = spark.createDataFrame([("t-1", "Bean")], "TXID string, ITEM string")
    folder = ingest.land_json(df, scratch, "orders", "x")
    assert all(f.endswith(".json.gz") for f in os.listdir(folder) if f.startswith("part-"))
    assert [(r.txid, r.item) for r in ingest.read_json(spark, folder, "orders").select("txid", F.col("item")).collect()] == [("t-1", "Bean")]
