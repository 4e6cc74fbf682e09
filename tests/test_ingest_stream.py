import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tamper.plans import monitoring
from tamper.sources import ingest
from tamper.streaming.pipeline import Layout, layer_state, read_layer, run_pipeline

AS_OF = dt.date(2025, 6, 1)


def order(txid, item="espresso roast", status="Delivered", delivered="2025-03-09", **kw):
    rec = {"txid": txid, "rfid": "0x1f", "customer_id": "c-1", "product_id": "p-1", "item": item,
           "bag_size": "1kg", "unit_price": 47.22, "quantity": 1, "total_price": 47.22,
           "purchase_time": "2025-03-01", "shipped_date": "2025-03-02",
           "delivered_date": delivered, "delivery_status": status, "carbon_score": 1.5}
    rec.update(kw)
    return json.dumps(rec)


_T0 = 1_700_000_000


def write_lines(folder, name, lines, tick=0):
    """Write a landing file with a distinct modification time: file order
    (and with it "latest") follows the time a file landed."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (_T0 + tick, _T0 + tick))


def test_json_ingest_quarantine(spark, scratch):
    lines = [order("t-1"), "", "{not json", json.dumps({"txid": "t-2", "item": "x"}),
             order("t-3", purchase_time="2025-13-01"), order("t-4", delivered="2025-13-01")]
    write_lines(f"{scratch}/in", "a.jsonl", lines)
    good, bad = ingest.to_raw(ingest.read_json(spark, f"{scratch}/in", "orders"), "orders")
    g = {r.TXID: r for r in good.collect()}
    # blank line skipped; malformed and missing-required-key rows quarantined;
    # a purchase date that does not parse violates PURCHASE_TIME NOT NULL
    # (quarantined), a bad value in a nullable date column becomes NULL
    assert set(g) == {"t-1", "t-4"} and bad.count() == 3
    assert g["t-1"].DELIVERED_DATE == dt.date(2025, 3, 9) and g["t-1"].REGION is None
    assert g["t-4"].DELIVERED_DATE is None and g["t-4"].PURCHASE_TIME == dt.date(2025, 3, 1)
    assert "t-3" in {r.txid for r in bad.collect()}


def test_write_batch_replay_is_idempotent(spark, scratch):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    ingest.write_batch(df, f"{scratch}/log", 0)
    ingest.write_batch(df, f"{scratch}/log", 1)
    ingest.write_batch(df, f"{scratch}/log", 1)  # replay of batch 1
    assert spark.read.parquet(f"{scratch}/log").count() == 4


def _pipeline(spark, root, batches, max_files=None):
    layout = Layout(root, "orders")
    for i, lines in enumerate(batches):
        write_lines(layout.path("landing"), f"b{i}.jsonl", lines, tick=i)
    return layout, run_pipeline(spark, layout, AS_OF, with_ingest=True,
                                max_files_per_trigger=max_files)


def test_streaming_pipeline_merges_partial_columns(spark, scratch):
    layout = Layout(f"{scratch}/p", "orders")
    write_lines(layout.path("landing"), "b0.jsonl", [order("t-1", item="espresso roast")])
    run_pipeline(spark, layout, AS_OF, with_ingest=True)
    # same key again: new ITEM and a NULL delivered date, other status
    write_lines(layout.path("landing"), "b1.jsonl",
                [order("t-1", item="single-origin spotlight blend", status="Returned",
                       delivered=None), order("t-2")], tick=1)
    serving = run_pipeline(spark, layout, AS_OF, with_ingest=True)
    r = {x.TXID: x for x in serving.collect()}
    assert r["t-1"].ITEM == "Single-Origin Spotlight Blend"   # update column: new value
    assert r["t-1"].DELIVERED_DATE is None                     # NULL overwrites
    assert r["t-1"].DELIVERY_STATUS == "Delivered"             # other column: first seen
    assert set(r) == {"t-1", "t-2"}
    # replaying the hops with nothing new changes nothing
    again = run_pipeline(spark, layout, AS_OF, with_ingest=True)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, serving.collect()))
    # the run log feeds the monitoring reports
    runs = spark.read.parquet(layout.runs)
    summary = monitoring.task_summary(runs).first()
    assert summary.total_runs >= 6 and summary.failed == 0
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(minutes=1)
    recent = monitoring.task_history(runs, 1, now)
    assert recent.count() == summary.total_runs
    assert recent.where("DURATION_SEC IS NULL").count() == 0


def test_one_batch_vs_many_same_update_columns_and_keys(spark, scratch):
    batches = [[order("t-1", item="a one"), order("t-2")],
               [order("t-1", item="a two", status="Returned")],
               [order("t-3"), order("t-1", item="a three")]]
    _, one = _pipeline(spark, f"{scratch}/one", batches)
    _, many = _pipeline(spark, f"{scratch}/many", batches, max_files=1)
    cols = ["TXID", "ITEM", "BAG_SIZE", "PURCHASE_TIME", "SHIPPED_DATE", "DELIVERED_DATE",
            "CARBON_SCORE"]
    assert sorted(map(tuple, one.select(cols).collect())) == \
        sorted(map(tuple, many.select(cols).collect()))


def test_layer_state_equals_fold_of_log(spark, scratch):
    layout, serving = _pipeline(spark, f"{scratch}/s", [[order("t-1"), order("t-2")]])
    silver = layer_state(spark, layout, "silver")
    assert silver.count() == serving.count() == 2
    assert read_layer(spark, layout, "silver").where(F.col("FIRST_BATCH").isNull()).count() == 0


def test_compaction_snapshot_plus_newer_equals_full_fold(spark, scratch):
    from tamper.operators.merge import fold
    from tamper.plans.layers import ENTITIES
    from tamper.streaming.pipeline import FIRST, LAST, compact

    layout, _ = _pipeline(spark, f"{scratch}/c", [[order("t-1", item="one"), order("t-2")]])
    v0 = compact(spark, layout, "silver")
    write_lines(layout.path("landing"), "late.jsonl",
                [order("t-1", item="two", status="Returned"), order("t-9")], tick=5)
    run_pipeline(spark, layout, AS_OF, with_ingest=True)
    e = ENTITIES["orders"]
    full = fold(read_layer(spark, layout, "silver"), e["key"], e["update"], e["insert"],
                e["columns"], batch_col=LAST, first_col=FIRST)
    incremental = layer_state(spark, layout, "silver")
    assert v0 is not None
    assert sorted(map(tuple, incremental.collect())) == sorted(map(tuple, full.collect()))
    assert {r.TXID: r.ITEM for r in incremental.collect()}["t-1"] == "Two"


def emission(rid, kg=120.0, est=96.0, month="2025-03-01"):
    return json.dumps({"record_id": rid, "reporting_month": month, "warehouse_id": "PARIS_FR",
                       "warehouse_name": "Paris", "warehouse_country": "France",
                       "origin_country": "Ethiopia", "distance_class": "Regional",
                       "shipping_method": "EcoDelivery", "shipments_count": 100,
                       "avg_batch_size_kg": kg, "estimated_emissions_kgCO2e": est})


def test_emissions_pipeline_nulls_negative_and_updates_all_columns(spark, scratch):
    layout = Layout(f"{scratch}/e", "emissions")
    write_lines(layout.path("landing"), "e0.jsonl", [emission("r-1"), emission("r-2", est=-5.0)])
    write_lines(layout.path("landing"), "e1.jsonl", [emission("r-1", kg=130.0, est=104.0),
                                                     json.dumps({"record_id": "r-3"})], tick=1)
    out = {r.RECORD_ID: r for r in run_pipeline(spark, layout, AS_OF,
                                                with_ingest=True).collect()}
    assert set(out) == {"r-1", "r-2"}                     # r-3 lacks required keys
    assert out["r-2"].ESTIMATED_EMISSIONS_KGCO2E is None  # C5
    assert str(out["r-1"].AVG_BATCH_SIZE_KG) == "130.00"
    assert spark.read.parquet(layout.path("quarantine")).count() == 1


def test_continuous_hops_with_processing_time_trigger(spark, scratch):
    from tamper.streaming.pipeline import publish_serving, read_serving, start_pipeline

    layout = Layout(f"{scratch}/c2", "orders")
    write_lines(layout.path("landing"), "b0.jsonl", [order("t-1"), order("t-2")])
    queries = start_pipeline(spark, layout, AS_OF, trigger={"processingTime": "1 second"})
    try:
        for q in queries:
            q.processAllAvailable()
    finally:
        for q in queries:
            q.stop()
    serving = read_serving(spark, layout, publish_serving(spark, layout))
    assert serving.count() == 2


def test_replay_after_crash_between_write_and_commit(spark, scratch):
    """Exactly-once per hop: if a hop dies after its sink wrote batch n but
    before the checkpoint committed it, the restart re-runs batch n with the
    same input; the sink overwrites partition n with the same rows."""
    from tamper.streaming.pipeline import publish_serving, read_serving, run_hop

    layout = Layout(f"{scratch}/x", "orders")
    write_lines(layout.path("landing"), "b0.jsonl", [order("t-1"), order("t-2"), order("t-1", item="b")])
    for hop in ("ingest", "silver", "gold"):
        run_hop(spark, layout, hop, AS_OF).awaitTermination()
    before = read_layer(spark, layout, "silver")
    n_before = before.count()
    expected = sorted(map(tuple, read_serving(spark, layout, publish_serving(spark, layout)).collect()))

    # crash simulation: the commit of the last silver batch never happened
    commits = os.path.join(layout.checkpoint("silver"), "commits")
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    os.remove(os.path.join(commits, str(last)))
    crc = os.path.join(commits, f".{last}.crc")  # local file system checksum
    if os.path.exists(crc):
        os.remove(crc)
    run_hop(spark, layout, "silver", AS_OF).awaitTermination()   # replays batch `last`
    run_hop(spark, layout, "gold", AS_OF).awaitTermination()     # sees rewritten files

    assert read_layer(spark, layout, "silver").count() == n_before
    write_lines(layout.path("landing"), "b1.jsonl", [order("t-3")], tick=1)
    run_pipeline(spark, layout, AS_OF, with_ingest=True)
    after = sorted(map(tuple, layer_state(spark, layout, "gold").collect()))
    assert [r for r in after if r[0] != "t-3"] == expected


def test_load_raw_matches_columns_by_name(spark, scratch):
    # a staged file with a missing table column, an extra column and
    # lower-precision types: loading by name keeps the table schema
    df = spark.createDataFrame([("r-1", "2025-03-01", "PARIS_FR", 3.5, "junk")],
                               "RECORD_ID string, REPORTING_MONTH string, WAREHOUSE_ID string, "
                               "AVG_BATCH_SIZE_KG double, EXTRA string")
    df = df.withColumn("REPORTING_MONTH", F.to_date("REPORTING_MONTH")) \
           .withColumn("AVG_BATCH_SIZE_KG", F.col("AVG_BATCH_SIZE_KG").cast("decimal(10,2)"))
    ingest.write_batch(df, f"{scratch}/raw_e", 7)
    got = ingest.load_raw(spark, f"{scratch}/raw_e", "emissions").first()
    assert got.RECORD_ID == "r-1" and got.WAREHOUSE_NAME is None and got.BATCH_ID == 7
    assert "EXTRA" not in got.asDict() and str(got.AVG_BATCH_SIZE_KG) == "3.50"


def test_load_staged_takes_other_types_and_keeps_bad_rows(spark, scratch):
    rows = [("t-1", 3.456, 2, "2024-03-05T13:45:12"), ("t-2", 1e12, 2, "2024-03-05"),
            ("t-3", 1.0, 2, "2024-13-05"), (None, 1.0, 2, "2024-03-05"),
            ("t-5", None, None, "2024-03-05"), ("t-6", float("nan"), 2, "2024-03-05")]
    spark.createDataFrame(rows, "txid string, unit_price double, quantity long, purchase_time string") \
        .withColumn("extra", F.lit(1)).write.parquet(f"{scratch}/staged")
    good, bad = ingest.load_staged(spark, f"{scratch}/staged", "orders")
    assert good.schema.names == ingest.ORDER_SCHEMA.names
    got = {r.TXID: r for r in good.collect()}
    assert set(got) == {"t-1", "t-5"} and str(got["t-1"].UNIT_PRICE) == "3.46"
    assert got["t-1"].PURCHASE_TIME == dt.date(2024, 3, 5) and got["t-5"].QUANTITY is None
    assert sorted(str(r.txid) for r in bad.collect()) == ["None", "t-2", "t-3", "t-6"]
    assert bad.columns == ["txid", "unit_price", "quantity", "purchase_time", "extra"]


def test_whole_numbers_have_ten_digits(spark):
    from pyspark.sql import types as T

    texts = ["3000000000", "9999999999", "10000000000", "2.0", "2.5", "x", None, "-9999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.v for r in df.select(ingest.typed_value(F.col("t"), T.LongType()).alias("v")).collect()]
    assert got == [3000000000, 9999999999, None, 2, None, None, None, -9999999999]


def test_write_batch_caps_records_per_file(spark, scratch):
    df = spark.range(5).coalesce(1).selectExpr("cast(id as string) as k")
    ingest.write_batch(df, f"{scratch}/capped", 3, max_records_per_file=2)
    files = [f for f in os.listdir(f"{scratch}/capped/BATCH_ID=3") if f.endswith(".parquet")]
    assert len(files) == 3 and spark.read.parquet(f"{scratch}/capped").count() == 5


def test_load_errors_from_quarantine(spark, scratch):
    from tamper.streaming.pipeline import load_history

    layout = Layout(f"{scratch}/le", "orders")
    write_lines(layout.path("landing"), "good.jsonl", [order("t-1")])
    write_lines(layout.path("landing"), "bad.jsonl",
                [order("t-2"), "{oops", json.dumps({"txid": "t-9"})], tick=1)
    run_pipeline(spark, layout, AS_OF, with_ingest=True)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(minutes=1)
    errs = monitoring.load_errors(load_history(spark, layout), 1, now).collect()
    assert len(errs) == 1 and errs[0].FILE_NAME.endswith("bad.jsonl")
    assert errs[0].ROW_COUNT == 2 and errs[0].TABLE_FQN == "RAW_ORDERS"
    assert errs[0].FIRST_ERROR_MESSAGE.startswith("malformed record")
