"""Continuous runs: per-batch "now", micro-batch limits, both MERGE forms, tolerant loading."""

import datetime as dt

import pytest

from tamper.functions.time import lookback, try_date
from tamper.operators.merge import upsert
from tamper.sources import ingest
from tamper.streaming import pipeline as P

from test_ingest_stream import AS_OF, order, write_lines


def _raw(spark, layout, batches, files=1):
    from tamper.schemas import ORDER_SCHEMA, SEQ_COLUMNS

    for b, lines in enumerate(batches):
        write_lines(layout.path("in"), f"b{b}.jsonl", lines, tick=b)
        good, _ = ingest.to_raw(ingest.read_json(spark, layout.path(f"in/b{b}.jsonl"), "orders"), "orders")
        ingest.write_batch(good.select(*ORDER_SCHEMA.names, *SEQ_COLUMNS).repartition(files),
                           layout.path("raw"), b)


def _gold(spark, root, batches, limit, files):
    layout = P.Layout(root, "orders")
    _raw(spark, layout, batches, files)
    for hop in ("silver", "gold"):
        q = P.run_hop(spark, layout, hop, AS_OF, max_files_per_trigger=limit)
        q.awaitTermination()
        assert not q.exception()
    return sorted(map(tuple, P.layer_state(spark, layout, "gold").collect()), key=str)


def test_file_limit_does_not_change_the_state(spark, scratch):
    """One RAW batch over several micro-batches gives the state of one micro-batch."""
    batches = [[order(f"t-{i % 4}", item=f"item {b}{i}", quantity=i + 1) for i in range(8)]
               for b in range(2)]
    one = _gold(spark, f"{scratch}/all", batches, None, 4)
    assert len(one) == 4
    assert _gold(spark, f"{scratch}/l1", batches, 1, 4) == one
    assert _gold(spark, f"{scratch}/l2", batches, 2, 4) == one


def test_now_is_taken_per_batch_and_kept_for_replays(spark, scratch):
    layout = P.Layout(scratch, "orders")
    today = dt.date.today()
    lines = [order("t-1", purchase_time=today.isoformat()),
             order("t-2", purchase_time=(today + dt.timedelta(days=9)).isoformat())]
    _raw(spark, layout, [lines])
    q = P.run_hop(spark, layout, "silver")  # no as_of
    q.awaitTermination()
    assert not q.exception()
    got = {r.TXID: r.PURCHASE_TIME for r in P.read_layer(spark, layout, "silver").collect()}
    assert got == {"t-1": today, "t-2": None}
    first = P.batch_time(spark, layout, 0)
    assert P.batch_time(spark, layout, 0) == first


@pytest.mark.parametrize("update", [["u"], ["u", "i"], []])
@pytest.mark.parametrize("insert", [["k", "i"], ["k", "i", "u"], ["k"]])
def test_both_merge_forms_agree(spark, update, insert):
    t = spark.createDataFrame([("a", 1, 1), ("c", 5, 5)], "k string, u int, i int")
    s = spark.createDataFrame([("a", 2, 2), ("b", 2, 2)], "k string, u int, i int")
    forms = [sorted(map(str, upsert(t, s, "k", update, insert, broadcast_bytes=size).collect()))
             for size in (None, 1 << 20)]
    assert forms[0] == forms[1]
    new = next(r for r in upsert(t, s, "k", update, insert, broadcast_bytes=None).collect() if r.k == "b")
    assert (new.u, new.i) == (2 if "u" in insert else None, 2 if "i" in insert else None)


def test_quarantine_does_not_depend_on_the_columns_read(spark, scratch):
    lines = [order("t-1", quantity=2.0), order("t-2", quantity="many"), order("t-3", quantity=2.5),
             order("t-4", purchase_time="2025-03-05T13:45:12")]
    write_lines(f"{scratch}/in", "a.jsonl", lines)
    good, bad = ingest.to_raw(ingest.read_json(spark, f"{scratch}/in", "orders"), "orders")
    assert good.count() == good.select("TXID").count() == len(good.collect()) == 2
    assert bad.count() == 2
    rows = {r.TXID: r for r in good.collect()}
    assert rows["t-1"].QUANTITY == 2 and rows["t-4"].PURCHASE_TIME == dt.date(2025, 3, 5)


def test_dates_and_look_back(spark):
    df = spark.createDataFrame([("2024-03-05T13:45:12",), ("2024-03-05",), ("2024-03-05 01:02:03.5",),
                                ("2025-13-01",), ("x",), (None,)], "s string")
    got = [r[0] for r in df.select(try_date("s")).collect()]
    day = dt.date(2024, 3, 5)
    assert got == [day, day, day, None, None, None]
    assert lookback("t", 24 * 30, dt.datetime(2024, 1, 30)) is not None
