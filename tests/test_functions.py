import datetime as dt
import uuid

from pyspark.sql import functions as F

from tamper.functions.ids import uuid5_dns
from tamper.functions.text import ellipsize, initcap_words, percent_text
from tamper.functions.time import (lag_minutes, lookback, null_if_future, null_if_negative,
                                   seconds_between, try_date)


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_initcap_words_punctuation(spark):
    got = one(spark, [("single-ORIGIN spotlight (eco-glass / x)",), ("",), (None,),
                      ("french press (eco-glass + bamboo lid)",), ("a_b.c,d",)],
              "s string", initcap_words("s"))
    assert got == ["Single-Origin Spotlight (Eco-Glass / X)", "", None,
                   "French Press (Eco-Glass + Bamboo Lid)", "A_B.C,D"]


def test_initcap_differs_from_spark_initcap(spark):
    # Trap T1: Spark's initcap splits on spaces only.
    row = spark.createDataFrame([("single-origin",)], "s string").select(
        F.initcap("s"), initcap_words("s")).first()
    assert row[0] == "Single-origin" and row[1] == "Single-Origin"


def test_ellipsize_30_and_31(spark):
    a, b = "x" * 30, "y" * 31
    got = one(spark, [(a,), (b,)], "s string", ellipsize("s", 30))
    assert got == [a, "y" * 27 + "..."]


def test_uuid5_matches_python(spark):
    names = ["python.org", "a@example.org", "Café Crème", "Single-Origin Spotlight Blend"]
    got = one(spark, [(n,) for n in names] + [(None,)], "s string", uuid5_dns("s"))
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names] + [None]


def test_try_date_bad_value_is_null(spark):
    got = one(spark, [("2025-03-01",), ("2025-13-01",), (None,)], "s string", try_date("s"))
    assert got == [dt.date(2025, 3, 1), None, None]


def test_null_if_future_boundary(spark):
    as_of = dt.date(2025, 3, 1)
    got = one(spark, [(dt.date(2025, 3, 1),), (dt.date(2025, 3, 2),), (None,)], "d date",
              null_if_future("d", as_of))
    assert got == [dt.date(2025, 3, 1), None, None]


def test_null_if_negative(spark):
    got = one(spark, [(-1.0,), (0.0,), (None,)], "x double", null_if_negative("x"))
    assert got == [None, 0.0, None]


def test_percent_text_half_up(spark):
    got = one(spark, [(1.25,), (4.96,), (0.0,)], "x double", percent_text("x"))
    assert got == ["1.3%", "5.0%", "0.0%"]


def test_seconds_between_counts_boundaries(spark):
    a = dt.datetime(2024, 1, 1, 0, 0, 0, 900000)
    b = dt.datetime(2024, 1, 1, 0, 0, 1, 100000)
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(seconds_between("a", "b")).first()[0] == 1


def test_lag_minutes_and_lookback(spark):
    as_of = dt.datetime(2024, 1, 30)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 29, 23, 0),), (dt.datetime(2024, 1, 28),),
                                (None,)], "t timestamp_ntz")
    lags = [r[0] for r in df.select(lag_minutes("t", as_of)).collect()]
    assert lags == [60.0, 2880.0, None]
    kept = df.where(lookback("t", 24, as_of)).count()
    assert kept == 1


def test_lookback_pushes_to_scan(spark, scratch):
    path = f"{scratch}/t"
    spark.createDataFrame([(dt.datetime(2024, 1, 29, 23, 0),)], "t timestamp_ntz").write.parquet(path)
    plan = spark.read.parquet(path).where(lookback("t", 24, dt.datetime(2024, 1, 30)))._jdf \
        .queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(t), GreaterThanOrEqual(t," in plan


def test_initcap_words_fallback_path_for_marker_char(spark):
    got = one(spark, [("a\x01 b-c",), ("x-y",)], "s string", initcap_words("s"))
    assert got == ["A\x01 B-C", "X-Y"]
