"""Order, emission and run-log tables derived from the TPC-H-like test tables.

The landing records of the pipeline (orders, emission reports, job runs) are
rebuilt from ``lineitem``/``orders``/``part``/... and ``events`` with the rules
of FIXTURES.md section 4, so every query's work grows with the test tables.
Joins carry no hints: the fact tables shuffle on their keys, and Spark
broadcasts the dimensions (nation, region, supplier at small scale) only when
their measured size is under the broadcast threshold.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamper.functions import enrich
from tamper.functions.time import first_of_month
from tamper.schemas import BATCH_COLUMN, EMISSION_SCHEMA, ORDER_SCHEMA, SEQ_COLUMNS, conform

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# Fixed "now" of the test views (see FIXTURES.md section 4).
ORDERS_AS_OF = dt.date(2001, 1, 1)
RUNS_AS_OF = dt.datetime(2024, 1, 30, 0, 0, 0)
LOOKBACK_HOURS = 24

# FIXED VALUES: names used by the run-log views built from ``events``.
TASK_NAMES = [
    "task_clean_orders",
    "task_clean_emissions",
    "task_gold_orders",
    "task_gold_emissions",
    "task_copy_gold_orders_to_serve",
    "task_copy_gold_emissions_to_serving",
]
SCHEMA_NAMES = ["RAW", "SILVER", "GOLD"]
PIPE_NAMES = ["ORDERS_PIPE", "EMISSIONS_PIPE", "RETURNS_PIPE"]
LOAD_TABLES = ["RAW_ORDERS", "RAW_EMISSIONS", "SILVER_ORDERS"]
WAREHOUSE_NAMES = ["PIPELINE_WH", "ANALYTICS_WH", "ADHOC_WH"]
DATABASE_NAME = "COFFEE_DWH"


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. The DataFrame is reused per session and path: each
    ``read.parquet`` lists files and reads footers on the driver, and the
    test tables are read-only."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _pick(names: list[str], idx) -> F.Column:
    """names[idx] for a 0-based integer column (a literal array lookup)."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), (idx + 1).cast("int"))


def country_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country -> region dimension of the test data (nation joined to region)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("country"), F.col("r_name").alias("region"))


def _shipping_method(linenumber) -> F.Column:
    m = F.pmod(linenumber, F.lit(4))
    return (F.when(m == 0, "Standard").when(m == 1, "Express")
            .when(m == 2, "EcoDelivery").otherwise("Local Pickup"))


def orders_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records as they land (31 table columns + INGEST_TS, SEQ1, SEQ2,
    BATCH_ID). PAYMENT_STATUS and CARBON_SCORE are derived by G17 and G15."""
    # Fact rows shuffle for the orders and for the parts: they carry keys and numbers of the
    # table's types there, the names of nations and regions come after.
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_quantity").cast("int").alias("l_quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("l_extendedprice"),
        "l_returnflag", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              F.to_date("o_orderdate").alias("o_orderdate"),
                                              "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    p = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_size", F.col("p_retailprice").cast("decimal(10,2)").alias("p_retailprice"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    cn = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cn_name"),
        F.col("n_regionkey").alias("cn_region"))
    sn = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name"))
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    bought = o.join(c, F.col("o_custkey") == c.c_custkey).drop("c_custkey")
    j = (li.join(bought, li.l_orderkey == F.col("o_orderkey"))
           .join(p, F.col("l_partkey") == p.p_partkey)
           .join(s, F.col("l_suppkey") == s.s_suppkey)
           .join(cn, F.col("c_nationkey") == F.col("cn_key"))
           .join(r, F.col("cn_region") == r.r_regionkey)
           .join(sn, F.col("s_nationkey") == F.col("sn_key")))

    qty = F.col("l_quantity")
    purchase = F.col("o_orderdate")
    ship_off = F.pmod(F.col("l_linenumber"), F.lit(4))
    canceled = F.col("l_returnflag") == "A"
    pending = F.col("o_orderstatus") == "P"
    df = j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("TXID"),
        F.concat(F.lit("RF-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string"), F.lit("-"),
                 F.col("l_suppkey").cast("string")).alias("RFID"),
        F.concat(F.lit("C-"), F.col("o_custkey").cast("string")).alias("CUSTOMER_ID"),
        F.concat(F.lit("P-"), F.col("p_partkey").cast("string")).alias("PRODUCT_ID"),
        F.upper("p_name").alias("ITEM"),
        F.when(F.col("p_size") <= 16, "250g").when(F.col("p_size") <= 33, "500g")
         .otherwise("1kg").alias("BAG_SIZE"),
        F.col("p_retailprice").alias("UNIT_PRICE"),
        qty.alias("QUANTITY"),
        F.col("l_extendedprice").alias("TOTAL_PRICE"),
        F.col("sn_name").alias("ORIGIN_COUNTRY"),
        purchase.alias("PURCHASE_TIME"),
        F.when(~canceled, F.date_add(purchase, ship_off)).alias("SHIPPED_DATE"),
        F.when(~(canceled | pending),
               F.date_add(purchase, ship_off + F.pmod(qty, F.lit(20)) + 1)).alias("DELIVERED_DATE"),
        F.col("r_name").alias("REGION"),
        F.col("cn_name").alias("COUNTRY"),
        F.when(F.col("r_name") == "AMERICA", "West Coast USA")
         .when(F.col("r_name").isin("EUROPE", "AFRICA"), "Paris")
         .otherwise("Singapore").alias("WAREHOUSE"),
        _shipping_method(F.col("l_linenumber")).alias("SHIPPING_METHOD"),
        F.when(canceled, "Canceled").when(pending, "In Transit")
         .when(F.col("l_returnflag") == "R", "Returned").otherwise("Delivered")
         .alias("DELIVERY_STATUS"),
        F.col("o_orderpriority").alias("PAYMENT_METHOD"),
        F.when(~(canceled | pending), ship_off + F.pmod(qty, F.lit(20)) + 1)
         .cast("int").alias("DELIVERY_DELAY_DAYS"),
        F.col("l_shipdate").alias("INGEST_TS"),
        F.col("l_partkey").alias("SEQ1"),
        F.col("l_suppkey").alias("SEQ2"),
    )
    df = enrich.with_payment_status(df)
    df = enrich.with_carbon_score(df, regions=country_regions(spark, sf_dir))
    df = df.withColumn(BATCH_COLUMN, F.pmod(F.month("INGEST_TS"), F.lit(2)))
    return conform(df, ORDER_SCHEMA, SEQ_COLUMNS + [BATCH_COLUMN])


def emissions_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emission reports as they land (13 table columns + INGEST_TS, SEQ1,
    SEQ2, BATCH_ID)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_quantity").cast("int").alias("l_quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("l_extendedprice"),
        F.col("l_discount").cast("decimal(4,2)").alias("l_discount"), "l_shipdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (li.join(p, li.l_partkey == p.p_partkey)
           .join(s, F.col("l_suppkey") == s.s_suppkey)
           .join(n, F.col("s_nationkey") == n.n_nationkey))
    dclass = F.pmod(F.col("l_linenumber"), F.lit(3))
    est = F.col("l_extendedprice") * (F.col("l_discount") - F.lit(0.02).cast("decimal(4,2)"))
    df = j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("RECORD_ID"),
        first_of_month("l_shipdate").alias("REPORTING_MONTH"),
        F.concat(F.lit("W"), F.pmod(F.col("l_suppkey"), F.lit(4)).cast("string")).alias("WAREHOUSE_ID"),
        F.col("n_name").alias("WAREHOUSE_NAME"),
        F.col("n_name").alias("ORIGIN_COUNTRY"),
        F.when(dclass == 0, "Local").when(dclass == 1, "Regional")
         .otherwise("Intercontinental").alias("DISTANCE_CLASS"),
        _shipping_method(F.col("l_linenumber")).alias("SHIPPING_METHOD"),
        (F.col("l_quantity") - 1).alias("SHIPMENTS_COUNT"),
        (F.lit(50) + F.lit(4) * F.col("p_size")).cast("decimal(10,2)").alias("AVG_BATCH_SIZE_KG"),
        est.cast("decimal(12,2)").alias("ESTIMATED_EMISSIONS_KGCO2E"),
        F.col("l_shipdate").alias("INGEST_TS"),
        F.col("l_partkey").alias("SEQ1"),
        F.col("l_suppkey").alias("SEQ2"),
        F.pmod(F.month("l_shipdate"), F.lit(2)).alias(BATCH_COLUMN),
    )
    return conform(df, EMISSION_SCHEMA, SEQ_COLUMNS + [BATCH_COLUMN])


# ---------------------------------------------------------------- run logs
def _completed(ts: str, seconds: str) -> F.Column:
    return F.col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                          F.col(seconds).cast("decimal(18,6)"))


def task_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job-run history (NAME, DATABASE_NAME, SCHEMA_NAME, STATE,
    QUERY_START_TIME, COMPLETED_TIME, ERROR_CODE, ERROR_MESSAGE)."""
    e = table(spark, sf_dir, "events")
    err = F.col("event_type") == "error"
    return e.select(
        F.col("event_id").alias("RUN_ID"),
        _pick(TASK_NAMES, F.pmod(F.col("user_id"), F.lit(6))).alias("NAME"),
        F.lit(DATABASE_NAME).alias("DATABASE_NAME"),
        _pick(SCHEMA_NAMES, F.pmod(F.col("user_id"), F.lit(3))).alias("SCHEMA_NAME"),
        F.when(err, "FAILED").when(F.col("event_type") == "signup", "SKIPPED")
         .otherwise("SUCCEEDED").alias("STATE"),
        F.col("ts").alias("QUERY_START_TIME"),
        _completed("ts", "value").alias("COMPLETED_TIME"),
        F.when(err, F.concat(F.lit("E"), F.pmod(F.col("user_id"), F.lit(10)).cast("string")))
         .alias("ERROR_CODE"),
        F.when(err, F.col("props")).alias("ERROR_MESSAGE"),
    )


def query_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query history (QUERY_ID, USER_NAME, ERROR_CODE, ERROR_MESSAGE,
    START_TIME, TOTAL_ELAPSED_TIME in ms)."""
    e = table(spark, sf_dir, "events")
    err = F.col("event_type") == "error"
    return e.select(
        F.col("event_id").alias("QUERY_ID"),
        F.concat(F.lit("user_"), F.pmod(F.col("user_id"), F.lit(10)).cast("string")).alias("USER_NAME"),
        F.when(err, F.concat(F.lit("E"), F.pmod(F.col("user_id"), F.lit(10)).cast("string")))
         .alias("ERROR_CODE"),
        F.when(err, F.col("props")).alias("ERROR_MESSAGE"),
        F.col("ts").alias("START_TIME"),
        F.round(F.col("value") * 1000).cast("long").alias("TOTAL_ELAPSED_TIME"),
    )


def ingest_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per pipe and hour: bytes, files and errors (PIPE_NAME, START_TIME,
    BYTES_INSERTED, FILES_INSERTED, ERROR_COUNT)."""
    e = table(spark, sf_dir, "events")
    return (e.select(_pick(PIPE_NAMES, F.pmod(F.col("user_id"), F.lit(3))).alias("PIPE_NAME"),
                     F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("START_TIME"),
                     F.round(F.col("value") * 1000).cast("long").alias("__bytes"),
                     (F.col("event_type") == "error").alias("__err"))
            .groupBy("PIPE_NAME", "START_TIME")
            .agg(F.sum("__bytes").alias("BYTES_INSERTED"),
                 F.count(F.lit(1)).alias("FILES_INSERTED"),
                 F.count_if("__err").alias("ERROR_COUNT")))


def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per loaded file (TABLE_NAME, FILE_NAME, LAST_LOAD_TIME,
    ROW_COUNT, FIRST_ERROR_MESSAGE)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        _pick(LOAD_TABLES, F.pmod(F.col("user_id"), F.lit(3))).alias("TABLE_NAME"),
        F.concat(F.lit("batch_"), F.col("event_id").cast("string"), F.lit(".parquet")).alias("FILE_NAME"),
        F.col("ts").alias("LAST_LOAD_TIME"),
        F.col("user_id").alias("ROW_COUNT"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("FIRST_ERROR_MESSAGE"),
    )


def compute_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compute-cluster load samples (TIME_RANGE_START, WAREHOUSE_NAME,
    QUEUED_LOAD_PERCENT, BLOCKED_PERCENT, RUNNING)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("TIME_RANGE_START"),
        _pick(WAREHOUSE_NAMES, F.pmod(F.col("user_id"), F.lit(3))).alias("WAREHOUSE_NAME"),
        (F.col("value") / 10.0).alias("QUEUED_LOAD_PERCENT"),
        F.pmod(F.col("user_id"), F.lit(5)).cast("double").alias("BLOCKED_PERCENT"),
        (F.col("value") / 100.0).alias("RUNNING"),
    )
