"""Queries that apply the derived-column rules (G1-G21) to rows of the test tables.

The catalogue rules key on the shop's own item names, warehouse ids and
origins; test rows are mapped onto those values deterministically (item by
part key, warehouse by supplier key, ...) so that every rule is exercised on
every row of the tables, not on a fixed sample.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamper.functions import enrich
from tamper.functions import lookups as L
from tamper.functions.ids import uuid5_dns
from tamper.functions.text import initcap_words
from tamper.sources import testdata as TD


def _pick(values: list[str], idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def initcap_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 over every part name."""
    p = TD.table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_name", initcap_words("p_name").alias("ITEM"))


def uuid5_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: deterministic customer ids from customer names."""
    c = TD.table(spark, sf_dir, "customer")
    return c.select("c_custkey", "c_name", uuid5_dns("c_name").alias("CUSTOMER_UUID"))


def product_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: deterministic product ids from product names."""
    p = TD.table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_name", uuid5_dns("p_name").alias("PRODUCT_UUID"))


def catalog_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items mapped onto the product catalogue: item by part key (every
    other one upper-cased, as lookups must ignore case), bag size by part
    size, quantity, and the supplier nation as the given origin."""
    li = TD.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                    "l_suppkey", "l_quantity")
    p = TD.table(spark, sf_dir, "part").select("p_partkey", "p_size")
    s = TD.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = TD.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (li.join(p, li.l_partkey == p.p_partkey)
           .join(s, F.col("l_suppkey") == s.s_suppkey)
           .join(n, F.col("s_nationkey") == n.n_nationkey))
    items = list(L.PRICE_MAP)
    item = _pick(items, F.pmod(F.col("p_partkey"), F.lit(len(items))))
    return j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("TXID"),
        F.when(F.pmod(F.col("p_partkey"), F.lit(2)) == 0, item).otherwise(F.upper(item)).alias("ITEM"),
        F.when(F.col("p_size") <= 16, "250g").when(F.col("p_size") <= 33, "500g")
         .otherwise("1kg").alias("BAG_SIZE"),
        F.col("l_quantity").cast("int").alias("QUANTITY"),
        F.col("n_name").alias("ORIGIN_COUNTRY"),
    )


def price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit and total price, and origin, by catalogue item."""
    df = enrich.with_price(catalog_lines(spark, sf_dir))
    return enrich.with_origin(df)


def carbon_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G6, G11-G15 with the fixed country -> region table."""
    o = TD.orders_landing(spark, sf_dir).select("TXID", "COUNTRY", "WAREHOUSE", "BAG_SIZE",
                                                "SHIPPING_METHOD", "DELIVERY_STATUS", "QUANTITY")
    return enrich.with_carbon_score(o, keep_factors=True)


def warehouse_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G6 + G7: customers placed in the shop's regions by nation key, then
    assigned a warehouse; the US site alternates by customer key."""
    c = TD.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    regions = list(L.REGIONS)
    df = c.withColumn("REGION", _pick(regions, F.pmod(F.col("c_nationkey"), F.lit(len(regions)))))
    return enrich.assign_warehouse(df, "REGION", "c_custkey", "WAREHOUSE", "WAREHOUSE_COUNTRY",
                                   chooser=F.pmod(F.col("c_custkey"), F.lit(2)))


def emission_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items mapped onto the emission reports: warehouse id by supplier
    key, coffee origin by part key, method by line number."""
    li = TD.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                    "l_suppkey", "l_quantity")
    p = TD.table(spark, sf_dir, "part").select("p_partkey", "p_size")
    j = li.join(p, li.l_partkey == p.p_partkey)
    wids = list(L.EMISSION_WAREHOUSES)
    methods = list(L.SHIPPING_METHOD_FACTORS)
    return j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("RECORD_ID"),
        _pick(wids, F.pmod(F.col("l_suppkey"), F.lit(len(wids)))).alias("WAREHOUSE_ID"),
        _pick(L.COFFEE_ORIGINS, F.pmod(F.col("l_partkey"), F.lit(len(L.COFFEE_ORIGINS))))
         .alias("ORIGIN_COUNTRY"),
        _pick(methods, F.pmod(F.col("l_linenumber"), F.lit(len(methods)))).alias("SHIPPING_METHOD"),
        (F.col("l_quantity").cast("int") * 10).alias("SHIPMENTS_COUNT"),
        (F.lit(50) + F.lit(4) * F.col("p_size")).cast("decimal(10,2)").alias("AVG_BATCH_SIZE_KG"),
    )


def distance_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G19 + G20: warehouse by id, then Local / Regional / Intercontinental."""
    df = enrich.with_warehouse(emission_lines(spark, sf_dir))
    return enrich.with_distance_class(df).select(
        "RECORD_ID", "WAREHOUSE_ID", "WAREHOUSE_NAME", "WAREHOUSE_COUNTRY", "ORIGIN_COUNTRY",
        "DISTANCE_CLASS")


def estimated_emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The emission estimate of each report row."""
    df = enrich.with_distance_class(enrich.with_warehouse(emission_lines(spark, sf_dir)))
    return enrich.with_estimated_emissions(df).select(
        "RECORD_ID", "DISTANCE_CLASS", "SHIPPING_METHOD", "SHIPMENTS_COUNT", "AVG_BATCH_SIZE_KG",
        "ESTIMATED_EMISSIONS_KGCO2E")


def payment_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G17."""
    o = TD.orders_landing(spark, sf_dir).select("TXID", "DELIVERY_STATUS")
    return enrich.with_payment_status(o)


def delivery_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days from purchase to delivery."""
    o = TD.orders_landing(spark, sf_dir).select("TXID", "PURCHASE_TIME", "DELIVERED_DATE")
    return enrich.with_delay(o)


def rule_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G8, G9, G10, G16 as boolean columns per order line."""
    o = TD.orders_landing(spark, sf_dir)
    return o.select(
        "TXID",
        enrich.check_pickup("COUNTRY", enrich.order_warehouse_country("WAREHOUSE"),
                            "SHIPPING_METHOD").alias("PICKUP_OK"),
        enrich.check_transit_age("PURCHASE_TIME", "DELIVERY_STATUS", TD.ORDERS_AS_OF)
        .alias("TRANSIT_AGE_OK"),
        enrich.check_certification("ITEM", "FAIR_TRADE_CERTIFIED", "ORGANIC_CERTIFIED")
        .alias("CERTIFICATION_OK"),
        enrich.check_lifecycle("DELIVERY_STATUS", "SHIPPED_DATE", "DELIVERED_DATE")
        .alias("LIFECYCLE_OK"),
    )


# Countries of the shop's customers: those of the fixed regions, one warehouse country that
# is in no region, and one that nothing knows.
SHOP_COUNTRIES = [c for c, _ in L.country_region_pairs()] + ["Singapore", "Atlantis"]
STATUSES = ["Canceled", "In Transit", "Delivered", "Returned", "Lost"]
BAGS = ["250g", "500g", "1kg", "N/A"]
RULES_AS_OF = dt.date(1998, 9, 1)


def shop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as orders of the shop, from the line items alone: country by part key,
    warehouse by the country's region (G6, G7), flags and dates that keep and that break
    every rule."""
    li = TD.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                    "l_quantity", "l_shipdate")
    part, supp, order, day = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey"), F.to_date("l_shipdate")
    df = li.select(
        F.concat(order.cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"), F.lit("-"),
                 part.cast("string")).alias("TXID"),
        _pick(SHOP_COUNTRIES, F.pmod(part, F.lit(len(SHOP_COUNTRIES)))).alias("COUNTRY"),
        _pick(list(L.PRICE_MAP), F.pmod(part, F.lit(len(L.PRICE_MAP)))).alias("ITEM"),
        _pick(BAGS, F.pmod(supp, F.lit(len(BAGS)))).alias("BAG_SIZE"),
        _pick(["Standard", "Express", "EcoDelivery", "Local Pickup"], F.pmod("l_linenumber", F.lit(4))).alias("SHIPPING_METHOD"),
        _pick(STATUSES, F.pmod(order, F.lit(len(STATUSES)))).alias("DELIVERY_STATUS"),
        F.col("l_quantity").cast("int").alias("QUANTITY"),
        F.when(F.pmod(part, F.lit(5)) != 4, F.pmod(part, F.lit(3)) == 0).alias("FAIR_TRADE_CERTIFIED"),
        (F.pmod(supp, F.lit(4)) == 0).alias("ORGANIC_CERTIFIED"),
        F.date_sub(day, F.col("l_linenumber").cast("int")).alias("PURCHASE_TIME"),
        F.when(F.pmod(order, F.lit(7)) != 0, day).alias("SHIPPED_DATE"),
        F.when(F.pmod(supp, F.lit(3)) != 0, F.date_add(day, F.pmod(part, F.lit(45)).cast("int"))).alias("DELIVERED_DATE"),
        supp.alias("SUPPLIER"))
    df = enrich.with_region(df, "COUNTRY", "REGION")
    return enrich.assign_warehouse(df, "REGION", "TXID", "WAREHOUSE", "WAREHOUSE_COUNTRY",
                                   chooser=F.pmod(F.col("SUPPLIER"), F.lit(2)))


def carbon_score_shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G6, G7, G11-G15 over the shop's own countries: every factor occurs."""
    df = enrich.with_carbon_score(shop_orders(spark, sf_dir), keep_factors=True)
    return df.select("TXID", "COUNTRY", "REGION", "WAREHOUSE", "DISTANCE_FACTOR", "METHOD_FACTOR",
                     "SIZE_FACTOR", "STATUS_MULTIPLIER", "CARBON_SCORE")


def rule_checks_shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G8, G9, G10, G16 and G17, G18 over the shop's orders: every rule is kept by some
    and broken by others."""
    df = enrich.with_delay(enrich.with_payment_status(shop_orders(spark, sf_dir)))
    return df.select(
        "TXID", "PAYMENT_STATUS", "DELIVERY_DELAY_DAYS",
        enrich.check_pickup("COUNTRY", "WAREHOUSE_COUNTRY", "SHIPPING_METHOD").alias("PICKUP_OK"),
        enrich.check_transit_age("PURCHASE_TIME", "DELIVERY_STATUS", RULES_AS_OF).alias("TRANSIT_AGE_OK"),
        enrich.check_certification("ITEM", "FAIR_TRADE_CERTIFIED", "ORGANIC_CERTIFIED").alias("CERTIFICATION_OK"),
        enrich.check_lifecycle("DELIVERY_STATUS", "SHIPPED_DATE", "DELIVERED_DATE").alias("LIFECYCLE_OK"))


def distance_class_shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G19 with origins that are warehouse countries too: all three classes occur."""
    origins = [*L.COFFEE_ORIGINS, "United States", "France", "Singapore"]
    li = TD.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    wids = list(L.EMISSION_WAREHOUSES)
    df = li.select("l_orderkey", "l_linenumber", "l_partkey",
                   _pick(wids, F.pmod(F.col("l_suppkey"), F.lit(len(wids)))).alias("WAREHOUSE_ID"),
                   _pick(origins, F.pmod(F.col("l_partkey"), F.lit(len(origins)))).alias("ORIGIN_COUNTRY"))
    return enrich.with_distance_class(enrich.with_warehouse(df)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "WAREHOUSE_ID", "WAREHOUSE_COUNTRY", "ORIGIN_COUNTRY",
        "DISTANCE_CLASS")
