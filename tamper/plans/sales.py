"""Sales dashboard reports over the serving order table.

Everything is aggregated in Spark; only the small results leave the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamper.operators.aggregates import (count_by, exact_mean, histogram, money_sum,
                                         round_doubles, share_by, sum_by, top_k)


def sales_kpis(orders: DataFrame) -> DataFrame:
    """A1: orders, total sales, distinct customers, mean delay, mean order value."""
    return round_doubles(orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum("TOTAL_PRICE").alias("total_sales"),
        F.countDistinct("CUSTOMER_ID").alias("unique_customers"),
        exact_mean("DELIVERY_DELAY_DAYS").alias("avg_delivery_delay"),
        exact_mean("TOTAL_PRICE").alias("avg_order_value"),
    ))


def sales_histogram(orders: DataFrame, bins: int = 20) -> DataFrame:
    """A2: 20 equal-width bins of TOTAL_PRICE."""
    return round_doubles(histogram(orders, "TOTAL_PRICE", bins))


def sales_daily(orders: DataFrame) -> DataFrame:
    """A3: sales per purchase date."""
    return sum_by(orders.withColumn("PURCHASE_DATE", F.to_date("PURCHASE_TIME")),
                  "PURCHASE_DATE", "TOTAL_PRICE", "sales")


def top_products(orders: DataFrame, n: int = 10) -> DataFrame:
    """A4: the n items with the highest sales."""
    return top_k(sum_by(orders, "ITEM", "TOTAL_PRICE", "sales"), "ITEM", "sales", n)


def sales_by_bag(orders: DataFrame) -> DataFrame:
    """A5: sales per bag size, largest first."""
    return sum_by(orders, "BAG_SIZE", "TOTAL_PRICE", "sales").orderBy(F.col("sales").desc(), "BAG_SIZE")


def orders_by_origin(orders: DataFrame, n: int = 10) -> DataFrame:
    """The n origin countries with most orders."""
    return top_k(count_by(orders, "ORIGIN_COUNTRY"), "ORIGIN_COUNTRY", "n_orders", n)


def orders_by_region(orders: DataFrame) -> DataFrame:
    """Orders and share per region."""
    return round_doubles(share_by(orders, "REGION"))


def payment_methods(orders: DataFrame) -> DataFrame:
    """A8."""
    return count_by(orders, "PAYMENT_METHOD")


def payment_status(orders: DataFrame) -> DataFrame:
    """Orders and share per payment status."""
    return round_doubles(share_by(orders, "PAYMENT_STATUS"))


def shipping_methods(orders: DataFrame) -> DataFrame:
    """A10."""
    return count_by(orders, "SHIPPING_METHOD")


def delay_histogram(orders: DataFrame, bins: int = 20) -> DataFrame:
    """20 bins of DELIVERY_DELAY_DAYS (NULLs dropped)."""
    return round_doubles(histogram(orders, "DELIVERY_DELAY_DAYS", bins))


def delivery_status(orders: DataFrame) -> DataFrame:
    """A12."""
    return count_by(orders, "DELIVERY_STATUS")


# Category columns of the dashboard's count/sum charts.
CATEGORY_COLUMNS = ["BAG_SIZE", "ORIGIN_COUNTRY", "REGION", "PAYMENT_METHOD", "PAYMENT_STATUS",
                    "SHIPPING_METHOD", "DELIVERY_STATUS"]


def category_breakdown(orders: DataFrame, dims: list[str] | None = None) -> DataFrame:
    """Orders and sales per value of every category column in ONE pass:
    a GROUPING SETS aggregation (one scan, one partial-aggregated shuffle of a
    few rows per map task) instead of one scan per chart. Long format
    (dimension, value, n_orders, sales); NULL values are dropped per
    dimension, as in the per-chart reports. A5-A10 and A12 are row subsets of
    this result."""
    dims = dims or CATEGORY_COLUMNS
    g = (orders.select(*dims, "TOTAL_PRICE")
         .groupingSets([[d] for d in dims], *dims)
         .agg(F.count(F.lit(1)).alias("n_orders"), money_sum("TOTAL_PRICE").alias("sales"),
              *[F.grouping(d).alias(f"__g_{d}") for d in dims]))
    dim = F.coalesce(*[F.when(F.col(f"__g_{d}") == 0, F.lit(d)) for d in dims])
    val = F.coalesce(*[F.when(F.col(f"__g_{d}") == 0, F.col(d)) for d in dims])
    return (g.select(dim.alias("dimension"), val.alias("value"), "n_orders", "sales")
             .where(F.col("value").isNotNull()))
