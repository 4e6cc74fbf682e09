"""Emission dashboard reports over the serving emission table.

All reports take the output of ``filter_in`` (C6); with no filter given they
see every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamper.operators.aggregates import money_sum, round_doubles, sum_by, with_share
from tamper.operators.clean import filter_in

E = "ESTIMATED_EMISSIONS_KGCO2E"


def emissions_filtered(df: DataFrame, warehouses: list | None = None,
                       distance_classes: list | None = None) -> DataFrame:
    """The rows selected by the warehouse and distance-class filters."""
    return filter_in(df, {"WAREHOUSE_NAME": warehouses, "DISTANCE_CLASS": distance_classes})


def ratio(num: str, den: str) -> F.Column:
    """Row ratio as DOUBLE; a zero or NULL denominator gives NULL (skipped by
    the aggregates) instead of an error or infinity."""
    return F.try_divide(F.col(num).cast("double"), F.col(den).cast("double"))


def emissions_kpis(df: DataFrame) -> DataFrame:
    """Total emissions and the mean of per-row emissions / shipments."""
    return round_doubles(df.agg(
        money_sum(E).alias("total_emissions"),
        F.avg(ratio(E, "SHIPMENTS_COUNT")).alias("avg_emissions_per_shipment"),
    ))


def emissions_monthly(df: DataFrame) -> DataFrame:
    """E2."""
    return sum_by(df, "REPORTING_MONTH", E, "emissions")


def emissions_by_warehouse(df: DataFrame) -> DataFrame:
    """E3."""
    return sum_by(df, "WAREHOUSE_NAME", E, "emissions")


def emissions_per_kg(df: DataFrame) -> DataFrame:
    """Per shipping method and warehouse, the sum of per-row
    emissions / average batch kg (the height of each stacked bar)."""
    return round_doubles(
        df.where(F.col("SHIPPING_METHOD").isNotNull() & F.col("WAREHOUSE_NAME").isNotNull())
          .groupBy("SHIPPING_METHOD", "WAREHOUSE_NAME")
          .agg(F.coalesce(F.sum(ratio(E, "AVG_BATCH_SIZE_KG")), F.lit(0.0)).alias("emissions_per_kg")))


def emissions_by_origin(df: DataFrame) -> DataFrame:
    """E5: per origin country, largest total first."""
    return sum_by(df, "ORIGIN_COUNTRY", E, "emissions").orderBy(F.col("emissions").desc(),
                                                                 "ORIGIN_COUNTRY")


def emissions_by_distance(df: DataFrame) -> DataFrame:
    """Total and share per distance class."""
    return round_doubles(with_share(sum_by(df, "DISTANCE_CLASS", E, "emissions"), "emissions"))


# Category columns of the emission charts.
CATEGORY_COLUMNS = ["REPORTING_MONTH", "WAREHOUSE_NAME", "ORIGIN_COUNTRY", "DISTANCE_CLASS"]


def emissions_breakdown(df: DataFrame, dims: list[str] | None = None) -> DataFrame:
    """Total emissions per value of every chart dimension in ONE pass (GROUPING
    SETS): one scan instead of one per chart. Long format (dimension, value as
    text, emissions); NULL values dropped per dimension."""
    dims = dims or CATEGORY_COLUMNS
    g = (df.select(*dims, E)
         .groupingSets([[d] for d in dims], *dims)
         .agg(money_sum(E).alias("emissions"), *[F.grouping(d).alias(f"__g_{d}") for d in dims]))
    dim = F.coalesce(*[F.when(F.col(f"__g_{d}") == 0, F.lit(d)) for d in dims])
    val = F.coalesce(*[F.when(F.col(f"__g_{d}") == 0, F.col(d).cast("string")) for d in dims])
    return (g.select(dim.alias("dimension"), val.alias("value"), "emissions")
             .where(F.col("value").isNotNull()))
