"""Data-quality checks (Q1-Q4).

Each entity is measured in one pass (a single aggregate with several
conditional counts); the report unpivots the one-row results into
(check, value, status, metric) rows, so it always has its six rows, also for
empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamper.functions.text import percent_text
from tamper.functions.time import date_literal, ts_literal
from tamper.schemas import BATCH_COLUMN

NULL_RATE_LIMIT = 5.0  # percent; a rate passes when strictly below


def dq_orders(df: DataFrame, as_of, approx: bool = False) -> DataFrame:
    """Q1: rows, NULL customers, NULL keys, distinct keys, future purchases.

    The exact distinct count shuffles every key once; with ``approx`` it is a
    HyperLogLog sketch (fixed memory per task, about 1 % error), for
    monitoring very large tables where an estimate is enough."""
    distinct = (F.approx_count_distinct("TXID", rsd=0.01) if approx
                else F.countDistinct("TXID"))
    return df.agg(
        F.count(F.lit(1)).alias("N"),
        F.count_if(F.col("CUSTOMER_ID").isNull()).alias("N_NULL_CUSTOMER"),
        F.count_if(F.col("TXID").isNull()).alias("N_NULL_TXID"),
        distinct.alias("N_DISTINCT_TXID"),
        F.count_if(F.col("PURCHASE_TIME").cast("timestamp_ntz") > ts_literal(as_of))
         .alias("N_FUTURE_PURCHASES"),
    )


SKETCH_LGK = 14  # 2^14 registers: a sketch of at most 16 KB, a standard error of 0.8 %


def key_sketches(df: DataFrame, as_of, batch_col: str = BATCH_COLUMN) -> DataFrame:
    """The order checks of each batch in a form that can be merged: counts, and the
    different keys as a HyperLogLog sketch. Stored once a batch, a report over any number
    of batches adds them up (``dq_orders_merged``) and reads no order again."""
    return df.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("N"),
        F.count_if(F.col("CUSTOMER_ID").isNull()).alias("N_NULL_CUSTOMER"),
        F.count_if(F.col("TXID").isNull()).alias("N_NULL_TXID"),
        F.hll_sketch_agg("TXID", SKETCH_LGK).alias("KEYS"),
        F.count_if(F.col("PURCHASE_TIME").cast("timestamp_ntz") > ts_literal(as_of))
         .alias("N_FUTURE_PURCHASES"))


def dq_orders_merged(sketches: DataFrame) -> DataFrame:
    """Q1 from stored batch sketches: all counts are exact but N_DISTINCT_TXID, which is
    an estimate. A few KB a batch are read and no key is shuffled."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("N", "N_NULL_CUSTOMER", "N_NULL_TXID")]
    return sketches.agg(*sums, F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("KEYS")), F.lit(0))
                        .alias("N_DISTINCT_TXID"),
                        F.coalesce(F.sum("N_FUTURE_PURCHASES"), F.lit(0)).alias("N_FUTURE_PURCHASES"))


def dq_emissions(df: DataFrame, as_of) -> DataFrame:
    """Q2: rows, negative estimates, reporting months after the ``as_of`` date."""
    return df.agg(
        F.count(F.lit(1)).alias("N"),
        F.count_if(F.col("ESTIMATED_EMISSIONS_KGCO2E") < 0).alias("N_NEGATIVE"),
        F.count_if(F.col("REPORTING_MONTH") > date_literal(as_of)).alias("N_FUTURE_REPORTS"),
    )


def _rate_check(name: str, count: str, total: F.Column) -> F.Column:
    rate = F.col(count).cast("double") * 100.0 / total
    return F.struct(F.lit(name).alias("check"), percent_text(rate).alias("value"),
                    F.when(rate < NULL_RATE_LIMIT, "PASS").otherwise("FAIL").alias("status"),
                    rate.alias("metric"))


def _zero_check(name: str, value: F.Column) -> F.Column:
    return F.struct(F.lit(name).alias("check"), value.cast("string").alias("value"),
                    F.when(value == 0, "PASS").otherwise("FAIL").alias("status"),
                    value.cast("double").alias("metric"))


def dq_report(orders: DataFrame, emissions: DataFrame, as_of, approx: bool = False) -> DataFrame:
    """Q3/Q4: six checks. Rates divide by ``max(N, 1)``; duplicates are
    ``N - distinct keys`` (a NULL key counts as a duplicate; 0 for an empty
    table)."""
    o = dq_orders(orders, as_of, approx)
    total = F.greatest(F.col("N"), F.lit(1)).cast("double")
    o_rows = o.select(F.explode(F.array(
        _rate_check("Null rate CUSTOMER_ID", "N_NULL_CUSTOMER", total),
        _rate_check("Null rate TXID", "N_NULL_TXID", total),
        _zero_check("Duplicate TXID count", F.col("N") - F.col("N_DISTINCT_TXID")),
        _zero_check("Future PURCHASE_TIME", F.col("N_FUTURE_PURCHASES")),
    )).alias("r"))
    e = dq_emissions(emissions, as_of)
    e_rows = e.select(F.explode(F.array(
        _zero_check("Negative ESTIMATED_EMISSIONS_KGCO2E", F.col("N_NEGATIVE")),
        _zero_check("Future REPORTING_MONTH", F.col("N_FUTURE_REPORTS")),
    )).alias("r"))
    return (o_rows.unionByName(e_rows)
            .select("r.check", "r.value", "r.status", F.round("r.metric", 6).alias("metric")))
