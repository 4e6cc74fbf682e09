"""One stored snapshot for all reports of a run.

The dashboards read whole tables and keep them for a minute. ``Reports`` materialises the
serving table of an entity once for each version and hands it to every report; the landing
work below it runs once, not once a report. A snapshot lives in the shared folder, so it
survives lost executors, and reports read only the columns they need of it.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamper.plans import sales
from tamper.plans.layers import written

TTL_SECONDS = 60  # the dashboards' refresh interval


class Reports:
    """``sources``: entity -> function that builds its serving table. ``version`` (a batch
    id, a date, ...) names the state that a run wants to see: one version is built once,
    however long the run. Without a version a snapshot is used for ``ttl`` seconds."""

    def __init__(self, sources: dict[str, Callable[[], DataFrame]], ttl: float = TTL_SECONDS,
                 clock: Callable[[], float] = time.monotonic):
        self.sources, self.ttl, self.clock = sources, ttl, clock
        self.stored: dict[tuple, tuple[float, DataFrame]] = {}

    def table(self, entity: str, version=None) -> DataFrame:
        key, now = (entity, version), self.clock()
        built, df = self.stored.get(key, (None, None))
        if df is None or (version is None and now - built >= self.ttl):
            df = written(self.sources[entity](), f"report_{entity}")
            self.stored[key] = (now, df)
        return df


#: Report -> (function, key column, count column, amount column).
SALES = {
    "sales_daily": (sales.sales_daily, "PURCHASE_DATE", None, "sales"),
    "top_products": (sales.top_products, "ITEM", None, "sales"),
    "sales_by_bag": (sales.sales_by_bag, "BAG_SIZE", None, "sales"),
    "orders_by_origin": (sales.orders_by_origin, "ORIGIN_COUNTRY", "n_orders", None),
    "orders_by_region": (sales.orders_by_region, "REGION", "n_orders", "share_pct"),
    "payment_methods": (sales.payment_methods, "PAYMENT_METHOD", "n_orders", None),
    "payment_status": (sales.payment_status, "PAYMENT_STATUS", "n_orders", "share_pct"),
    "shipping_methods": (sales.shipping_methods, "SHIPPING_METHOD", "n_orders", None),
    "delivery_status": (sales.delivery_status, "DELIVERY_STATUS", "n_orders", None),
    "sales_histogram": (sales.sales_histogram, "bin", "n_rows", "bin_start"),
    "delay_histogram": (sales.delay_histogram, "bin", "n_rows", "bin_start"),
    "sales_kpis": (sales.sales_kpis, None, "total_orders", "total_sales"),
}


def sales_dashboard(orders: DataFrame) -> DataFrame:
    """A1-A12 of one serving snapshot as (report, key, n, amount) rows."""
    out = None
    for name, (fn, key, count, amount) in SALES.items():
        df = fn(orders)
        rows = df.select(
            F.lit(name).alias("report"),
            (F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"),
            (F.col(count) if count else F.lit(None)).cast("long").alias("n"),
            (F.col(amount) if amount else F.lit(None)).cast("double").alias("amount"))
        out = rows if out is None else out.unionByName(rows)
    return out
