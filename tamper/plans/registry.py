"""Named queries over a test-data folder: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamper.operators.merge import DEFAULT_BROADCAST_BYTES
from tamper.plans import (emissions, enrichment, layers, loads, monitoring, quality, reports,
                          sales)
from tamper.schemas import BATCH_COLUMN
from tamper.session import apply_session_defaults
from tamper.sources import testdata as TD

Query = Callable[[SparkSession, str], DataFrame]


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_session_defaults(spark)
    return TD.orders_landing(spark, sf_dir)


def raw_emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_session_defaults(spark)
    return TD.emissions_landing(spark, sf_dir)


def serving_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving order table after one pipeline run over all landed rows."""
    return layers.silver_snapshot("orders", raw_orders(spark, sf_dir), TD.ORDERS_AS_OF)


def serving_emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.silver_snapshot("emissions", raw_emissions(spark, sf_dir))


def _on_orders(fn) -> Query:
    return lambda spark, sf_dir: fn(serving_orders(spark, sf_dir))


def _on_emissions(fn) -> Query:
    return lambda spark, sf_dir: fn(serving_emissions(spark, sf_dir))


def _on_runs(fn, hours: int = TD.LOOKBACK_HOURS) -> Query:
    """``fn`` over the job runs completed in the look-back window."""
    def q(spark, sf_dir):
        apply_session_defaults(spark)
        return fn(monitoring.task_history(TD.task_runs(spark, sf_dir), hours, TD.RUNS_AS_OF))
    return q


def _layers(spark, sf_dir):
    raw_o, raw_e = raw_orders(spark, sf_dir), raw_emissions(spark, sf_dir)
    silver_o = layers.silver_snapshot("orders", raw_o, TD.ORDERS_AS_OF)
    silver_e = layers.silver_snapshot("emissions", raw_e)
    return [("RAW", "RAW_ORDERS", raw_o), ("RAW", "RAW_EMISSIONS", raw_e),
            ("SILVER", "SILVER_ORDERS", silver_o), ("SILVER", "SILVER_EMISSIONS", silver_e),
            ("GOLD", "GOLD_ORDERS", layers.fold_two_batches("orders", raw_o, TD.ORDERS_AS_OF, by_column=True)),
            ("GOLD", "GOLD_EMISSIONS", layers.fold_two_batches("emissions", raw_e, by_column=True))]


def freshness(spark, sf_dir):
    return monitoring.freshness([t for t in _layers(spark, sf_dir) if t[0] == "RAW"],
                                TD.ORDERS_AS_OF)


def freshness_all(spark, sf_dir):
    """RAW, SILVER, and GOLD after the merges of all batches."""
    return monitoring.freshness(_layers(spark, sf_dir), TD.ORDERS_AS_OF)


def freshness_stored(spark, sf_dir):
    """R1 over stored layers, from file statistics; GOLD is one batch behind. RAW is stored in
    buckets of the key: the W1 of SILVER and that of GOLD read them and shuffle no row."""
    from tamper.operators import buckets
    from tamper.session import scratch_path

    path = scratch_path(spark, "fresh_raw")
    raw = buckets.stored(raw_orders(spark, sf_dir), path, layers.ENTITIES["orders"]["key"])
    tables = [("RAW", "RAW_ORDERS", path)]
    for layer, rows in (("SILVER", raw), ("GOLD", raw.where(F.col(BATCH_COLUMN) == 0))):
        path = scratch_path(spark, f"fresh_{layer.lower()}")
        layers.silver_snapshot("orders", rows, TD.ORDERS_AS_OF).write.option("compression", buckets.CODEC).parquet(path)
        tables.append((layer, f"{layer}_ORDERS", path))
    return monitoring.stored_freshness(spark, tables, TD.ORDERS_AS_OF).drop("last_load_time")


def dq_orders_sketched(spark, sf_dir):
    """Q1 from batch sketches beside the exact form: whether the estimate of the different
    keys is within 3 %."""
    raw = raw_orders(spark, sf_dir)
    merged = quality.dq_orders_merged(layers.written(quality.key_sketches(raw, TD.ORDERS_AS_OF), "key_sketches"))
    exact = quality.dq_orders(raw, TD.ORDERS_AS_OF).select(F.col("N_DISTINCT_TXID").alias("exact")).scalar()
    off = F.abs(F.col("N_DISTINCT_TXID") - F.col("exact"))
    return merged.withColumn("exact", exact).select(
        "N", "N_NULL_CUSTOMER", "N_NULL_TXID", F.col("exact").alias("N_DISTINCT_TXID"), "N_FUTURE_PURCHASES",
        (off <= F.lit(0.03) * F.col("exact")).alias("ESTIMATE_OK"))


def sales_dashboard(spark, sf_dir):
    """A1-A12 from one stored serving snapshot: the landing work runs once."""
    session = reports.Reports({"orders": lambda: serving_orders(spark, sf_dir)})
    return reports.sales_dashboard(session.table("orders", version=sf_dir))


def warehouse_choices(spark, sf_dir):
    """The choices of the warehouse filter."""
    from tamper.operators.clean import distinct_values

    return distinct_values(serving_emissions(spark, sf_dir), "WAREHOUSE_NAME")


def query_errors(spark, sf_dir):
    apply_session_defaults(spark)
    return monitoring.query_errors(TD.query_runs(spark, sf_dir), TD.LOOKBACK_HOURS, TD.RUNS_AS_OF)


def ingest_throughput(spark, sf_dir):
    apply_session_defaults(spark)
    return monitoring.ingest_throughput(TD.ingest_usage(spark, sf_dir), TD.PIPE_NAMES[:2],
                                        TD.LOOKBACK_HOURS, TD.RUNS_AS_OF)


def load_errors(spark, sf_dir):
    apply_session_defaults(spark)
    return monitoring.load_errors(TD.load_history(spark, sf_dir), TD.LOOKBACK_HOURS,
                                  TD.RUNS_AS_OF, TD.LOAD_TABLES)


def cluster_load(spark, sf_dir):
    apply_session_defaults(spark)
    return monitoring.cluster_load(TD.compute_load(spark, sf_dir), TD.WAREHOUSE_NAMES[0],
                                   TD.LOOKBACK_HOURS, TD.RUNS_AS_OF)


def dq_orders(spark, sf_dir):
    return quality.dq_orders(serving_orders(spark, sf_dir), TD.ORDERS_AS_OF)


def dq_orders_raw(spark, sf_dir):
    return quality.dq_orders(raw_orders(spark, sf_dir), TD.ORDERS_AS_OF)


def dq_emissions(spark, sf_dir):
    return quality.dq_emissions(serving_emissions(spark, sf_dir), TD.ORDERS_AS_OF)


def dq_emissions_raw(spark, sf_dir):
    return quality.dq_emissions(raw_emissions(spark, sf_dir), TD.ORDERS_AS_OF)


def dq_report(spark, sf_dir):
    return quality.dq_report(serving_orders(spark, sf_dir), serving_emissions(spark, sf_dir),
                             TD.ORDERS_AS_OF)


# E7's fixed selection: two distance classes and every supplier nation with an
# even key (NULL included, as the multiselect lists a column's NULL too).
E7_CLASSES = ["Regional", "Intercontinental"]
E7_WAREHOUSES = [f"NATION_{i}" for i in range(0, 25, 2)] + [None]


def emissions_filtered(spark, sf_dir):
    return emissions.emissions_filtered(serving_emissions(spark, sf_dir), E7_WAREHOUSES,
                                        E7_CLASSES)


def _merge(fn, entity):
    def q(spark, sf_dir):
        raw = raw_orders(spark, sf_dir) if entity == "orders" else raw_emissions(spark, sf_dir)
        return fn(entity, raw, TD.ORDERS_AS_OF if entity == "orders" else None)
    return q


def broadcast_upsert(entity, raw, as_of=None):
    """U1 with the measured source broadcast to the target's scan."""
    return layers.upsert_two_batches(entity, raw, as_of,
                                     broadcast_bytes=DEFAULT_BROADCAST_BYTES)


def stream_pipeline(spark, sf_dir):
    return loads.streamed(spark, sf_dir)[1]


def stream_pipeline_limited(spark, sf_dir):
    """The same, two files a micro-batch: a RAW batch spans several micro-batches."""
    return loads.streamed(spark, sf_dir, max_files_per_trigger=2)[1]


def stream_pipeline_emissions(spark, sf_dir):
    return loads.streamed(spark, sf_dir, "emissions")[1]


def _landed(entity: str, spark, sf_dir):
    from tamper.schemas import SCHEMAS

    raw = raw_orders(spark, sf_dir) if entity == "orders" else raw_emissions(spark, sf_dir)
    return raw.select(*SCHEMAS[entity].names)


def _ingest_json(entity: str) -> Query:
    """S1-S6/S12 + C0: land the rows as JSON lines, read them back with the landing
    schema, keep the rows that pass the checks."""
    def q(spark, sf_dir):
        from tamper.session import scratch_path
        from tamper.sources import ingest

        df = _landed(entity, spark, sf_dir)
        if entity == "emissions":  # a required key; the test warehouses are named by country
            df = df.withColumn("WAREHOUSE_COUNTRY", F.col("WAREHOUSE_NAME"))
        folder = ingest.land_json(df, scratch_path(spark, "landing"), entity, "batch")
        return ingest.to_raw(ingest.read_json(spark, folder, entity), entity, keep=())[0]
    return q


def _staged(entity: str, spark, sf_dir, broken: bool = False):
    """The landed rows staged as Parquet of other physical types. ``broken``: every
    seventh quantity of an order is not a whole number, every eleventh price has more
    digits than the column, every thirteenth purchase date does not parse."""
    from tamper.session import scratch_path
    from tamper.sources import ingest

    df = _landed(entity, spark, sf_dir)
    df = df.select(*[F.col(f.name).cast(loads.STAGED_TYPES.get(f.dataType.typeName(), f.dataType))
                     .alias(f.name) for f in df.schema.fields])
    if broken:
        n = F.regexp_replace("TXID", "[^0-9]", "").cast("decimal(38,0)")
        df = df.withColumns({
            "QUANTITY": F.when(n % 7 == 0, F.col("QUANTITY").cast("double") + F.lit(0.5))
                         .otherwise(F.col("QUANTITY").cast("double")),
            "UNIT_PRICE": F.when(n % 11 == 0, F.lit(1e12)).otherwise(F.col("UNIT_PRICE")),
            "PURCHASE_TIME": F.when(n % 13 == 0, F.lit("2025-13-01"))
                              .otherwise(F.concat("PURCHASE_TIME", F.lit("T10:20:30")))})
    path = scratch_path(spark, "staged")
    df.write.mode("overwrite").parquet(path)
    return ingest.load_staged(spark, path, entity)


def load_staged_orders(spark, sf_dir):
    """Staged order files whose types are not the table's."""
    return _staged("orders", spark, sf_dir)[0]


def load_staged_emissions(spark, sf_dir):
    """Staged emission files whose types are not the table's."""
    return _staged("emissions", spark, sf_dir)[0]


def ingest_quarantine(spark, sf_dir):
    """Good and quarantined rows of staged orders with seeded bad values."""
    good, bad = _staged("orders", spark, sf_dir, broken=True)
    return (good.select(F.lit("good").alias("side"), "TXID")
            .unionByName(bad.select(F.lit("quarantine").alias("side"), "TXID"))
            .groupBy("side").agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.countDistinct("TXID").alias("n_keys")))


def metadata_fields(spark, sf_dir):
    """METADATA from the landing record through every layer to the serving copy; one
    field of it, and one of RAW_PAYLOAD, read where they are served."""
    return loads.metadata_fields(spark, sf_dir)


def _plain(query: Query) -> Query:
    """Rows whose VARIANT columns are JSON text, as SQL engines without VARIANT return them."""
    from tamper.sources.ingest import plain

    return lambda spark, sf_dir: plain(query(spark, sf_dir))


_QUERIES: dict[str, Query] = {
    # layers
    "silver_orders": serving_orders,
    "silver_emissions": serving_emissions,
    # sales dashboard
    "sales_kpis": _on_orders(sales.sales_kpis),
    "sales_histogram": _on_orders(sales.sales_histogram),
    "sales_daily": _on_orders(sales.sales_daily),
    "top_products": _on_orders(sales.top_products),
    "sales_by_bag": _on_orders(sales.sales_by_bag),
    "orders_by_origin": _on_orders(sales.orders_by_origin),
    "orders_by_region": _on_orders(sales.orders_by_region),
    "payment_methods": _on_orders(sales.payment_methods),
    "payment_status": _on_orders(sales.payment_status),
    "shipping_methods": _on_orders(sales.shipping_methods),
    "delay_histogram": _on_orders(sales.delay_histogram),
    "delivery_status": _on_orders(sales.delivery_status),
    "category_breakdown": _on_orders(sales.category_breakdown),
    "sales_dashboard": sales_dashboard,
    # emissions dashboard
    "emissions_kpis": _on_emissions(emissions.emissions_kpis),
    "emissions_monthly": _on_emissions(emissions.emissions_monthly),
    "emissions_by_warehouse": _on_emissions(emissions.emissions_by_warehouse),
    "emissions_per_kg": _on_emissions(emissions.emissions_per_kg),
    "emissions_by_origin": _on_emissions(emissions.emissions_by_origin),
    "emissions_by_distance": _on_emissions(emissions.emissions_by_distance),
    "emissions_filtered": emissions_filtered,
    "warehouse_choices": warehouse_choices,
    "emissions_breakdown": _on_emissions(emissions.emissions_breakdown),
    # monitoring
    "freshness": freshness,
    "freshness_all": freshness_all,
    "freshness_stored": freshness_stored,
    "query_errors": query_errors,
    "task_history": _on_runs(lambda runs: runs),
    "task_summary": _on_runs(monitoring.task_summary),
    "task_status_counts": _on_runs(monitoring.task_status_counts),
    "task_duration_box": _on_runs(monitoring.task_duration_box),
    "failed_tasks": _on_runs(monitoring.failed_tasks),
    "ingest_throughput": ingest_throughput,
    "load_errors": load_errors,
    "cluster_load": cluster_load,
    # data quality
    "dq_orders": dq_orders,
    "dq_orders_raw": dq_orders_raw,
    "dq_emissions": dq_emissions,
    "dq_emissions_raw": dq_emissions_raw,
    "dq_report": dq_report,
    "dq_orders_sketched": dq_orders_sketched,
    # merge core
    "upsert_orders": _merge(layers.upsert_two_batches, "orders"),
    "upsert_orders_broadcast": _merge(broadcast_upsert, "orders"),
    "upsert_emissions_broadcast": _merge(broadcast_upsert, "emissions"),
    "fold_orders": _merge(layers.fold_two_batches, "orders"),
    "rebuild_orders": _merge(layers.rebuild, "orders"),
    "gold_chain": _merge(layers.gold_chain, "orders"),
    "gold_chain_emissions": _merge(layers.gold_chain, "emissions"),
    "serving_chain": _merge(layers.serving_chain, "orders"),
    "upsert_emissions": _merge(layers.upsert_two_batches, "emissions"),
    "fold_emissions": _merge(layers.fold_two_batches, "emissions"),
    # derived columns and rules
    "initcap_items": enrichment.initcap_items,
    "uuid5_ids": enrichment.uuid5_ids,
    "product_ids": enrichment.product_ids,
    "price": enrichment.price,
    "carbon_score": enrichment.carbon_score,
    "warehouse_assignment": enrichment.warehouse_assignment,
    "distance_class": enrichment.distance_class,
    "estimated_emissions": enrichment.estimated_emissions,
    "payment_status_rule": enrichment.payment_status,
    "delivery_delay": enrichment.delivery_delay,
    "rule_checks": enrichment.rule_checks,
    "carbon_score_shop": enrichment.carbon_score_shop,
    "rule_checks_shop": enrichment.rule_checks_shop,
    "distance_class_shop": enrichment.distance_class_shop,
    # ingestion and streaming
    "ingest_json": _ingest_json("orders"),
    "ingest_json_emissions": _ingest_json("emissions"),
    "load_staged_orders": load_staged_orders,
    "load_staged_emissions": load_staged_emissions,
    "ingest_quarantine": ingest_quarantine,
    "load_staged_mixed": loads.load_staged_mixed,
    "load_staged_rejects": loads.load_staged_rejects,
    "load_staged_stream": loads.load_staged_stream,
    "pipeline_progress": loads.pipeline_progress,
    "pipeline_runs": loads.pipeline_runs,
    "stream_pipeline": stream_pipeline,
    "stream_pipeline_limited": stream_pipeline_limited,
    "stream_pipeline_emissions": stream_pipeline_emissions,
    "metadata_fields": metadata_fields,
}

QUERIES: dict[str, Query] = {name: _plain(query) for name, query in _QUERIES.items()}
