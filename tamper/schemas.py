"""Table schemas shared by every layer (RAW, SILVER, GOLD, serving).

One StructType per entity: each layer clones it, as the reference's layers are
created ``LIKE`` the raw table. PURCHASE_TIME is nullable on purpose: the
silver cleaning nulls future purchase dates.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Whole numbers are NUMBER(10, 0): ten digits, more than an INT holds.
WHOLE_DIGITS = 10

ORDER_KEY = "TXID"
EMISSION_KEY = "RECORD_ID"

ORDER_SCHEMA = T.StructType([
    T.StructField("TXID", T.StringType(), True),
    T.StructField("RFID", T.StringType(), True),
    T.StructField("CUSTOMER_ID", T.StringType(), True),
    T.StructField("PRODUCT_ID", T.StringType(), True),
    T.StructField("ITEM", T.StringType(), True),
    T.StructField("BAG_SIZE", T.StringType(), True),
    T.StructField("UNIT_PRICE", T.DecimalType(10, 2), True),
    T.StructField("QUANTITY", T.LongType(), True),
    T.StructField("TOTAL_PRICE", T.DecimalType(12, 2), True),
    T.StructField("ORIGIN_COUNTRY", T.StringType(), True),
    T.StructField("FAIR_TRADE_CERTIFIED", T.BooleanType(), True),
    T.StructField("ORGANIC_CERTIFIED", T.BooleanType(), True),
    T.StructField("PURCHASE_TIME", T.DateType(), True),
    T.StructField("SHIPPED_DATE", T.DateType(), True),
    T.StructField("DELIVERED_DATE", T.DateType(), True),
    T.StructField("REGION", T.StringType(), True),
    T.StructField("NAME", T.StringType(), True),
    T.StructField("STREET_ADDRESS", T.StringType(), True),
    T.StructField("CITY", T.StringType(), True),
    T.StructField("COUNTRY", T.StringType(), True),
    T.StructField("POSTALCODE", T.StringType(), True),
    T.StructField("PHONE", T.StringType(), True),
    T.StructField("EMAIL", T.StringType(), True),
    T.StructField("WAREHOUSE", T.StringType(), True),
    T.StructField("SHIPPING_METHOD", T.StringType(), True),
    T.StructField("DELIVERY_STATUS", T.StringType(), True),
    T.StructField("PAYMENT_METHOD", T.StringType(), True),
    T.StructField("PAYMENT_STATUS", T.StringType(), True),
    T.StructField("DELIVERY_DELAY_DAYS", T.LongType(), True),
    T.StructField("CARBON_SCORE", T.DecimalType(10, 2), True),
    # Semi-structured; the landing records of the source do not carry it.
    T.StructField("METADATA", T.VariantType(), True),
])

EMISSION_SCHEMA = T.StructType([
    T.StructField("RECORD_ID", T.StringType(), True),
    T.StructField("REPORTING_MONTH", T.DateType(), True),
    T.StructField("WAREHOUSE_ID", T.StringType(), True),
    T.StructField("WAREHOUSE_NAME", T.StringType(), True),
    T.StructField("WAREHOUSE_COUNTRY", T.StringType(), True),
    T.StructField("ORIGIN_COUNTRY", T.StringType(), True),
    T.StructField("DISTANCE_CLASS", T.StringType(), True),
    T.StructField("SHIPPING_METHOD", T.StringType(), True),
    T.StructField("SHIPMENTS_COUNT", T.LongType(), True),
    T.StructField("AVG_BATCH_SIZE_KG", T.DecimalType(10, 2), True),
    T.StructField("ESTIMATED_EMISSIONS_KGCO2E", T.DecimalType(12, 2), True),
    T.StructField("RAW_PAYLOAD", T.VariantType(), True),
    T.StructField("METADATA", T.VariantType(), True),
])

ORDER_COLUMNS = [f.name for f in ORDER_SCHEMA.fields]
EMISSION_COLUMNS = [f.name for f in EMISSION_SCHEMA.fields]

# Columns a matched MERGE updates. Orders: only these six; every other column
# keeps its first-seen value (DELIVERY_STATUS, PAYMENT_STATUS, prices ...).
ORDER_UPDATE_COLUMNS = ["ITEM", "BAG_SIZE", "PURCHASE_TIME", "SHIPPED_DATE",
                        "DELIVERED_DATE", "CARBON_SCORE"]
# Emissions: every non-key column except METADATA.
EMISSION_UPDATE_COLUMNS = [c for c in EMISSION_COLUMNS if c not in (EMISSION_KEY, "METADATA")]

ORDER_INSERT_COLUMNS = list(ORDER_COLUMNS)
# The emission insert leaves METADATA out, so it stays NULL.
EMISSION_INSERT_COLUMNS = [c for c in EMISSION_COLUMNS if c != "METADATA"]

# Lower-case JSON keys of the landing format -> table columns.
ORDER_JSON_KEYS = {c.lower(): c for c in ORDER_COLUMNS}
ORDER_REQUIRED_KEYS = ["txid", "rfid", "customer_id", "product_id", "item", "purchase_time"]
EMISSION_JSON_KEYS = {
    "record_id": "RECORD_ID",
    "reporting_month": "REPORTING_MONTH",
    "warehouse_id": "WAREHOUSE_ID",
    "warehouse_name": "WAREHOUSE_NAME",
    "warehouse_country": "WAREHOUSE_COUNTRY",
    "origin_country": "ORIGIN_COUNTRY",
    "distance_class": "DISTANCE_CLASS",
    "shipping_method": "SHIPPING_METHOD",
    "shipments_count": "SHIPMENTS_COUNT",
    "avg_batch_size_kg": "AVG_BATCH_SIZE_KG",
    "estimated_emissions_kgCO2e": "ESTIMATED_EMISSIONS_KGCO2E",
}
EMISSION_REQUIRED_KEYS = list(EMISSION_JSON_KEYS)
# Semi-structured keys: any JSON value, optional.
EMISSION_JSON_KEYS |= {"raw_payload": "RAW_PAYLOAD", "metadata": "METADATA"}

# NOT NULL columns of the RAW tables: a landed row that has NULL here after
# type coercion (e.g. a purchase date that does not parse) is rejected by the
# load and goes to the quarantine.
ORDER_NOT_NULL = ["TXID", "PURCHASE_TIME"]
EMISSION_NOT_NULL = ["RECORD_ID"]

# Columns carried next to the table columns to give "latest" a total order that any
# layout of tasks repeats: ingest time, file, then two positions inside the file; and the
# batch a row arrived in.
SEQ_COLUMNS = ["INGEST_TS", "SOURCE_FILE", "SEQ1", "SEQ2"]
SEQ_FIELDS = [T.StructField("INGEST_TS", T.TimestampNTZType(), True),
              T.StructField("SOURCE_FILE", T.StringType(), True),
              T.StructField("SEQ1", T.LongType(), True), T.StructField("SEQ2", T.LongType(), True)]
BATCH_COLUMN = "BATCH_ID"

SCHEMAS = {"orders": ORDER_SCHEMA, "emissions": EMISSION_SCHEMA}
KEYS = {"orders": ORDER_KEY, "emissions": EMISSION_KEY}
UPDATE_COLUMNS = {"orders": ORDER_UPDATE_COLUMNS, "emissions": EMISSION_UPDATE_COLUMNS}
INSERT_COLUMNS = {"orders": ORDER_INSERT_COLUMNS, "emissions": EMISSION_INSERT_COLUMNS}


def conform(df, schema: T.StructType, extra: list[str] | tuple[str, ...] = ()):
    """Select ``schema``'s columns by name and cast them; missing ones are NULL,
    other columns are dropped (the raw load matches columns by name) except
    those named in ``extra``, which are kept as they are."""
    from pyspark.sql import functions as F

    present = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in present:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols, *[c for c in extra if c in present])
