"""Reference SQL for every registered query, in the DuckDB dialect.

Each string runs on the pre-registered test tables and must give the same
rows as the Spark query of the same name. The shared CTEs rebuild the landing
tables exactly as ``tamper.sources.testdata`` does; the per-query SQL is
written independently of the DataFrame code, so a mismatch points at a bug in
one of them.
"""

from __future__ import annotations

from tamper.functions import lookups as L
from tamper.functions.text import INITCAP_DELIMITERS, delimiter_class
from tamper.sources import testdata as TD

ORDERS_AS_OF = "TIMESTAMP '2001-01-01 00:00:00'"
ORDERS_AS_OF_DATE = "DATE '2001-01-01'"
RUNS_AS_OF = "TIMESTAMP '2024-01-30 00:00:00'"
RUNS_BOUND = "TIMESTAMP '2024-01-29 00:00:00'"  # RUNS_AS_OF - 24 hours


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def initcap_sql(col: str) -> str:
    d = delimiter_class(INITCAP_DELIMITERS)
    nd = "[^" + d[1:]
    lead = f"regexp_extract(x, {q('^' + d + '*')}, 0)"
    return (f"array_to_string(list_transform(regexp_extract_all(lower({col}), {q(d + '*' + nd + '*')}, 0), "
            f"lambda x: {lead} || upper(substr(x, length({lead}) + 1, 1)) || substr(x, length({lead}) + 2)), '')")


def case_map(col: str, mapping: dict, default: str = "NULL", cast: str | None = None) -> str:
    def v(x):
        return f"CAST({x} AS {cast})" if cast else q(x)
    whens = " ".join(f"WHEN {q(k)} THEN {v(val)}" for k, val in mapping.items())
    dflt = (f"CAST({default} AS {cast})" if cast and default != "NULL" else default)
    return f"CASE {col} {whens} ELSE {dflt} END"


def pick(names: list[str], idx: str) -> str:
    arr = "[" + ", ".join(q(n) for n in names) + "]"
    return f"{arr}[({idx}) + 1]"


ORDER_WH_COUNTRY = case_map("o.WAREHOUSE", {n: c for n, c in L.ORDER_WAREHOUSES.values()})
PAYMENT_STATUS_SQL = case_map("DELIVERY_STATUS", L.PAYMENT_STATUS, q(L.PAYMENT_STATUS_DEFAULT))

ORDERS_BASE = f"""
regions_dim AS (
  SELECT n_name AS dim_country, min(r_name) AS dim_region
  FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY n_name
),
orders_base AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS TXID,
    'RF-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS RFID,
    'C-' || CAST(c_custkey AS VARCHAR) AS CUSTOMER_ID,
    'P-' || CAST(p_partkey AS VARCHAR) AS PRODUCT_ID,
    upper(p_name) AS ITEM,
    CASE WHEN p_size <= 16 THEN '250g' WHEN p_size <= 33 THEN '500g' ELSE '1kg' END AS BAG_SIZE,
    CAST(p_retailprice AS DECIMAL(10,2)) AS UNIT_PRICE,
    CAST(l_quantity AS BIGINT) AS QUANTITY,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS TOTAL_PRICE,
    sn.n_name AS ORIGIN_COUNTRY,
    CAST(o_orderdate AS DATE) AS PURCHASE_TIME,
    CASE WHEN l_returnflag = 'A' THEN NULL
         ELSE CAST(o_orderdate AS DATE) + CAST(l_linenumber % 4 AS INTEGER) END AS SHIPPED_DATE,
    CASE WHEN l_returnflag = 'A' OR o_orderstatus = 'P' THEN NULL
         ELSE CAST(o_orderdate AS DATE) + CAST(l_linenumber % 4 + (CAST(l_quantity AS INTEGER) % 20 + 1) AS INTEGER)
    END AS DELIVERED_DATE,
    r_name AS REGION,
    cn.n_name AS COUNTRY,
    CASE r_name WHEN 'AMERICA' THEN 'West Coast USA' WHEN 'EUROPE' THEN 'Paris'
         WHEN 'AFRICA' THEN 'Paris' ELSE 'Singapore' END AS WAREHOUSE,
    CASE l_linenumber % 4 WHEN 0 THEN 'Standard' WHEN 1 THEN 'Express'
         WHEN 2 THEN 'EcoDelivery' ELSE 'Local Pickup' END AS SHIPPING_METHOD,
    CASE WHEN l_returnflag = 'A' THEN 'Canceled' WHEN o_orderstatus = 'P' THEN 'In Transit'
         WHEN l_returnflag = 'R' THEN 'Returned' ELSE 'Delivered' END AS DELIVERY_STATUS,
    o_orderpriority AS PAYMENT_METHOD,
    CASE WHEN l_returnflag = 'A' OR o_orderstatus = 'P' THEN NULL
         ELSE CAST((l_linenumber % 4) + (CAST(l_quantity AS INTEGER) % 20 + 1) AS BIGINT)
    END AS DELIVERY_DELAY_DAYS,
    l_shipdate AS INGEST_TS, l_partkey AS SEQ1, l_suppkey AS SEQ2
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation cn ON c_nationkey = cn.n_nationkey
    JOIN region ON cn.n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation sn ON s_nationkey = sn.n_nationkey
),
orders_scored AS (
  SELECT o.*,
    {ORDER_WH_COUNTRY} AS WH_COUNTRY,
    dr.dim_region AS DEST_REGION
  FROM orders_base o LEFT JOIN regions_dim dr ON o.COUNTRY = dr.dim_country
),
orders_landing AS (
  SELECT TXID, RFID, CUSTOMER_ID, PRODUCT_ID, ITEM, BAG_SIZE,
    UNIT_PRICE, QUANTITY, TOTAL_PRICE, ORIGIN_COUNTRY,
    CAST(NULL AS BOOLEAN) AS FAIR_TRADE_CERTIFIED, CAST(NULL AS BOOLEAN) AS ORGANIC_CERTIFIED,
    PURCHASE_TIME, SHIPPED_DATE, DELIVERED_DATE, REGION,
    CAST(NULL AS VARCHAR) AS NAME, CAST(NULL AS VARCHAR) AS STREET_ADDRESS,
    CAST(NULL AS VARCHAR) AS CITY, COUNTRY, CAST(NULL AS VARCHAR) AS POSTALCODE,
    CAST(NULL AS VARCHAR) AS PHONE, CAST(NULL AS VARCHAR) AS EMAIL,
    WAREHOUSE, SHIPPING_METHOD, DELIVERY_STATUS, PAYMENT_METHOD,
    {PAYMENT_STATUS_SQL} AS PAYMENT_STATUS,
    DELIVERY_DELAY_DAYS,
    CAST(round(
      CAST(CASE WHEN COUNTRY IS NOT DISTINCT FROM WH_COUNTRY THEN 0.2
                WHEN coalesce(DEST_REGION, 'Unknown') = coalesce(wr.dim_region, 'Unknown') THEN 1.0
                ELSE 1.8 END AS DECIMAL(4,2))
      * CAST(CASE SHIPPING_METHOD WHEN 'Local Pickup' THEN 0.2 WHEN 'EcoDelivery' THEN 0.8
                WHEN 'Express' THEN 1.4 ELSE 1.0 END AS DECIMAL(4,2))
      * (CAST(1.0 AS DECIMAL(4,2)) + CAST(CASE upper(BAG_SIZE) WHEN '500G' THEN 0.15
                WHEN '1KG' THEN 0.35 ELSE 0.0 END AS DECIMAL(4,2)))
      * CAST(QUANTITY AS DECIMAL(10,0))
      * CAST(CASE DELIVERY_STATUS WHEN 'Canceled' THEN 0.3 WHEN 'Returned' THEN 2.0
                ELSE 1.0 END AS DECIMAL(4,2)), 2) AS DECIMAL(10,2)) AS CARBON_SCORE,
    CAST(NULL AS VARCHAR) AS METADATA,
    INGEST_TS, SEQ1, SEQ2, month(INGEST_TS) % 2 AS BATCH_ID
  FROM orders_scored LEFT JOIN regions_dim wr ON WH_COUNTRY = wr.dim_country
)"""

ORDER_COLS = ["TXID", "RFID", "CUSTOMER_ID", "PRODUCT_ID", "ITEM", "BAG_SIZE", "UNIT_PRICE",
              "QUANTITY", "TOTAL_PRICE", "ORIGIN_COUNTRY", "FAIR_TRADE_CERTIFIED",
              "ORGANIC_CERTIFIED", "PURCHASE_TIME", "SHIPPED_DATE", "DELIVERED_DATE", "REGION",
              "NAME", "STREET_ADDRESS", "CITY", "COUNTRY", "POSTALCODE", "PHONE", "EMAIL",
              "WAREHOUSE", "SHIPPING_METHOD", "DELIVERY_STATUS", "PAYMENT_METHOD",
              "PAYMENT_STATUS", "DELIVERY_DELAY_DAYS", "CARBON_SCORE", "METADATA"]
ORDER_UPDATE = ["ITEM", "BAG_SIZE", "PURCHASE_TIME", "SHIPPED_DATE", "DELIVERED_DATE",
                "CARBON_SCORE"]
SEQ_DESC = "INGEST_TS DESC NULLS LAST, SEQ1 DESC NULLS LAST, SEQ2 DESC NULLS LAST"


def _clean_orders_select(src: str) -> str:
    cols = []
    for c in ORDER_COLS:
        if c == "ITEM":
            cols.append(f"{initcap_sql('ITEM')} AS ITEM")
        elif c == "BAG_SIZE":
            cols.append("upper(BAG_SIZE) AS BAG_SIZE")
        elif c in ("PURCHASE_TIME", "SHIPPED_DATE", "DELIVERED_DATE"):
            cols.append(f"CASE WHEN CAST({c} AS TIMESTAMP) <= {ORDERS_AS_OF} THEN {c} END AS {c}")
        else:
            cols.append(c)
    return f"SELECT {', '.join(cols)} FROM {src}"


SILVER_ORDERS = f"""
silver_orders AS (
  {_clean_orders_select(
    "(SELECT * FROM orders_landing WHERE TXID IS NOT NULL "
    f"QUALIFY row_number() OVER (PARTITION BY TXID ORDER BY {SEQ_DESC}) = 1)")}
)"""

ORDERS_CTE = "WITH " + ORDERS_BASE.strip() + ",\n" + SILVER_ORDERS.strip()


def with_orders(body: str) -> str:
    return ORDERS_CTE + "\n" + body


EMISSION_COLS = ["RECORD_ID", "REPORTING_MONTH", "WAREHOUSE_ID", "WAREHOUSE_NAME",
                 "WAREHOUSE_COUNTRY", "ORIGIN_COUNTRY", "DISTANCE_CLASS", "SHIPPING_METHOD",
                 "SHIPMENTS_COUNT", "AVG_BATCH_SIZE_KG", "ESTIMATED_EMISSIONS_KGCO2E",
                 "RAW_PAYLOAD", "METADATA"]

EMISSIONS_BASE = """
emissions_landing AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS RECORD_ID,
    CAST(date_trunc('month', l_shipdate) AS DATE) AS REPORTING_MONTH,
    'W' || CAST(l_suppkey % 4 AS VARCHAR) AS WAREHOUSE_ID,
    n_name AS WAREHOUSE_NAME,
    CAST(NULL AS VARCHAR) AS WAREHOUSE_COUNTRY,
    n_name AS ORIGIN_COUNTRY,
    CASE l_linenumber % 3 WHEN 0 THEN 'Local' WHEN 1 THEN 'Regional' ELSE 'Intercontinental' END AS DISTANCE_CLASS,
    CASE l_linenumber % 4 WHEN 0 THEN 'Standard' WHEN 1 THEN 'Express' WHEN 2 THEN 'EcoDelivery' ELSE 'Local Pickup' END AS SHIPPING_METHOD,
    CAST(l_quantity AS BIGINT) - 1 AS SHIPMENTS_COUNT,
    CAST(50 + 4 * p_size AS DECIMAL(10,2)) AS AVG_BATCH_SIZE_KG,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(l_discount AS DECIMAL(4,2)) - CAST(0.02 AS DECIMAL(4,2))) AS DECIMAL(12,2)) AS ESTIMATED_EMISSIONS_KGCO2E,
    CAST(NULL AS VARCHAR) AS RAW_PAYLOAD,
    CAST(NULL AS VARCHAR) AS METADATA,
    l_shipdate AS INGEST_TS, l_partkey AS SEQ1, l_suppkey AS SEQ2,
    month(l_shipdate) % 2 AS BATCH_ID
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
)"""


def _clean_emissions_select(src: str) -> str:
    cols = []
    for c in EMISSION_COLS:
        if c == "ESTIMATED_EMISSIONS_KGCO2E":
            cols.append(f"CASE WHEN {c} < 0 THEN NULL ELSE {c} END AS {c}")
        else:
            cols.append(c)
    return f"SELECT {', '.join(cols)} FROM {src}"


SILVER_EMISSIONS = f"""
silver_emissions AS (
  {_clean_emissions_select(
    "(SELECT * FROM emissions_landing WHERE RECORD_ID IS NOT NULL "
    f"QUALIFY row_number() OVER (PARTITION BY RECORD_ID ORDER BY {SEQ_DESC}) = 1)")}
)"""

EMISSIONS_CTE = "WITH " + EMISSIONS_BASE.strip() + ",\n" + SILVER_EMISSIONS.strip()


def with_emissions(body: str) -> str:
    return EMISSIONS_CTE + "\n" + body


def _hist(src: str, col: str, bins: int = 20) -> str:
    fb = float(bins)
    e = lambda i: f"(CASE WHEN ({i}) >= {bins} THEN e.last ELSE CAST({i} AS DOUBLE) * e.step + e.first END)"
    return f"""
, vals AS (SELECT CAST({col} AS DOUBLE) AS v FROM {src} WHERE {col} IS NOT NULL),
mm AS (SELECT min(v) AS lo, max(v) AS hi FROM vals),
edges AS (SELECT first, last, (last - first) / {fb} AS step FROM (
  SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS first,
         CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS last FROM mm)),
b0 AS (
  SELECT v, CASE WHEN CAST(floor((v - e.first) / (e.last - e.first) * {fb}) AS BIGINT) >= {bins}
                 THEN {bins - 1} ELSE CAST(floor((v - e.first) / (e.last - e.first) * {fb}) AS BIGINT) END AS i0
  FROM vals CROSS JOIN edges e),
b1 AS (SELECT b0.v, CASE WHEN b0.v < {e('b0.i0')} THEN b0.i0 - 1 ELSE b0.i0 END AS i1
       FROM b0 CROSS JOIN edges e),
b2 AS (SELECT CASE WHEN b1.v >= {e('b1.i1 + 1')} AND b1.i1 <> {bins - 1} THEN b1.i1 + 1 ELSE b1.i1 END AS bin
       FROM b1 CROSS JOIN edges e),
counts AS (SELECT bin, count(*) AS n FROM b2 GROUP BY bin),
grid AS (SELECT range AS bin FROM range({bins}))
SELECT g.bin AS bin, round({e('g.bin')}, 6) AS bin_start, round({e('g.bin + 1')}, 6) AS bin_end,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n_rows
FROM grid g CROSS JOIN edges e LEFT JOIN counts c ON g.bin = c.bin"""


def _count_by(src: str, col: str, out: str = "n_orders") -> str:
    return f"SELECT {col}, count(*) AS {out} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col}"


def _share_by(src: str, col: str, out: str = "n_orders") -> str:
    return (f", c AS ({_count_by(src, col, out)})\n"
            f"SELECT {col}, {out}, round(CAST({out} AS DOUBLE) * 100.0 / (SELECT sum(CAST({out} AS DOUBLE)) FROM c), 6) AS share_pct FROM c")


def _sum_by(src: str, keys: str, value: str, out: str) -> str:
    conds = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return (f"SELECT {keys}, coalesce(CAST(sum({value}) AS DOUBLE), 0.0) AS {out} "
            f"FROM {src} WHERE {conds} GROUP BY {keys}")


SQL: dict[str, str] = {}

# ------------------------------------------------------------------ layers
SQL["silver_orders"] = with_orders("SELECT * FROM silver_orders")
SQL["silver_emissions"] = with_emissions("SELECT * FROM silver_emissions")

# ------------------------------------------------------------------ sales
SQL["sales_kpis"] = with_orders("""
SELECT count(*) AS total_orders,
  coalesce(CAST(sum(TOTAL_PRICE) AS DOUBLE), 0.0) AS total_sales,
  count(DISTINCT CUSTOMER_ID) AS unique_customers,
  round(CAST(sum(DELIVERY_DELAY_DAYS) AS DOUBLE) / CAST(nullif(count(DELIVERY_DELAY_DAYS), 0) AS DOUBLE), 6) AS avg_delivery_delay,
  round(CAST(sum(TOTAL_PRICE) AS DOUBLE) / CAST(nullif(count(TOTAL_PRICE), 0) AS DOUBLE), 6) AS avg_order_value
FROM silver_orders""")
SQL["sales_histogram"] = with_orders(_hist("silver_orders", "TOTAL_PRICE"))
SQL["sales_daily"] = with_orders(
    _sum_by("(SELECT CAST(PURCHASE_TIME AS DATE) AS PURCHASE_DATE, TOTAL_PRICE FROM silver_orders)",
            "PURCHASE_DATE", "TOTAL_PRICE", "sales"))
SQL["top_products"] = with_orders(
    _sum_by("silver_orders", "ITEM", "TOTAL_PRICE", "sales") + " ORDER BY sales DESC, ITEM ASC LIMIT 10")
SQL["sales_by_bag"] = with_orders(_sum_by("silver_orders", "BAG_SIZE", "TOTAL_PRICE", "sales"))
SQL["orders_by_origin"] = with_orders(
    _count_by("silver_orders", "ORIGIN_COUNTRY") + " ORDER BY n_orders DESC, ORIGIN_COUNTRY ASC LIMIT 10")
SQL["orders_by_region"] = with_orders(_share_by("silver_orders", "REGION"))
SQL["payment_methods"] = with_orders(_count_by("silver_orders", "PAYMENT_METHOD"))
SQL["payment_status"] = with_orders(_share_by("silver_orders", "PAYMENT_STATUS"))
SQL["shipping_methods"] = with_orders(_count_by("silver_orders", "SHIPPING_METHOD"))
SQL["delay_histogram"] = with_orders(_hist("silver_orders", "DELIVERY_DELAY_DAYS"))
SQL["delivery_status"] = with_orders(_count_by("silver_orders", "DELIVERY_STATUS"))
_CATS = ["BAG_SIZE", "ORIGIN_COUNTRY", "REGION", "PAYMENT_METHOD", "PAYMENT_STATUS",
         "SHIPPING_METHOD", "DELIVERY_STATUS"]
SQL["category_breakdown"] = with_orders("\nUNION ALL ".join(
    f"SELECT {q(c)} AS dimension, {c} AS value, count(*) AS n_orders, "
    f"coalesce(CAST(sum(TOTAL_PRICE) AS DOUBLE), 0.0) AS sales "
    f"FROM silver_orders WHERE {c} IS NOT NULL GROUP BY {c}" for c in _CATS))

# ------------------------------------------------------------------ emissions
E = "ESTIMATED_EMISSIONS_KGCO2E"


def _ratio(num: str, den: str) -> str:
    return (f"CASE WHEN CAST({den} AS DOUBLE) = 0 THEN NULL "
            f"ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END")


SQL["emissions_kpis"] = with_emissions(f"""
SELECT round(coalesce(CAST(sum({E}) AS DOUBLE), 0.0), 6) AS total_emissions,
  round(avg({_ratio(E, 'SHIPMENTS_COUNT')}), 6) AS avg_emissions_per_shipment
FROM silver_emissions""")
SQL["emissions_monthly"] = with_emissions(_sum_by("silver_emissions", "REPORTING_MONTH", E, "emissions"))
SQL["emissions_by_warehouse"] = with_emissions(_sum_by("silver_emissions", "WAREHOUSE_NAME", E, "emissions"))
SQL["emissions_per_kg"] = with_emissions(f"""
SELECT SHIPPING_METHOD, WAREHOUSE_NAME,
  round(coalesce(sum({_ratio(E, 'AVG_BATCH_SIZE_KG')}), 0.0), 6) AS emissions_per_kg
FROM silver_emissions WHERE SHIPPING_METHOD IS NOT NULL AND WAREHOUSE_NAME IS NOT NULL
GROUP BY SHIPPING_METHOD, WAREHOUSE_NAME""")
SQL["emissions_by_origin"] = with_emissions(_sum_by("silver_emissions", "ORIGIN_COUNTRY", E, "emissions"))
SQL["emissions_by_distance"] = with_emissions(f"""
, c AS ({_sum_by("silver_emissions", "DISTANCE_CLASS", E, "emissions")})
SELECT DISTANCE_CLASS, round(emissions, 6) AS emissions,
  round(emissions * 100.0 / (SELECT sum(emissions) FROM c), 6) AS share_pct FROM c""")
SQL["emissions_breakdown"] = with_emissions("\nUNION ALL ".join(
    f"SELECT {q(c)} AS dimension, CAST({c} AS VARCHAR) AS value, "
    f"coalesce(CAST(sum({E}) AS DOUBLE), 0.0) AS emissions "
    f"FROM silver_emissions WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in ["REPORTING_MONTH", "WAREHOUSE_NAME", "ORIGIN_COUNTRY", "DISTANCE_CLASS"]))
_E7_WH = ", ".join(q(f"NATION_{i}") for i in range(0, 25, 2))
SQL["emissions_filtered"] = with_emissions(f"""
SELECT * FROM silver_emissions
WHERE (WAREHOUSE_NAME IN ({_E7_WH}) OR WAREHOUSE_NAME IS NULL)
  AND DISTANCE_CLASS IN ('Regional', 'Intercontinental')""")

# ------------------------------------------------------------------ run logs
TASK_RUNS = f"""task_runs AS (
  SELECT event_id AS RUN_ID, {pick(TD.TASK_NAMES, 'user_id % 6')} AS NAME,
    {q(TD.DATABASE_NAME)} AS DATABASE_NAME, {pick(TD.SCHEMA_NAMES, 'user_id % 3')} AS SCHEMA_NAME,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'SKIPPED' ELSE 'SUCCEEDED' END AS STATE,
    ts AS QUERY_START_TIME,
    ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS COMPLETED_TIME,
    CASE WHEN event_type = 'error' THEN 'E' || CAST(user_id % 10 AS VARCHAR) END AS ERROR_CODE,
    CASE WHEN event_type = 'error' THEN props END AS ERROR_MESSAGE
  FROM events
),
task_history AS (
  SELECT NAME, DATABASE_NAME, SCHEMA_NAME, STATE, COMPLETED_TIME,
    date_diff('second', date_trunc('second', QUERY_START_TIME), date_trunc('second', COMPLETED_TIME)) AS DURATION_SEC,
    ERROR_CODE, ERROR_MESSAGE
  FROM task_runs WHERE COMPLETED_TIME >= {RUNS_BOUND}
)"""


def with_runs(body: str) -> str:
    return "WITH " + TASK_RUNS + "\n" + body


SQL["task_history"] = with_runs("SELECT * FROM task_history")
SQL["task_summary"] = with_runs("""
SELECT count(*) AS total_runs, count(*) FILTER (WHERE STATE = 'SUCCEEDED') AS succeeded,
  count(*) FILTER (WHERE STATE = 'FAILED') AS failed FROM task_history""")
SQL["task_status_counts"] = with_runs(
    'SELECT STATE, count(*) AS "COUNT" FROM task_history WHERE STATE IS NOT NULL GROUP BY STATE')
SQL["task_duration_box"] = with_runs("""
, lab AS (
  SELECT CASE WHEN length(NAME) <= 30 THEN NAME ELSE substr(NAME, 1, 27) || '...' END AS TASK_LABEL,
    STATE, CAST(DURATION_SEC AS DOUBLE) AS v FROM task_history WHERE DURATION_SEC IS NOT NULL),
st AS (
  SELECT TASK_LABEL, STATE, count(*) AS n, min(v) AS mn, quantile_cont(v, 0.25) AS q1,
    quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3, max(v) AS mx
  FROM lab GROUP BY TASK_LABEL, STATE),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM st)
SELECT f.TASK_LABEL, f.STATE, f.n, round(f.mn, 6) AS "min", round(f.q1, 6) AS q1,
  round(f.med, 6) AS median, round(f.q3, 6) AS q3, round(f.mx, 6) AS "max",
  round(min(CASE WHEN l.v >= f.lo AND l.v <= f.hi THEN l.v END), 6) AS whisker_low,
  round(max(CASE WHEN l.v >= f.lo AND l.v <= f.hi THEN l.v END), 6) AS whisker_high,
  count(*) FILTER (WHERE NOT (l.v >= f.lo AND l.v <= f.hi)) AS n_outliers
FROM f JOIN lab l ON f.TASK_LABEL IS NOT DISTINCT FROM l.TASK_LABEL AND f.STATE IS NOT DISTINCT FROM l.STATE
GROUP BY f.TASK_LABEL, f.STATE, f.n, f.mn, f.q1, f.med, f.q3, f.mx""")
SQL["failed_tasks"] = with_runs("""
SELECT DATABASE_NAME AS "Database", SCHEMA_NAME AS "Schema", NAME AS "Task Name",
  ERROR_CODE AS "Error Code", ERROR_MESSAGE AS "Error Message", COMPLETED_TIME AS "Completed Time"
FROM task_history WHERE STATE = 'FAILED'""")
SQL["query_errors"] = f"""
SELECT event_id AS QUERY_ID, 'user_' || CAST(user_id % 10 AS VARCHAR) AS USER_NAME,
  'E' || CAST(user_id % 10 AS VARCHAR) AS ERROR_CODE, props AS ERROR_MESSAGE, ts AS START_TIME,
  CAST(CAST(round(value * 1000) AS BIGINT) AS DOUBLE) / 1000.0 AS SECS
FROM events WHERE ts >= {RUNS_BOUND} AND event_type = 'error'"""
_PIPES = ", ".join(q(p) for p in TD.PIPE_NAMES[:2])
SQL["ingest_throughput"] = f"""
WITH usage AS (
  SELECT {pick(TD.PIPE_NAMES, 'user_id % 3')} AS PIPE_NAME, date_trunc('hour', ts) AS START_TIME,
    CAST(sum(CAST(round(value * 1000) AS BIGINT)) AS BIGINT) AS BYTES_INSERTED,
    count(*) AS FILES_INSERTED, count(*) FILTER (WHERE event_type = 'error') AS ERROR_COUNT
  FROM events GROUP BY 1, 2)
SELECT * FROM usage WHERE START_TIME >= {RUNS_BOUND} AND PIPE_NAME IN ({_PIPES})"""
SQL["load_errors"] = f"""
SELECT {pick(TD.LOAD_TABLES, 'user_id % 3')} AS TABLE_FQN,
  'batch_' || CAST(event_id AS VARCHAR) || '.parquet' AS FILE_NAME, ts AS LAST_LOAD_TIME,
  user_id AS ROW_COUNT, props AS FIRST_ERROR_MESSAGE
FROM events WHERE ts >= {RUNS_BOUND} AND event_type = 'error' AND props IS NOT NULL"""
SQL["cluster_load"] = f"""
WITH m AS (
  SELECT date_trunc('hour', ts) AS TS, {pick(TD.WAREHOUSE_NAMES, 'user_id % 3')} AS WAREHOUSE_NAME,
    value / CAST(10 AS DOUBLE) AS Q, CAST(user_id % 5 AS DOUBLE) AS B, value / CAST(100 AS DOUBLE) AS R
  FROM events),
w AS (
  SELECT TS, WAREHOUSE_NAME, avg(Q) AS QUEUED, avg(B) AS BLOCKED, avg(R) AS RUNNING
  FROM m WHERE TS >= {RUNS_BOUND} AND WAREHOUSE_NAME = {q(TD.WAREHOUSE_NAMES[0])} GROUP BY 1, 2)
SELECT TS, WAREHOUSE_NAME, 'QUEUED' AS metric, round(QUEUED, 6) AS value FROM w
UNION ALL SELECT TS, WAREHOUSE_NAME, 'BLOCKED', round(BLOCKED, 6) FROM w
UNION ALL SELECT TS, WAREHOUSE_NAME, 'RUNNING', round(RUNNING, 6) FROM w"""

# ------------------------------------------------------------------ freshness
BOTH_CTE = ("WITH " + ORDERS_BASE.strip() + ",\n" + SILVER_ORDERS.strip() + ",\n"
            + EMISSIONS_BASE.strip() + ",\n" + SILVER_EMISSIONS.strip())


def _fresh(layer: str, name: str, src: str, col: str) -> str:
    ing = "max(INGEST_TS)" if layer == "RAW" else "CAST(NULL AS TIMESTAMP)"
    return (f"SELECT {q(layer)} AS layer, {q(name)} AS table_name, count(*) AS row_count, "
            f"CAST(max({col}) AS DATE) AS max_event_date, {ing} AS max_ingest_ts, "
            f"round(CAST(epoch_us({ORDERS_AS_OF}) - epoch_us(CAST(max({col}) AS TIMESTAMP)) AS DOUBLE) "
            f"/ 60000000.0, 6) AS lag_min FROM {src}")


_RAW_FRESH = [("RAW", "RAW_ORDERS", "orders_landing", "DELIVERED_DATE"),
              ("RAW", "RAW_EMISSIONS", "emissions_landing", "REPORTING_MONTH")]
_ALL_FRESH = _RAW_FRESH + [
    ("SILVER", "SILVER_ORDERS", "silver_orders", "DELIVERED_DATE"),
    ("SILVER", "SILVER_EMISSIONS", "silver_emissions", "REPORTING_MONTH")]
_FRESH_GOLD = [("GOLD", "GOLD_ORDERS", "gold_orders", "DELIVERED_DATE"),
               ("GOLD", "GOLD_EMISSIONS", "gold_emissions", "REPORTING_MONTH")]
SQL["freshness"] = BOTH_CTE + "\n" + "\nUNION ALL ".join(_fresh(*t) for t in _RAW_FRESH)

# ------------------------------------------------------------------ quality
def _dq_orders(src: str) -> str:
    return f"""SELECT count(*) AS N, count(*) FILTER (WHERE CUSTOMER_ID IS NULL) AS N_NULL_CUSTOMER,
  count(*) FILTER (WHERE TXID IS NULL) AS N_NULL_TXID, count(DISTINCT TXID) AS N_DISTINCT_TXID,
  count(*) FILTER (WHERE CAST(PURCHASE_TIME AS TIMESTAMP) > {ORDERS_AS_OF}) AS N_FUTURE_PURCHASES
FROM {src}"""


def _dq_emissions(src: str) -> str:
    return f"""SELECT count(*) AS N, count(*) FILTER (WHERE {E} < 0) AS N_NEGATIVE,
  count(*) FILTER (WHERE REPORTING_MONTH > {ORDERS_AS_OF_DATE}) AS N_FUTURE_REPORTS
FROM {src}"""


SQL["dq_orders"] = with_orders(_dq_orders("silver_orders"))
SQL["dq_orders_raw"] = with_orders(_dq_orders("orders_landing"))
SQL["dq_emissions"] = with_emissions(_dq_emissions("silver_emissions"))
SQL["dq_emissions_raw"] = with_emissions(_dq_emissions("emissions_landing"))


def _rate_row(name: str, col: str) -> str:
    rate = f"(CAST({col} AS DOUBLE) * 100.0 / CAST(greatest(N, 1) AS DOUBLE))"
    return (f"SELECT {q(name)} AS \"check\", "
            f"CAST(CAST(round(CAST({rate} AS DECIMAL(38,10)), 1) AS DECIMAL(38,1)) AS VARCHAR) || '%' AS value, "
            f"CASE WHEN {rate} < 5.0 THEN 'PASS' ELSE 'FAIL' END AS status, round({rate}, 6) AS metric FROM o")


def _zero_row(name: str, expr: str, src: str) -> str:
    return (f"SELECT {q(name)} AS \"check\", CAST({expr} AS VARCHAR) AS value, "
            f"CASE WHEN {expr} = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
            f"round(CAST({expr} AS DOUBLE), 6) AS metric FROM {src}")


SQL["dq_report"] = BOTH_CTE + f""",
o AS ({_dq_orders("silver_orders")}),
e AS ({_dq_emissions("silver_emissions")})
{_rate_row("Null rate CUSTOMER_ID", "N_NULL_CUSTOMER")}
UNION ALL {_rate_row("Null rate TXID", "N_NULL_TXID")}
UNION ALL {_zero_row("Duplicate TXID count", "N - N_DISTINCT_TXID", "o")}
UNION ALL {_zero_row("Future PURCHASE_TIME", "N_FUTURE_PURCHASES", "o")}
UNION ALL {_zero_row("Negative ESTIMATED_EMISSIONS_KGCO2E", "N_NEGATIVE", "e")}
UNION ALL {_zero_row("Future REPORTING_MONTH", "N_FUTURE_REPORTS", "e")}"""

# ------------------------------------------------------------------ merges
EMISSION_UPDATE = [c for c in EMISSION_COLS if c not in ("RECORD_ID", "METADATA")]


def _batch_orders(b: int) -> str:
    return _clean_orders_select(
        f"(SELECT * FROM orders_landing WHERE TXID IS NOT NULL AND BATCH_ID = {b} "
        f"QUALIFY row_number() OVER (PARTITION BY TXID ORDER BY {SEQ_DESC}) = 1)")


def _batch_emissions(b: int) -> str:
    return _clean_emissions_select(
        f"(SELECT * FROM emissions_landing WHERE RECORD_ID IS NOT NULL AND BATCH_ID = {b} "
        f"QUALIFY row_number() OVER (PARTITION BY RECORD_ID ORDER BY {SEQ_DESC}) = 1)")


def _merge_select(key: str, cols: list[str], update: list[str], null_cols: tuple = ()) -> str:
    out = []
    for c in cols:
        if c == key:
            out.append(f"CASE WHEN b0.{key} IS NOT NULL THEN b0.{c} ELSE b1.{c} END AS {c}")
        elif c in null_cols:
            out.append(f"CAST(NULL AS VARCHAR) AS {c}")
        elif c in update:
            out.append(f"CASE WHEN b1.{key} IS NOT NULL THEN b1.{c} ELSE b0.{c} END AS {c}")
        else:
            out.append(f"CASE WHEN b0.{key} IS NOT NULL THEN b0.{c} ELSE b1.{c} END AS {c}")
    return (f"SELECT {', '.join(out)} FROM b0 FULL OUTER JOIN b1 ON b0.{key} = b1.{key}")


SQL["upsert_orders"] = (ORDERS_CTE + f""",
b0 AS ({_batch_orders(0)}),
b1 AS ({_batch_orders(1)})
""" + _merge_select("TXID", ORDER_COLS, ORDER_UPDATE))
SQL["fold_orders"] = SQL["upsert_orders"]
SQL["rebuild_orders"] = SQL["upsert_orders"]
SQL["gold_chain"] = SQL["upsert_orders"]
SQL["serving_chain"] = SQL["upsert_orders"]
SQL["upsert_emissions"] = (EMISSIONS_CTE + f""",
b0 AS ({_batch_emissions(0)}),
b1 AS ({_batch_emissions(1)})
""" + _merge_select("RECORD_ID", EMISSION_COLS, EMISSION_UPDATE, ("METADATA",)))
SQL["fold_emissions"] = SQL["upsert_emissions"]

# ------------------------------------------------------------------ derived columns
def _dec(v: str, t: str = "DECIMAL(4,2)") -> str:
    return f"CAST({v} AS {t})"


def _in_list(values) -> str:
    return ", ".join(q(v) for v in values)


SQL["initcap_items"] = f"SELECT p_partkey, p_name, {initcap_sql('p_name')} AS ITEM FROM part"

_UUID_H = f"sha1(unhex({q(L.NAMESPACE_DNS_HEX)}) || encode(c_name))"
SQL["uuid5_ids"] = f"""
SELECT c_custkey, c_name,
  CASE WHEN c_name IS NULL THEN NULL ELSE
  substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
  translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' ||
  substr(h, 21, 12) END AS CUSTOMER_UUID
FROM (SELECT c_custkey, c_name, {_UUID_H} AS h FROM customer)"""

SQL["product_ids"] = f"""
SELECT p_partkey, p_name,
  CASE WHEN p_name IS NULL THEN NULL ELSE
  substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
  translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' ||
  substr(h, 21, 12) END AS PRODUCT_UUID
FROM (SELECT p_partkey, p_name, sha1(unhex({q(L.NAMESPACE_DNS_HEX)}) || encode(p_name)) AS h FROM part)"""

_ITEMS = list(L.PRICE_MAP)
_COFFEE = _in_list([i.lower() for i in L.COFFEE_ITEMS])
_BASE = ("CASE lower(ITEM) " + " ".join(
    f"WHEN {q(k.lower())} THEN {_dec(v, 'DECIMAL(10,2)')}" for k, v in L.PRICE_MAP.items()) + " END")
_MULT = ("CASE WHEN lower(ITEM) IN (" + _COFFEE + ") THEN (CASE upper(BAG_SIZE) " + " ".join(
    f"WHEN {q(k.upper())} THEN {_dec(v)}" for k, v in L.BAG_SIZE_MULTIPLIER.items())
    + f" END) ELSE {_dec('1.0')} END")
_ORIGIN = ("CASE lower(ITEM) " + " ".join(
    f"WHEN {q(k.lower())} THEN {q(v)}" for k, v in L.ORIGIN_MAP.items()) + " END")
SQL["price"] = f"""
WITH lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS TXID,
    CASE WHEN p_partkey % 2 = 0 THEN {pick(_ITEMS, f'p_partkey % {len(_ITEMS)}')}
         ELSE upper({pick(_ITEMS, f'p_partkey % {len(_ITEMS)}')}) END AS ITEM,
    CASE WHEN p_size <= 16 THEN '250g' WHEN p_size <= 33 THEN '500g' ELSE '1kg' END AS BAG_SIZE,
    CAST(l_quantity AS INTEGER) AS QUANTITY, n_name AS GIVEN_ORIGIN
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey),
priced AS (
  SELECT *, CAST(round({_BASE} * {_MULT}, 2) AS DECIMAL(10,2)) AS UNIT_PRICE FROM lines)
SELECT TXID, ITEM, BAG_SIZE, QUANTITY,
  CASE WHEN lower(ITEM) = {q(L.SINGLE_ORIGIN_ITEM.lower())} THEN GIVEN_ORIGIN
       ELSE coalesce({_ORIGIN}, {q(L.UNKNOWN_ORIGIN)}) END AS ORIGIN_COUNTRY,
  UNIT_PRICE,
  CAST(round(UNIT_PRICE * CAST(QUANTITY AS DECIMAL(10,0)), 2) AS DECIMAL(12,2)) AS TOTAL_PRICE
FROM priced"""

_REGION_OF = lambda c: ("CASE " + c + " " + " ".join(
    f"WHEN {q(k)} THEN {q(v)}" for k, v in L.country_region_pairs()) + " END")
_WH_COUNTRY = case_map("WAREHOUSE", {n: c for n, c in L.ORDER_WAREHOUSES.values()})
SQL["carbon_score"] = with_orders(f"""
, base AS (
  SELECT TXID, COUNTRY, WAREHOUSE, BAG_SIZE, SHIPPING_METHOD, DELIVERY_STATUS, QUANTITY,
    {_WH_COUNTRY} AS WHC FROM orders_landing),
f AS (
  SELECT *,
    CASE WHEN COUNTRY IS NOT DISTINCT FROM WHC THEN {_dec('0.2')}
         WHEN coalesce({_REGION_OF('COUNTRY')}, 'Unknown') = coalesce({_REGION_OF('WHC')}, 'Unknown')
         THEN {_dec('1.0')} ELSE {_dec('1.8')} END AS DISTANCE_FACTOR,
    CASE SHIPPING_METHOD WHEN 'Local Pickup' THEN {_dec('0.2')} WHEN 'EcoDelivery' THEN {_dec('0.8')}
         WHEN 'Express' THEN {_dec('1.4')} ELSE {_dec('1.0')} END AS METHOD_FACTOR,
    CASE upper(BAG_SIZE) WHEN '500G' THEN {_dec('0.15')} WHEN '1KG' THEN {_dec('0.35')}
         ELSE {_dec('0.0')} END AS SIZE_FACTOR,
    CASE DELIVERY_STATUS WHEN 'Canceled' THEN {_dec('0.3')} WHEN 'Returned' THEN {_dec('2.0')}
         ELSE {_dec('1.0')} END AS STATUS_MULTIPLIER
  FROM base)
SELECT TXID, COUNTRY, WAREHOUSE, BAG_SIZE, SHIPPING_METHOD, DELIVERY_STATUS, QUANTITY,
  DISTANCE_FACTOR, METHOD_FACTOR, SIZE_FACTOR, STATUS_MULTIPLIER,
  CAST(round(DISTANCE_FACTOR * METHOD_FACTOR * ({_dec('1.0')} + SIZE_FACTOR)
    * CAST(QUANTITY AS DECIMAL(10,0)) * STATUS_MULTIPLIER, 2) AS DECIMAL(10,2)) AS CARBON_SCORE
FROM f""")

_REGIONS = list(L.REGIONS)
SQL["warehouse_assignment"] = f"""
WITH r AS (SELECT c_custkey, c_nationkey, {pick(_REGIONS, f'c_nationkey % {len(_REGIONS)}')} AS REGION
           FROM customer),
w AS (SELECT *, CASE WHEN REGION IN ({_in_list(L.AMERICAS)})
                     THEN CASE WHEN c_custkey % 2 = 0 THEN {q(L.ORDER_WAREHOUSES['WEST_US'][0])}
                               ELSE {q(L.ORDER_WAREHOUSES['EAST_US'][0])} END
                     WHEN REGION IN ({_in_list(L.EUROPE_AFRICA)}) THEN {q(L.ORDER_WAREHOUSES['PARIS_FR'][0])}
                     ELSE {q(L.ORDER_WAREHOUSES['ASIA_HUB'][0])} END AS WAREHOUSE FROM r)
SELECT *, {_WH_COUNTRY} AS WAREHOUSE_COUNTRY FROM w"""

_WIDS = list(L.EMISSION_WAREHOUSES)
_METHODS = list(L.SHIPPING_METHOD_FACTORS)
_EM_LINES = f"""
lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS RECORD_ID,
    {pick(_WIDS, f'l_suppkey % {len(_WIDS)}')} AS WAREHOUSE_ID,
    {pick(L.COFFEE_ORIGINS, f'l_partkey % {len(L.COFFEE_ORIGINS)}')} AS ORIGIN_COUNTRY,
    {pick(_METHODS, f'l_linenumber % {len(_METHODS)}')} AS SHIPPING_METHOD,
    CAST(l_quantity AS INTEGER) * 10 AS SHIPMENTS_COUNT,
    CAST(50 + 4 * p_size AS DECIMAL(10,2)) AS AVG_BATCH_SIZE_KG
  FROM lineitem JOIN part ON l_partkey = p_partkey),
wh AS (
  SELECT *, {case_map('WAREHOUSE_ID', {k: v[0] for k, v in L.EMISSION_WAREHOUSES.items()})} AS WAREHOUSE_NAME,
    {case_map('WAREHOUSE_ID', {k: v[1] for k, v in L.EMISSION_WAREHOUSES.items()})} AS WAREHOUSE_COUNTRY
  FROM lines),
cls AS (
  SELECT *, CASE WHEN ORIGIN_COUNTRY IS NOT DISTINCT FROM WAREHOUSE_COUNTRY THEN 'Local'
    {' '.join(f"WHEN ORIGIN_COUNTRY IN ({_in_list(v)}) AND WAREHOUSE_COUNTRY = {q(k)} THEN 'Regional'" for k, v in L.REGIONAL_ORIGINS.items())}
    ELSE 'Intercontinental' END AS DISTANCE_CLASS
  FROM wh)"""
SQL["distance_class"] = "WITH " + _EM_LINES.strip() + """
SELECT RECORD_ID, WAREHOUSE_ID, WAREHOUSE_NAME, WAREHOUSE_COUNTRY, ORIGIN_COUNTRY, DISTANCE_CLASS FROM cls"""
_DFAC = "CASE DISTANCE_CLASS " + " ".join(
    f"WHEN {q(k)} THEN {_dec(v)}" for k, v in L.DISTANCE_FACTORS.items()) + " END"
_MFAC = "CASE SHIPPING_METHOD " + " ".join(
    f"WHEN {q(k)} THEN {_dec(v)}" for k, v in L.SHIPPING_METHOD_FACTORS.items()) + " END"
SQL["estimated_emissions"] = "WITH " + _EM_LINES.strip() + f"""
SELECT RECORD_ID, DISTANCE_CLASS, SHIPPING_METHOD, SHIPMENTS_COUNT, AVG_BATCH_SIZE_KG,
  CAST(round({_DFAC} * {_MFAC} * CAST(SHIPMENTS_COUNT AS DECIMAL(10,0))
    * CAST(AVG_BATCH_SIZE_KG AS DECIMAL(10,2)) * {_dec('0.01')}, 2) AS DECIMAL(12,2)) AS ESTIMATED_EMISSIONS_KGCO2E
FROM cls"""

SQL["payment_status_rule"] = with_orders(
    f"SELECT TXID, DELIVERY_STATUS, {PAYMENT_STATUS_SQL} AS PAYMENT_STATUS FROM orders_landing")
SQL["delivery_delay"] = with_orders("""
SELECT TXID, PURCHASE_TIME, DELIVERED_DATE,
  CAST(date_diff('day', PURCHASE_TIME, DELIVERED_DATE) AS INTEGER) AS DELIVERY_DELAY_DAYS
FROM orders_landing""")
SQL["rule_checks"] = with_orders(f"""
SELECT TXID,
  CASE WHEN SHIPPING_METHOD = 'Local Pickup' THEN COUNTRY IS NOT DISTINCT FROM ({_WH_COUNTRY})
       ELSE TRUE END AS PICKUP_OK,
  CASE WHEN DELIVERY_STATUS = 'In Transit'
       THEN coalesce(date_diff('day', PURCHASE_TIME, {ORDERS_AS_OF_DATE}) <= {L.MAX_TRANSIT_AGE_DAYS}, FALSE)
       ELSE TRUE END AS TRANSIT_AGE_OK,
  CASE WHEN lower(ITEM) IN ({_COFFEE}) THEN TRUE
       ELSE NOT (coalesce(FAIR_TRADE_CERTIFIED, FALSE) OR coalesce(ORGANIC_CERTIFIED, FALSE)) END AS CERTIFICATION_OK,
  CASE WHEN DELIVERY_STATUS = 'Canceled' THEN SHIPPED_DATE IS NULL AND DELIVERED_DATE IS NULL
       WHEN DELIVERY_STATUS = 'In Transit' THEN SHIPPED_DATE IS NOT NULL AND DELIVERED_DATE IS NULL
       WHEN DELIVERY_STATUS IN ('Delivered', 'Returned')
       THEN SHIPPED_DATE IS NOT NULL AND DELIVERED_DATE IS NOT NULL
            AND coalesce(DELIVERED_DATE <= SHIPPED_DATE + {L.MAX_DELIVERY_AFTER_SHIP_DAYS}, FALSE)
       ELSE TRUE END AS LIFECYCLE_OK
FROM orders_landing""")

# ------------------------------------------------------------------ ingestion / streaming
SQL["ingest_json"] = with_orders(f"SELECT {', '.join(ORDER_COLS)} FROM orders_landing")
SQL["load_staged_orders"] = SQL["ingest_json"]
SQL["load_staged_emissions"] = with_emissions(
    f"SELECT {', '.join(EMISSION_COLS)} FROM emissions_landing")
SQL["ingest_json_emissions"] = with_emissions(f"""
SELECT {', '.join('WAREHOUSE_NAME AS WAREHOUSE_COUNTRY' if c == 'WAREHOUSE_COUNTRY' else c
                  for c in EMISSION_COLS)}
FROM emissions_landing""")
SQL["ingest_quarantine"] = with_orders("""
SELECT CASE WHEN n % 7 = 0 OR n % 11 = 0 OR n % 13 = 0 OR PURCHASE_TIME IS NULL
            THEN 'quarantine' ELSE 'good' END AS side,
  count(*) AS n_rows, count(DISTINCT TXID) AS n_keys
FROM (SELECT TXID, PURCHASE_TIME,
        CAST(regexp_replace(TXID, '[^0-9]', '', 'g') AS HUGEINT) AS n FROM orders_landing)
GROUP BY 1""")
SQL["stream_pipeline"] = SQL["upsert_orders"]
SQL["stream_pipeline_limited"] = SQL["upsert_orders"]
SQL["upsert_orders_broadcast"] = SQL["upsert_orders"]
SQL["upsert_emissions_broadcast"] = SQL["upsert_emissions"]
SQL["stream_pipeline_emissions"] = SQL["upsert_emissions"]

# Staged by three writers; a third has text prices, every eleventh of them no number.
_STAGED = """SELECT *, CAST(regexp_replace(TXID, '[^0-9]', '', 'g') AS HUGEINT) AS n FROM orders_landing"""
_FITS = "PURCHASE_TIME IS NOT NULL AND NOT (n % 3 = 1 AND n % 11 = 0)"
SQL["load_staged_mixed"] = with_orders(
    f"SELECT {', '.join(ORDER_COLS)} FROM ({_STAGED}) WHERE {_FITS}")
SQL["load_staged_rejects"] = with_orders(f"""
SELECT CASE WHEN PURCHASE_TIME IS NULL THEN 'PURCHASE_TIME is NULL or does not parse'
            ELSE 'UNIT_PRICE does not fit decimal(10,2)' END AS reason, count(*) AS n_rows
FROM ({_STAGED}) WHERE NOT ({_FITS}) GROUP BY 1
UNION ALL SELECT 'unreadable file', 1""")
SQL["load_staged_stream"] = with_orders(f"""
SELECT count(*) FILTER (WHERE {_FITS}) AS raw_rows,
  CAST(sum(TOTAL_PRICE) FILTER (WHERE {_FITS}) AS DOUBLE) AS raw_total,
  count(DISTINCT TXID) FILTER (WHERE {_FITS}) AS serving_rows,
  count(DISTINCT TXID) FILTER (WHERE {_FITS}) AS serving_keys,
  count(*) FILTER (WHERE NOT ({_FITS})) AS rejected_rows, 1 AS broken_files
FROM ({_STAGED})""")
SQL["pipeline_progress"] = with_orders("""
SELECT HOP, BATCH_ID, 'SUCCEEDED' AS STATE, count(DISTINCT TXID) AS ROWS
FROM orders_landing, (VALUES ('silver'), ('gold')) AS h(HOP) GROUP BY HOP, BATCH_ID""")
SQL["pipeline_runs"] = with_orders("""
SELECT 3 * count(DISTINCT BATCH_ID) AS total_runs, 3 * count(DISTINCT BATCH_ID) AS succeeded, 0 AS failed
FROM orders_landing""")

SQL["gold_chain_emissions"] = SQL["upsert_emissions"]
SQL["freshness_all"] = (BOTH_CTE + f""",
b0 AS ({_batch_orders(0)}), b1 AS ({_batch_orders(1)}),
gold_orders AS ({_merge_select("TXID", ORDER_COLS, ORDER_UPDATE)}),
e0 AS ({_batch_emissions(0)}), e1 AS ({_batch_emissions(1)}),
gold_emissions AS ({_merge_select("RECORD_ID", EMISSION_COLS, EMISSION_UPDATE, ("METADATA",))
                    .replace("b0", "e0").replace("b1", "e1")})
""" + "\nUNION ALL ".join(_fresh(*t) for t in _ALL_FRESH + _FRESH_GOLD))
SQL["freshness_stored"] = (ORDERS_CTE + f""",
gold_orders AS ({_batch_orders(0)}),
all_layers AS (""" + "\nUNION ALL ".join(
    _fresh(f"{layer}", f"{layer}_ORDERS", src, "DELIVERED_DATE")
    for layer, src in (("RAW", "orders_landing"), ("SILVER", "silver_orders"), ("GOLD", "gold_orders")))
    + """)
SELECT layer, table_name, row_count, max_event_date, lag_min FROM all_layers""")
SQL["dq_orders_sketched"] = with_orders(
    f"SELECT *, TRUE AS ESTIMATE_OK FROM ({_dq_orders('orders_landing')})")
SQL["warehouse_choices"] = with_emissions("SELECT DISTINCT WAREHOUSE_NAME FROM silver_emissions")


def _long(name: str, key: str | None, count: str | None, amount: str | None) -> str:
    body = SQL[name].removeprefix(ORDERS_CTE)
    k = f"CAST({key} AS VARCHAR)" if key else "CAST(NULL AS VARCHAR)"
    n = f"CAST({count} AS BIGINT)" if count else "CAST(NULL AS BIGINT)"
    a = f"CAST({amount} AS DOUBLE)" if amount else "CAST(NULL AS DOUBLE)"
    inner = body.strip()
    inner = ("WITH " + inner[1:].strip()) if inner.startswith(",") else inner
    return f"SELECT {q(name)} AS report, {k} AS key, {n} AS n, {a} AS amount FROM ({inner})"


SQL["sales_dashboard"] = ORDERS_CTE + "\n" + "\nUNION ALL ".join(_long(*r) for r in [
    ("sales_daily", "PURCHASE_DATE", None, "sales"), ("top_products", "ITEM", None, "sales"),
    ("sales_by_bag", "BAG_SIZE", None, "sales"), ("orders_by_origin", "ORIGIN_COUNTRY", "n_orders", None),
    ("orders_by_region", "REGION", "n_orders", "share_pct"), ("payment_methods", "PAYMENT_METHOD", "n_orders", None),
    ("payment_status", "PAYMENT_STATUS", "n_orders", "share_pct"),
    ("shipping_methods", "SHIPPING_METHOD", "n_orders", None),
    ("delivery_status", "DELIVERY_STATUS", "n_orders", None), ("sales_histogram", "bin", "n_rows", "bin_start"),
    ("delay_histogram", "bin", "n_rows", "bin_start"), ("sales_kpis", None, "total_orders", "total_sales")])

SQL["metadata_fields"] = with_emissions("""
SELECT DISTINCT RECORD_ID, CAST(n % 7 AS INTEGER) AS READING, TRUE AS METADATA_UNSET,
  CAST(n % 5 AS INTEGER) AS LINE, 'meter' AS SOURCE
FROM (SELECT RECORD_ID, CAST(regexp_replace(RECORD_ID, '[^0-9]', '', 'g') AS HUGEINT) AS n
      FROM emissions_landing WHERE ESTIMATED_EMISSIONS_KGCO2E IS NOT NULL)""")

# ------------------------------------------------------------------ rules, with typed literals
# Stated again and not taken from ``lookups``, so that a wrong table there shows.
_SHOP_COUNTRIES = ["United States", "Canada", "Mexico", "Brazil", "Argentina", "Colombia", "Chile", "France",
                   "Germany", "Italy", "Spain", "United Kingdom", "Japan", "China", "India", "Vietnam",
                   "South Korea", "Ethiopia", "Kenya", "South Africa", "Nigeria", "Ghana", "Australia",
                   "New Zealand", "Singapore", "Atlantis"]
_SHOP_ITEMS = ["Signature House Blend", "Bold Awakening Blend", "Golden Morning Blend",
               "Single-Origin Spotlight Blend", "Decaf Dream Blend", "Cold Brew Blend", "Espresso Roast",
               "Customizable Blend", "Limited Edition Seasonal Blends", "Coffee Sampler Box",
               "Organic Matcha Powder", "Golden Turmeric Latte Mix", "Chai Tea Blend",
               "Herbal Relaxation Blend", "Nitro Cold Brew Cans", "Oat Latte Cans", "Instant Coffee Sticks",
               "Reusable Coffee Canisters", "Compostable Coffee Filters", "French Press (Eco-Glass + Bamboo Lid)",
               "Pour-Over Set", "Travel Mugs / Tumblers", "Reusable Cold Brew Bottle",
               "Coffee Scoops (Bamboo or Stainless Steel with Clip)", "Branded Tote Bags",
               "Coffee Grounds Body Scrub"]
_SHOP = f"""WITH base AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS TXID, l_suppkey,
    {pick(_SHOP_COUNTRIES, 'l_partkey % 26')} AS COUNTRY, {pick(_SHOP_ITEMS, 'l_partkey % 26')} AS ITEM,
    {pick(["250g", "500g", "1kg", "N/A"], 'l_suppkey % 4')} AS BAG_SIZE,
    {pick(["Standard", "Express", "EcoDelivery", "Local Pickup"], 'l_linenumber % 4')} AS METHOD,
    {pick(["Canceled", "In Transit", "Delivered", "Returned", "Lost"], 'l_orderkey % 5')} AS STATUS,
    CAST(l_quantity AS INTEGER) AS QUANTITY,
    CASE WHEN l_partkey % 5 <> 4 THEN l_partkey % 3 = 0 END AS FAIR, l_suppkey % 4 = 0 AS ORGANIC,
    CAST(l_shipdate AS DATE) - CAST(l_linenumber AS INTEGER) AS PURCHASE_TIME,
    CASE WHEN l_orderkey % 7 <> 0 THEN CAST(l_shipdate AS DATE) END AS SHIPPED_DATE,
    CASE WHEN l_suppkey % 3 <> 0 THEN CAST(l_shipdate AS DATE) + CAST(l_partkey % 45 AS INTEGER) END AS DELIVERED_DATE
  FROM lineitem),
regioned AS (SELECT *, CASE
    WHEN COUNTRY IN ('United States', 'Canada', 'Mexico') THEN 'North America'
    WHEN COUNTRY IN ('Brazil', 'Argentina', 'Colombia', 'Chile') THEN 'South America'
    WHEN COUNTRY IN ('France', 'Germany', 'Italy', 'Spain', 'United Kingdom') THEN 'Europe'
    WHEN COUNTRY IN ('Japan', 'China', 'India', 'Vietnam', 'South Korea') THEN 'Asia'
    WHEN COUNTRY IN ('Ethiopia', 'Kenya', 'South Africa', 'Nigeria', 'Ghana') THEN 'Africa'
    WHEN COUNTRY IN ('Australia', 'New Zealand') THEN 'Australia' END AS REGION FROM base),
shop AS (SELECT *,
    CASE WHEN REGION IN ('North America', 'South America')
         THEN CASE WHEN l_suppkey % 2 = 0 THEN 'West Coast USA' ELSE 'East Coast USA' END
         WHEN REGION IN ('Europe', 'Africa') THEN 'Paris' ELSE 'Singapore' END AS WAREHOUSE,
    CASE WHEN REGION IN ('North America', 'South America') THEN 'United States'
         WHEN REGION IN ('Europe', 'Africa') THEN 'France' ELSE 'Singapore' END AS WH_COUNTRY
  FROM regioned)
"""
SQL["carbon_score_shop"] = _SHOP + """, f AS (SELECT *,
    CAST(CASE WHEN COUNTRY = WH_COUNTRY THEN 0.2
      WHEN coalesce(REGION, '?') = CASE WH_COUNTRY WHEN 'United States' THEN 'North America'
                                        WHEN 'France' THEN 'Europe' ELSE '?' END THEN 1.0
      ELSE 1.8 END AS DECIMAL(4,2)) AS DISTANCE_FACTOR,
    CAST(CASE METHOD WHEN 'Local Pickup' THEN 0.2 WHEN 'EcoDelivery' THEN 0.8 WHEN 'Express' THEN 1.4
      ELSE 1.0 END AS DECIMAL(4,2)) AS METHOD_FACTOR,
    CAST(CASE BAG_SIZE WHEN '500g' THEN 0.15 WHEN '1kg' THEN 0.35 ELSE 0 END AS DECIMAL(4,2)) AS SIZE_FACTOR,
    CAST(CASE STATUS WHEN 'Canceled' THEN 0.3 WHEN 'Returned' THEN 2.0 ELSE 1.0 END AS DECIMAL(4,2)) AS STATUS_MULTIPLIER
  FROM shop)
SELECT TXID, COUNTRY, REGION, WAREHOUSE, DISTANCE_FACTOR, METHOD_FACTOR, SIZE_FACTOR, STATUS_MULTIPLIER,
  CAST(round(DISTANCE_FACTOR * METHOD_FACTOR * (CAST(1 AS DECIMAL(4,2)) + SIZE_FACTOR)
    * CAST(QUANTITY AS DECIMAL(10,0)) * STATUS_MULTIPLIER, 2) AS DECIMAL(10,2)) AS CARBON_SCORE
FROM f"""
SQL["rule_checks_shop"] = _SHOP + """SELECT TXID,
  CASE WHEN STATUS IN ('Canceled', 'Returned') THEN 'Refunded' WHEN STATUS = 'In Transit' THEN 'Pending'
       ELSE 'Paid' END AS PAYMENT_STATUS,
  CAST(date_diff('day', PURCHASE_TIME, DELIVERED_DATE) AS INTEGER) AS DELIVERY_DELAY_DAYS,
  METHOD <> 'Local Pickup' OR COUNTRY = WH_COUNTRY AS PICKUP_OK,
  STATUS <> 'In Transit' OR date_diff('day', PURCHASE_TIME, DATE '1998-09-01') <= 30 AS TRANSIT_AGE_OK,
  ITEM IN ('Signature House Blend', 'Bold Awakening Blend', 'Golden Morning Blend', 'Single-Origin Spotlight Blend',
    'Decaf Dream Blend', 'Cold Brew Blend', 'Espresso Roast', 'Customizable Blend',
    'Limited Edition Seasonal Blends', 'Organic Matcha Powder', 'Golden Turmeric Latte Mix', 'Chai Tea Blend',
    'Herbal Relaxation Blend', 'Instant Coffee Sticks') OR NOT (coalesce(FAIR, FALSE) OR ORGANIC) AS CERTIFICATION_OK,
  CASE STATUS WHEN 'Canceled' THEN SHIPPED_DATE IS NULL AND DELIVERED_DATE IS NULL
    WHEN 'In Transit' THEN SHIPPED_DATE IS NOT NULL AND DELIVERED_DATE IS NULL WHEN 'Lost' THEN TRUE
    ELSE SHIPPED_DATE IS NOT NULL AND coalesce(DELIVERED_DATE <= SHIPPED_DATE + 30, FALSE) END AS LIFECYCLE_OK
FROM shop"""
_ORIGINS = ["Colombia", "Ethiopia", "Guatemala", "Peru", "Brazil", "Italy", "Japan", "India", "Vietnam", "Kenya",
            "Costa Rica", "Honduras", "Rwanda", "United States", "France", "Singapore"]
SQL["distance_class_shop"] = f"""SELECT *, CASE WHEN ORIGIN_COUNTRY = WAREHOUSE_COUNTRY THEN 'Local'
  WHEN WAREHOUSE_COUNTRY = 'United States' AND ORIGIN_COUNTRY IN ('Colombia', 'Brazil', 'Peru', 'Costa Rica', 'Honduras')
  THEN 'Regional'
  WHEN WAREHOUSE_COUNTRY = 'France' AND ORIGIN_COUNTRY IN ('Italy', 'Ethiopia', 'Kenya', 'Rwanda') THEN 'Regional'
  ELSE 'Intercontinental' END AS DISTANCE_CLASS
FROM (SELECT l_orderkey, l_linenumber, l_partkey,
    {pick(["WEST_US", "EAST_US", "PARIS_FR", "ASIA_HUB"], 'l_suppkey % 4')} AS WAREHOUSE_ID,
    {pick(["United States", "United States", "France", "Singapore"], 'l_suppkey % 4')} AS WAREHOUSE_COUNTRY,
    {pick(_ORIGINS, 'l_partkey % 16')} AS ORIGIN_COUNTRY FROM lineitem)"""
