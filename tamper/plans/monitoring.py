"""Pipeline monitoring over run-log tables.

The inputs are tables this library writes itself (run log, load log, metrics),
not a warehouse's account views. Look-back filters fold ``as_of - hours`` into
one literal, so they reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamper.functions.text import ellipsize
from tamper.functions.time import lag_minutes, lookback, seconds_between
from tamper.operators.aggregates import box_stats, round_doubles

# FIXED VALUES: candidate event-date columns for freshness, in order.
FRESHNESS_DATE_COLUMNS = ["DELIVERED_DATE", "CREATED_AT", "DATE", "REPORTING_MONTH", "ORDER_DATE"]


def table_freshness(df: DataFrame, layer: str, table: str, as_of) -> DataFrame:
    """R1 for one table: rows, latest business date of the first known date
    column (NULL when there is none), and its lag in minutes at ``as_of``."""
    col = next((c for c in FRESHNESS_DATE_COLUMNS if c in df.columns), None)
    d = F.max(F.col(col)).cast("date") if col else F.lit(None).cast("date")
    # The business date above is not a load time; tables that carry their
    # ingest time also report when the newest row arrived.
    ing = (F.max(F.col("INGEST_TS")).cast("timestamp_ntz") if "INGEST_TS" in df.columns
           else F.lit(None).cast("timestamp_ntz"))
    agg = df.agg(F.count(F.lit(1)).alias("row_count"), d.alias("max_event_date"),
                 ing.alias("max_ingest_ts"))
    return agg.select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"),
                      "row_count", "max_event_date", "max_ingest_ts",
                      F.round(lag_minutes("max_event_date", as_of), 6).alias("lag_min"))


def freshness(tables: list[tuple[str, str, DataFrame]], as_of) -> DataFrame:
    """Freshness rows of many tables, concatenated (unionByName)."""
    out = None
    for layer, name, df in tables:
        one = table_freshness(df, layer, name, as_of)
        out = one if out is None else out.unionByName(one)
    return out


def statistics_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet reader answers COUNT, MIN and MAX of
    whole files from their footers; the caller's settings stay as they are."""
    quick = spark.newSession()
    for k, v in {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "",
                 "spark.sql.session.timeZone": "UTC"}.items():
        quick.conf.set(k, v)
    return quick


def stored_freshness(spark: SparkSession, tables: list[tuple[str, str, str]], as_of) -> DataFrame:
    """R1/R1b over stored layers (layer, table name, folder): rows and latest business date
    come from the statistics in the file footers, so no data page is read, however large
    the tables. GOLD is read where GOLD is stored: a stale copy shows. The load time is
    the time at which the newest file was written."""
    quick = statistics_session(spark)
    out = None
    for layer, name, path in tables:
        df = quick.read.parquet(path)
        col = next((c for c in FRESHNESS_DATE_COLUMNS if c in df.columns), None)
        d = F.max(F.col(col)) if col else F.lit(None).cast("date")
        files = (quick.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load(path)
                 .agg(F.max("modificationTime").cast("timestamp_ntz").alias("last_load_time")))
        one = df.agg(F.count(F.lit(1)).alias("row_count"), d.alias("max_event_date")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count",
            F.col("max_event_date").cast("date").alias("max_event_date"),
            files.scalar().alias("last_load_time"))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("lag_min", F.round(lag_minutes("max_event_date", as_of), 6))


def query_errors(log: DataFrame, hours: int, as_of) -> DataFrame:
    """R2: failed queries in the look-back window, newest first, with seconds."""
    return (log.where(lookback("START_TIME", hours, as_of) & F.col("ERROR_CODE").isNotNull())
               .select("QUERY_ID", "USER_NAME", "ERROR_CODE", "ERROR_MESSAGE", "START_TIME",
                       (F.col("TOTAL_ELAPSED_TIME").cast("double") / 1000.0).alias("SECS"))
               .orderBy(F.col("START_TIME").desc()))


def task_history(log: DataFrame, hours: int, as_of) -> DataFrame:
    """Job runs completed in the look-back window, newest first."""
    return (log.where(lookback("COMPLETED_TIME", hours, as_of))
               .select("NAME", "DATABASE_NAME", "SCHEMA_NAME", "STATE", "COMPLETED_TIME",
                       seconds_between("QUERY_START_TIME", "COMPLETED_TIME").alias("DURATION_SEC"),
                       "ERROR_CODE", "ERROR_MESSAGE")
               .orderBy(F.col("COMPLETED_TIME").desc()))


def task_summary(runs: DataFrame) -> DataFrame:
    """Total, succeeded and failed runs."""
    return runs.agg(F.count(F.lit(1)).alias("total_runs"),
                    F.count_if(F.col("STATE") == "SUCCEEDED").alias("succeeded"),
                    F.count_if(F.col("STATE") == "FAILED").alias("failed"))


def task_status_counts(runs: DataFrame) -> DataFrame:
    """Runs per state."""
    return (runs.where(F.col("STATE").isNotNull()).groupBy("STATE")
                .agg(F.count(F.lit(1)).alias("COUNT")))


def task_duration_box(runs: DataFrame, exact: bool = True) -> DataFrame:
    """Duration box plot per task label (name cut to 30 characters) and state."""
    labelled = runs.withColumn("TASK_LABEL", ellipsize("NAME", 30))
    return round_doubles(box_stats(labelled, ["TASK_LABEL", "STATE"], "DURATION_SEC", exact=exact))


def failed_tasks(runs: DataFrame) -> DataFrame:
    """Failed runs with readable column names."""
    return runs.where(F.col("STATE") == "FAILED").select(
        F.col("DATABASE_NAME").alias("Database"),
        F.col("SCHEMA_NAME").alias("Schema"),
        F.col("NAME").alias("Task Name"),
        F.col("ERROR_CODE").alias("Error Code"),
        F.col("ERROR_MESSAGE").alias("Error Message"),
        F.col("COMPLETED_TIME").alias("Completed Time"))


def ingest_throughput(usage: DataFrame, pipes: list[str], hours: int, as_of) -> DataFrame:
    """Bytes, files and errors per named pipe in the window, newest first."""
    return (usage.where(lookback("START_TIME", hours, as_of) & F.col("PIPE_NAME").isin(pipes))
                 .select("PIPE_NAME", "START_TIME", "BYTES_INSERTED", "FILES_INSERTED", "ERROR_COUNT")
                 .orderBy(F.col("START_TIME").desc()))


def load_errors(history: DataFrame, hours: int, as_of, tables: list[str] | None = None
                ) -> DataFrame:
    """Loaded files with a first error, per table, newest first, all
    tables in one frame with the table name in front."""
    cond = lookback("LAST_LOAD_TIME", hours, as_of) & F.col("FIRST_ERROR_MESSAGE").isNotNull()
    if tables is not None:
        cond = cond & F.col("TABLE_NAME").isin(tables)
    return (history.where(cond)
                   .select(F.col("TABLE_NAME").alias("TABLE_FQN"), "FILE_NAME", "LAST_LOAD_TIME",
                           "ROW_COUNT", "FIRST_ERROR_MESSAGE")
                   .orderBy("TABLE_FQN", F.col("LAST_LOAD_TIME").desc()))


def cluster_load(metrics: DataFrame, warehouse: str, hours: int, as_of) -> DataFrame:
    """Mean queued / blocked / running per time and warehouse, unpivoted to
    (TS, WAREHOUSE_NAME, metric, value)."""
    wide = (metrics.where(lookback("TIME_RANGE_START", hours, as_of)
                          & (F.col("WAREHOUSE_NAME") == warehouse))
                   .groupBy(F.col("TIME_RANGE_START").alias("TS"), "WAREHOUSE_NAME")
                   .agg(F.avg("QUEUED_LOAD_PERCENT").alias("QUEUED"),
                        F.avg("BLOCKED_PERCENT").alias("BLOCKED"),
                        F.avg("RUNNING").alias("RUNNING")))
    return round_doubles(wide.unpivot(["TS", "WAREHOUSE_NAME"], ["QUEUED", "BLOCKED", "RUNNING"],
                                      "metric", "value"))
