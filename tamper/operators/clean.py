"""Filters, cleaning and de-duplication."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamper.functions.text import initcap_words
from tamper.functions.time import null_if_future, null_if_negative
from tamper.schemas import ORDER_KEY, EMISSION_KEY, SEQ_COLUMNS


def split_valid(df: DataFrame, required: Iterable[str], corrupt_col: str | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """Bad rows never stop a load; they go to the second frame (quarantine).

    A row is bad when a required column is NULL or the reader flagged it as
    corrupt. Both sides are plain filters over the same input, so Spark scans
    once per side without shuffling."""
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    if corrupt_col and corrupt_col in df.columns:
        cond = cond & F.col(corrupt_col).isNull()
    good = df.where(cond)
    bad = df.where(~F.coalesce(cond, F.lit(False)))
    if corrupt_col and corrupt_col in df.columns:
        good = good.drop(corrupt_col)
    return good, bad


def drop_null_keys(df: DataFrame, key: str = ORDER_KEY) -> DataFrame:
    """C1."""
    return df.where(F.col(key).isNotNull())


def latest_per_key(df: DataFrame, keys: str | list[str], order_by: list[str] | None = None
                   ) -> DataFrame:
    """The last row per key by a total order (all columns descending).

    ``row_number() = 1`` is planned as a WindowGroupLimit: every map task keeps
    only its own top row per key before the shuffle, so even a key holding a
    third of all rows sends at most one row per input partition."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_by = order_by or [c for c in SEQ_COLUMNS if c in df.columns]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1).drop("__rn"))


def clean_orders(df: DataFrame, as_of) -> DataFrame:
    """Proper-case ITEM, upper-case BAG_SIZE, NULL out dates after
    ``as_of``."""
    return df.withColumns({
        "ITEM": initcap_words("ITEM"),
        "BAG_SIZE": F.upper("BAG_SIZE"),
        "PURCHASE_TIME": null_if_future("PURCHASE_TIME", as_of),
        "SHIPPED_DATE": null_if_future("SHIPPED_DATE", as_of),
        "DELIVERED_DATE": null_if_future("DELIVERED_DATE", as_of),
    })


def clean_emissions(df: DataFrame) -> DataFrame:
    """A negative emission estimate becomes NULL."""
    return df.withColumn("ESTIMATED_EMISSIONS_KGCO2E",
                         null_if_negative("ESTIMATED_EMISSIONS_KGCO2E"))


def silver_source_orders(raw: DataFrame, as_of, order_by: list[str] | None = None) -> DataFrame:
    """The source of the RAW->SILVER order merge: non-NULL keys, latest row
    per TXID, cleaned."""
    return clean_orders(latest_per_key(drop_null_keys(raw, ORDER_KEY), ORDER_KEY, order_by), as_of)


def silver_source_emissions(raw: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """The source of the RAW->SILVER emission merge. NULL keys never match a
    MERGE and are routed to quarantine (see ``split_valid``) instead."""
    return clean_emissions(latest_per_key(drop_null_keys(raw, EMISSION_KEY), EMISSION_KEY, order_by))


def filter_in(df: DataFrame, filters: dict[str, list | None]) -> DataFrame:
    """AND of IN-lists. ``None`` means no filter on that column (rows with
    NULL stay); an empty list selects nothing. A NULL inside a list matches
    NULL cells, as a multiselect over the column's unique values does."""
    cond: Column = F.lit(True)
    for c, values in filters.items():
        if values is None:
            continue
        values = list(values)
        non_null = [v for v in values if v is not None]
        term = F.col(c).isin(non_null) if non_null else F.lit(False)
        if len(non_null) != len(values):
            term = term | F.col(c).isNull()
        cond = cond & F.coalesce(term, F.lit(False))
    return df.where(cond)


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """The choices of a filter (NULL included, like a column's uniques)."""
    return df.select(c).distinct()
