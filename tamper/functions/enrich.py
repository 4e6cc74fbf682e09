"""Derived business columns and rule checks.

All lookups are literal ``map`` expressions over the fixed tables in
``lookups`` (no join, no UDF); the one lookup that can come from data
(country -> region) also accepts a dimension DataFrame, joined without a hint so
that Spark's measured-size rule (and AQE at run time) decides on broadcast.
Money and factors are decimals rounded HALF_UP, so results are exact and equal
in every engine that does decimal arithmetic.
"""

from __future__ import annotations

import functools
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamper.functions import lookups as L

FACTOR = "decimal(4,2)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(pairs, value_type: str | None = None) -> Column:
    """A ``map`` literal of fixed pairs (built once per argument set: each
    literal is a call into the JVM)."""
    return _literal_map(tuple((k, v) for k, v in pairs), value_type)


@functools.lru_cache(maxsize=64)
def _literal_map(pairs: tuple, value_type: str | None) -> Column:
    args = []
    for k, v in pairs:
        args.append(F.lit(k))
        val = F.lit(Decimal(v)) if value_type and value_type.startswith("decimal") else F.lit(v)
        args.append(val.cast(value_type) if value_type else val)
    return F.create_map(*args)


def _lookup(mapping: Column, key: Column) -> Column:
    return F.try_element_at(mapping, key)


def _dec(v: str, t: str = FACTOR) -> Column:
    return F.lit(Decimal(v)).cast(t)


# ---------------------------------------------------------------- orders: price
def base_price(item) -> Column:
    m = literal_map([(k.lower(), v) for k, v in L.PRICE_MAP.items()], "decimal(10,2)")
    return _lookup(m, F.lower(_col(item)))


def is_coffee(item) -> Column:
    return F.lower(_col(item)).isin([i.lower() for i in L.COFFEE_ITEMS])


def bag_multiplier(item, bag) -> Column:
    """Coffee/tea items scale by bag size; every other item by 1.0."""
    m = literal_map([(k.upper(), v) for k, v in L.BAG_SIZE_MULTIPLIER.items()], FACTOR)
    return F.when(is_coffee(item), _lookup(m, F.upper(_col(bag)))).otherwise(_dec("1.0"))


def with_price(df: DataFrame, item="ITEM", bag="BAG_SIZE", qty="QUANTITY",
               unit_out="UNIT_PRICE", total_out="TOTAL_PRICE") -> DataFrame:
    """unit = round(base x bag multiplier, 2), total = round(unit x qty, 2).
    Unknown item -> NULL prices."""
    unit = F.round(base_price(item) * bag_multiplier(item, bag), 2).cast("decimal(10,2)")
    df = df.withColumn(unit_out, unit)
    total = F.round(F.col(unit_out) * _col(qty).cast("decimal(10,0)"), 2).cast("decimal(12,2)")
    return df.withColumn(total_out, total)


def with_origin(df: DataFrame, item="ITEM", given="ORIGIN_COUNTRY", out="ORIGIN_COUNTRY") -> DataFrame:
    """Origin by item; the single-origin item keeps its given origin;
    unknown items get ``N/A``."""
    m = literal_map([(k.lower(), v) for k, v in L.ORIGIN_MAP.items()])
    key = F.lower(_col(item))
    origin = (F.when(key == L.SINGLE_ORIGIN_ITEM.lower(), _col(given))
              .otherwise(F.coalesce(_lookup(m, key), F.lit(L.UNKNOWN_ORIGIN))))
    return df.withColumn(out, origin)


# ------------------------------------------------------- regions and warehouses
def region_of(country) -> Column:
    """G6 over the fixed country table; unknown -> NULL."""
    return _lookup(literal_map(L.country_region_pairs()), _col(country))


def with_region(df: DataFrame, country="COUNTRY", out="REGION_OF_COUNTRY",
                regions: DataFrame | None = None) -> DataFrame:
    """Region of a country. ``regions`` (columns country, region) replaces
    the fixed table; it is made unique per country first, so the left join can
    never multiply rows."""
    if regions is None:
        return df.withColumn(out, region_of(country))
    dim = (regions.groupBy(F.col("country").alias("__country"))
           .agg(F.min("region").alias(out)))
    return (df.join(dim, _col(country) == F.col("__country"), "left").drop("__country"))


def order_warehouse_country(warehouse) -> Column:
    m = literal_map([(name, country) for name, country in L.ORDER_WAREHOUSES.values()])
    return _lookup(m, _col(warehouse))


def assign_warehouse(df: DataFrame, region="REGION", key="TXID", out="WAREHOUSE",
                     country_out: str | None = None, chooser: Column | None = None) -> DataFrame:
    """Americas -> one of the two US sites, Europe/Africa -> Paris,
    anything else -> Asia hub. The US site is picked by ``chooser`` (0 = west,
    1 = east), by default a hash of the key, so the choice is repeatable."""
    wh = L.ORDER_WAREHOUSES
    r = _col(region)
    pick = chooser if chooser is not None else F.pmod(F.xxhash64(_col(key)), F.lit(2))
    name = (F.when(r.isin(L.AMERICAS),
                   F.when(pick == 0, F.lit(wh["WEST_US"][0]))
                   .otherwise(F.lit(wh["EAST_US"][0])))
            .when(r.isin(L.EUROPE_AFRICA), F.lit(wh["PARIS_FR"][0]))
            .otherwise(F.lit(wh["ASIA_HUB"][0])))
    df = df.withColumn(out, name)
    if country_out:
        df = df.withColumn(country_out, order_warehouse_country(out))
    return df


# ------------------------------------------------------------ carbon score G11+
def distance_factor(dest_country, wh_country, dest_region, wh_region) -> Column:
    dr = F.coalesce(_col(dest_region), F.lit(L.UNKNOWN_REGION))
    wr = F.coalesce(_col(wh_region), F.lit(L.UNKNOWN_REGION))
    return (F.when(_col(dest_country).eqNullSafe(_col(wh_country)), _dec(L.ORDER_DISTANCE_SAME_COUNTRY))
            .when(dr == wr, _dec(L.ORDER_DISTANCE_SAME_REGION))
            .otherwise(_dec(L.ORDER_DISTANCE_OTHER)))


def method_factor(method) -> Column:
    m = _col(method)
    out = None
    for name, v in L.ORDER_METHOD_FACTORS.items():
        out = F.when(m == name, _dec(v)) if out is None else out.when(m == name, _dec(v))
    return out.otherwise(_dec(L.ORDER_METHOD_DEFAULT))


def size_factor(bag) -> Column:
    b = F.upper(_col(bag))
    out = None
    for name, v in L.SIZE_FACTORS.items():
        out = F.when(b == name.upper(), _dec(v)) if out is None else out.when(b == name.upper(), _dec(v))
    return out.otherwise(_dec(L.SIZE_FACTOR_DEFAULT))


def status_multiplier(status) -> Column:
    s = _col(status)
    out = None
    for name, v in L.STATUS_MULTIPLIERS.items():
        out = F.when(s == name, _dec(v)) if out is None else out.when(s == name, _dec(v))
    return out.otherwise(_dec(L.STATUS_MULTIPLIER_DEFAULT))


def with_carbon_score(df: DataFrame, dest_country="COUNTRY", warehouse="WAREHOUSE",
                      bag="BAG_SIZE", method="SHIPPING_METHOD", status="DELIVERY_STATUS",
                      qty="QUANTITY", out="CARBON_SCORE", regions: DataFrame | None = None,
                      keep_factors: bool = False) -> DataFrame:
    """round(distance x method x (1 + size) x quantity x status, 2).

    Distance: same country 0.2, same region 1.0 (two unknown regions count as
    the same), else 1.8. The warehouse's country comes from its name."""
    df = df.withColumn("__wh_country", order_warehouse_country(warehouse))
    df = with_region(df, dest_country, "__dest_region", regions)
    df = with_region(df, "__wh_country", "__wh_region", regions)
    df = (df.withColumn("DISTANCE_FACTOR", distance_factor(dest_country, "__wh_country",
                                                           "__dest_region", "__wh_region"))
          .withColumn("METHOD_FACTOR", method_factor(method))
          .withColumn("SIZE_FACTOR", size_factor(bag))
          .withColumn("STATUS_MULTIPLIER", status_multiplier(status)))
    score = F.round(F.col("DISTANCE_FACTOR") * F.col("METHOD_FACTOR")
                    * (_dec("1.0") + F.col("SIZE_FACTOR"))
                    * _col(qty).cast("decimal(10,0)") * F.col("STATUS_MULTIPLIER"), 2)
    df = df.withColumn(out, score.cast("decimal(10,2)"))
    drop = ["__wh_country", "__dest_region", "__wh_region"]
    if not keep_factors:
        drop += ["DISTANCE_FACTOR", "METHOD_FACTOR", "SIZE_FACTOR", "STATUS_MULTIPLIER"]
    return df.drop(*drop)


# --------------------------------------------------------- payment and delivery
def payment_status(status) -> Column:
    """G17."""
    s = _col(status)
    out = None
    for name, v in L.PAYMENT_STATUS.items():
        out = F.when(s == name, F.lit(v)) if out is None else out.when(s == name, F.lit(v))
    return out.otherwise(F.lit(L.PAYMENT_STATUS_DEFAULT))


def with_payment_status(df: DataFrame, status="DELIVERY_STATUS", out="PAYMENT_STATUS") -> DataFrame:
    return df.withColumn(out, payment_status(status))


def delivery_delay(delivered, purchase) -> Column:
    """Days from purchase to delivery; NULL when not delivered."""
    return F.datediff(_col(delivered), _col(purchase))


def with_delay(df: DataFrame, delivered="DELIVERED_DATE", purchase="PURCHASE_TIME",
               out="DELIVERY_DELAY_DAYS") -> DataFrame:
    return df.withColumn(out, delivery_delay(delivered, purchase))


# ------------------------------------------------------------------ rule checks
def check_pickup(country, wh_country, method) -> Column:
    """Local Pickup only when customer and warehouse country are equal."""
    return F.when(_col(method) == "Local Pickup",
                  _col(country).eqNullSafe(_col(wh_country))).otherwise(F.lit(True))


def check_transit_age(purchase, status, as_of) -> Column:
    """In Transit only for orders at most 30 days old at ``as_of``."""
    from tamper.functions.time import date_literal

    age = F.datediff(date_literal(as_of), _col(purchase))
    return F.when(_col(status) == "In Transit",
                  F.coalesce(age <= L.MAX_TRANSIT_AGE_DAYS, F.lit(False))).otherwise(F.lit(True))


def check_certification(item, fair_trade, organic) -> Column:
    """Certification flags only on coffee/tea items."""
    flagged = F.coalesce(_col(fair_trade), F.lit(False)) | F.coalesce(_col(organic), F.lit(False))
    return F.when(is_coffee(item), F.lit(True)).otherwise(~flagged)


def check_lifecycle(status, shipped, delivered) -> Column:
    """Canceled has no dates; In Transit is shipped only; Delivered and
    Returned have both, delivered at most 30 days after shipping."""
    s, sh, dl = _col(status), _col(shipped), _col(delivered)
    both = (sh.isNotNull() & dl.isNotNull()
            & F.coalesce(dl <= F.date_add(sh, L.MAX_DELIVERY_AFTER_SHIP_DAYS), F.lit(False)))
    return (F.when(s == "Canceled", sh.isNull() & dl.isNull())
            .when(s == "In Transit", sh.isNotNull() & dl.isNull())
            .when(s.isin("Delivered", "Returned"), both)
            .otherwise(F.lit(True)))


# -------------------------------------------------------------------- emissions
def with_warehouse(df: DataFrame, wid="WAREHOUSE_ID", name_out="WAREHOUSE_NAME",
                   country_out="WAREHOUSE_COUNTRY") -> DataFrame:
    """Emission warehouse by id (never by name: one site has two names)."""
    names = literal_map([(k, v[0]) for k, v in L.EMISSION_WAREHOUSES.items()])
    countries = literal_map([(k, v[1]) for k, v in L.EMISSION_WAREHOUSES.items()])
    return (df.withColumn(name_out, _lookup(names, _col(wid)))
              .withColumn(country_out, _lookup(countries, _col(wid))))


def distance_class(origin, wh_country) -> Column:
    """Local / Regional / Intercontinental."""
    o, w = _col(origin), _col(wh_country)
    out = F.when(o.eqNullSafe(w), F.lit("Local"))
    for country, origins in L.REGIONAL_ORIGINS.items():
        out = out.when(o.isin(origins) & (w == country), F.lit("Regional"))
    return out.otherwise(F.lit("Intercontinental"))


def with_distance_class(df: DataFrame, origin="ORIGIN_COUNTRY", wh_country="WAREHOUSE_COUNTRY",
                        out="DISTANCE_CLASS") -> DataFrame:
    return df.withColumn(out, distance_class(origin, wh_country))


def with_estimated_emissions(df: DataFrame, dclass="DISTANCE_CLASS", method="SHIPPING_METHOD",
                             shipments="SHIPMENTS_COUNT", avg_kg="AVG_BATCH_SIZE_KG",
                             out="ESTIMATED_EMISSIONS_KGCO2E") -> DataFrame:
    """round(distance x method x shipments x avg_kg / 100, 2); an unknown
    class or method gives NULL."""
    dmap = literal_map(L.DISTANCE_FACTORS.items(), FACTOR)
    mmap = literal_map(L.SHIPPING_METHOD_FACTORS.items(), FACTOR)
    est = F.round(_lookup(dmap, _col(dclass)) * _lookup(mmap, _col(method))
                  * _col(shipments).cast("decimal(10,0)") * _col(avg_kg).cast("decimal(10,2)")
                  * _dec("0.01"), 2)
    return df.withColumn(out, est.cast("decimal(12,2)"))
