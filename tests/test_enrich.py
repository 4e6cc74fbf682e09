import datetime as dt
from decimal import Decimal

from tamper.functions import enrich


def test_price_half_up(spark):
    df = spark.createDataFrame(
        [("Single-Origin Spotlight Blend", "1kg", 2), ("customizable blend", "1KG", 1),
         ("Pour-Over Set", "N/A", 3), ("Pour-Over Set", "1kg", 1), ("unknown", "250g", 1)],
        "ITEM string, BAG_SIZE string, QUANTITY int")
    rows = enrich.with_price(df).collect()
    assert rows[0]["UNIT_PRICE"] == Decimal("52.47") and rows[0]["TOTAL_PRICE"] == Decimal("104.94")
    # Trap T5: 16.99 x 3.5 = 59.465 -> 59.47 (HALF_UP), not 59.46.
    assert rows[1]["UNIT_PRICE"] == Decimal("59.47")
    assert rows[2]["TOTAL_PRICE"] == Decimal("89.97")
    # Non-coffee items never scale by bag size.
    assert rows[3]["UNIT_PRICE"] == Decimal("29.99")
    assert rows[4]["UNIT_PRICE"] is None and rows[4]["TOTAL_PRICE"] is None


def test_origin(spark):
    df = spark.createDataFrame([("Espresso Roast", None), ("Single-Origin Spotlight Blend", "Kenya"),
                                ("Branded Tote Bags", "x")], "ITEM string, ORIGIN_COUNTRY string")
    got = [r["ORIGIN_COUNTRY"] for r in enrich.with_origin(df).collect()]
    assert got == ["Italy", "Kenya", "N/A"]


def test_carbon_score_worked_value(spark):
    # Spain is in Europe like Paris/France: same region 1.0; Express 1.4;
    # 1kg 0.35; quantity 2; Delivered 1.0 -> 3.78.
    df = spark.createDataFrame([("Spain", "Paris", "1kg", "Express", "Delivered", 2),
                                ("France", "Paris", "250g", "Local Pickup", "Canceled", 1),
                                ("Japan", "Singapore", "500g", "Standard", "Returned", 3)],
                               "COUNTRY string, WAREHOUSE string, BAG_SIZE string, "
                               "SHIPPING_METHOD string, DELIVERY_STATUS string, QUANTITY int")
    got = [r["CARBON_SCORE"] for r in enrich.with_carbon_score(df).collect()]
    # 0.2*0.2*1*1*0.3 = 0.012 -> 0.01 ; Singapore is in no region -> 1.8*1.0*1.15*3*2.0 = 12.42
    assert got == [Decimal("3.78"), Decimal("0.01"), Decimal("12.42")]


def test_region_and_warehouse(spark):
    df = spark.createDataFrame([(1, "Canada"), (2, "Kenya"), (3, "Japan"), (4, "Atlantis")],
                               "k long, COUNTRY string")
    df = enrich.with_region(df, "COUNTRY", "REGION")
    rows = enrich.assign_warehouse(df, "REGION", "k", "WAREHOUSE", "WH_COUNTRY").collect()
    assert [r["REGION"] for r in rows] == ["North America", "Africa", "Asia", None]
    assert rows[0]["WAREHOUSE"] in ("West Coast USA", "East Coast USA")
    assert [r["WAREHOUSE"] for r in rows[1:]] == ["Paris", "Singapore", "Singapore"]
    assert rows[1]["WH_COUNTRY"] == "France"


def test_emissions_worked_value(spark):
    df = spark.createDataFrame([("PARIS_FR", "Ethiopia", "EcoDelivery", 100, Decimal("120.00")),
                                ("ASIA_HUB", "Singapore", "Express", 10, Decimal("50.00")),
                                ("WEST_US", "Kenya", "Teleport", 10, Decimal("50.00"))],
                               "WAREHOUSE_ID string, ORIGIN_COUNTRY string, SHIPPING_METHOD string, "
                               "SHIPMENTS_COUNT int, AVG_BATCH_SIZE_KG decimal(10,2)")
    df = enrich.with_estimated_emissions(enrich.with_distance_class(enrich.with_warehouse(df)))
    rows = df.collect()
    assert [r["WAREHOUSE_NAME"] for r in rows] == ["Paris", "Asia Hub", "West Coast USA"]
    assert [r["DISTANCE_CLASS"] for r in rows] == ["Regional", "Local", "Intercontinental"]
    assert rows[0]["ESTIMATED_EMISSIONS_KGCO2E"] == Decimal("96.00")
    assert rows[1]["ESTIMATED_EMISSIONS_KGCO2E"] == Decimal("1.40")
    assert rows[2]["ESTIMATED_EMISSIONS_KGCO2E"] is None


def test_payment_status_and_delay(spark):
    df = spark.createDataFrame([("Canceled", None, dt.date(2025, 1, 1)),
                                ("Delivered", dt.date(2025, 1, 9), dt.date(2025, 1, 1)),
                                ("In Transit", None, dt.date(2025, 1, 1)),
                                ("Lost", None, dt.date(2025, 1, 1))],
                               "DELIVERY_STATUS string, DELIVERED_DATE date, PURCHASE_TIME date")
    rows = enrich.with_delay(enrich.with_payment_status(df)).collect()
    assert [r["PAYMENT_STATUS"] for r in rows] == ["Refunded", "Paid", "Pending", "Paid"]
    assert [r["DELIVERY_DELAY_DAYS"] for r in rows] == [None, 8, None, None]


def test_rule_checks(spark):
    d = dt.date
    df = spark.createDataFrame(
        [("Local Pickup", "Spain", "France", "Canceled", d(2025, 1, 2), None, "Pour-Over Set", True),
         ("Local Pickup", "France", "France", "Delivered", d(2025, 1, 2), d(2025, 2, 5), "Espresso Roast", True),
         ("Standard", "Spain", "France", "In Transit", d(2025, 1, 2), None, "Espresso Roast", False)],
        "m string, c string, w string, s string, sh date, dl date, item string, ft boolean")
    rows = df.select(
        enrich.check_pickup("c", "w", "m").alias("pickup"),
        enrich.check_lifecycle("s", "sh", "dl").alias("life"),
        enrich.check_certification("item", "ft", "ft").alias("cert"),
        enrich.check_transit_age("sh", "s", dt.date(2025, 1, 20)).alias("age")).collect()
    assert [r["pickup"] for r in rows] == [False, True, True]
    # canceled with a shipping date; delivered 34 days after shipping
    assert [r["life"] for r in rows] == [False, False, True]
    assert [r["cert"] for r in rows] == [False, True, True]
    assert [r["age"] for r in rows] == [True, True, True]


def test_region_dimension_with_duplicates_never_multiplies_rows(spark):
    orders = spark.createDataFrame([(1, "NATION_1"), (2, "NATION_2"), (3, None)],
                                   "k long, COUNTRY string")
    dim = spark.createDataFrame([("NATION_1", "AMERICA"), ("NATION_1", "ASIA"),
                                 ("NATION_2", "EUROPE")], "country string, region string")
    out = enrich.with_region(orders, "COUNTRY", "REGION", regions=dim)
    assert out.count() == 3
    assert {r.k: r.REGION for r in out.collect()} == {1: "AMERICA", 2: "EUROPE", 3: None}
