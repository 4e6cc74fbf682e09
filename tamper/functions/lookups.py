"""Business lookup tables.

FIXED VALUES: the catalogue, origins, bag multipliers, regions, warehouses and
emission factors below must equal the source system's values for results to
match; they are stated here as plain data, in their natural order.

They are tiny and fixed in size, so operators turn them into literal
``map`` expressions (``element_at(map, key)``) that stay inside whole-stage
codegen instead of becoming joins.
"""

from __future__ import annotations

from decimal import Decimal

# ---- FIXED VALUES: product catalogue (item -> base price) -------------------
PRICE_MAP = {
    "Signature House Blend": "12.99",
    "Bold Awakening Blend": "13.99",
    "Golden Morning Blend": "11.49",
    "Single-Origin Spotlight Blend": "14.99",
    "Decaf Dream Blend": "12.49",
    "Cold Brew Blend": "15.99",
    "Espresso Roast": "13.49",
    "Customizable Blend": "16.99",
    "Limited Edition Seasonal Blends": "18.99",
    "Coffee Sampler Box": "22.99",
    "Organic Matcha Powder": "19.99",
    "Golden Turmeric Latte Mix": "17.99",
    "Chai Tea Blend": "12.99",
    "Herbal Relaxation Blend": "11.99",
    "Nitro Cold Brew Cans": "3.49",
    "Oat Latte Cans": "3.99",
    "Instant Coffee Sticks": "7.99",
    "Reusable Coffee Canisters": "24.99",
    "Compostable Coffee Filters": "9.99",
    "French Press (Eco-Glass + Bamboo Lid)": "34.99",
    "Pour-Over Set": "29.99",
    "Travel Mugs / Tumblers": "21.99",
    "Reusable Cold Brew Bottle": "25.99",
    "Coffee Scoops (Bamboo or Stainless Steel with Clip)": "8.99",
    "Branded Tote Bags": "14.99",
    "Coffee Grounds Body Scrub": "18.49",
}

# ---- FIXED VALUES: coffee / tea items (sold by bag size) --------------------
COFFEE_ITEMS = [
    "Signature House Blend", "Bold Awakening Blend", "Golden Morning Blend",
    "Single-Origin Spotlight Blend", "Decaf Dream Blend", "Cold Brew Blend",
    "Espresso Roast", "Customizable Blend", "Limited Edition Seasonal Blends",
    "Organic Matcha Powder", "Golden Turmeric Latte Mix", "Chai Tea Blend",
    "Herbal Relaxation Blend", "Instant Coffee Sticks",
]

# ---- FIXED VALUES: origin country by item -----------------------------------
ORIGIN_MAP = {
    "Signature House Blend": "Colombia",
    "Bold Awakening Blend": "Ethiopia",
    "Golden Morning Blend": "Guatemala",
    "Decaf Dream Blend": "Peru",
    "Cold Brew Blend": "Brazil",
    "Espresso Roast": "Italy",
    "Customizable Blend": "Blend (Multiple Origins)",
    "Limited Edition Seasonal Blends": "Varies by Season",
    "Organic Matcha Powder": "Japan",
    "Golden Turmeric Latte Mix": "India",
    "Chai Tea Blend": "India",
    "Herbal Relaxation Blend": "Various",
    "Instant Coffee Sticks": "Brazil",
}
# The one item whose origin varies per order; it keeps the origin it was given.
SINGLE_ORIGIN_ITEM = "Single-Origin Spotlight Blend"
UNKNOWN_ORIGIN = "N/A"

# ---- FIXED VALUES: bag size multipliers -------------------------------------
BAG_SIZE_MULTIPLIER = {"250g": "1.0", "500g": "1.8", "1kg": "3.5", "N/A": "1.0"}

# ---- FIXED VALUES: regions and their countries ------------------------------
REGIONS = {
    "North America": ["United States", "Canada", "Mexico"],
    "South America": ["Brazil", "Argentina", "Colombia", "Chile"],
    "Europe": ["France", "Germany", "Italy", "Spain", "United Kingdom"],
    "Asia": ["Japan", "China", "India", "Vietnam", "South Korea"],
    "Africa": ["Ethiopia", "Kenya", "South Africa", "Nigeria", "Ghana"],
    "Australia": ["Australia", "New Zealand"],
}
UNKNOWN_REGION = "Unknown"

# ---- FIXED VALUES: order warehouses (id -> name, country) -------------------
ORDER_WAREHOUSES = {
    "WEST_US": ("West Coast USA", "United States"),
    "EAST_US": ("East Coast USA", "United States"),
    "PARIS_FR": ("Paris", "France"),
    "ASIA_HUB": ("Singapore", "Singapore"),
}
# Region groups served by each warehouse choice.
AMERICAS = ["North America", "South America"]
EUROPE_AFRICA = ["Europe", "Africa"]

# ---- FIXED VALUES: emission-report warehouses (id -> name, country) ---------
EMISSION_WAREHOUSES = {
    "WEST_US": ("West Coast USA", "United States"),
    "EAST_US": ("East Coast USA", "United States"),
    "PARIS_FR": ("Paris", "France"),
    "ASIA_HUB": ("Asia Hub", "Singapore"),
}

# ---- FIXED VALUES: coffee origins of the emission reports -------------------
COFFEE_ORIGINS = [
    "Colombia", "Ethiopia", "Guatemala", "Peru", "Brazil", "Italy",
    "Japan", "India", "Vietnam", "Kenya", "Costa Rica", "Honduras", "Rwanda",
]

# ---- FIXED VALUES: emission factors -----------------------------------------
DISTANCE_FACTORS = {"Local": "0.2", "Regional": "1.0", "Intercontinental": "1.8"}
SHIPPING_METHOD_FACTORS = {"Local Pickup": "0.2", "EcoDelivery": "0.8",
                           "Standard": "1.0", "Express": "1.4"}
# Origins that count as "Regional" for a warehouse country.
REGIONAL_ORIGINS = {
    "United States": ["Colombia", "Brazil", "Peru", "Costa Rica", "Honduras"],
    "France": ["France", "Italy", "Ethiopia", "Kenya", "Rwanda"],
}

# ---- FIXED VALUES: order carbon-score factors --------------------------------
ORDER_DISTANCE_SAME_COUNTRY = "0.2"
ORDER_DISTANCE_SAME_REGION = "1.0"
ORDER_DISTANCE_OTHER = "1.8"
ORDER_METHOD_FACTORS = {"Local Pickup": "0.2", "EcoDelivery": "0.8", "Express": "1.4"}
ORDER_METHOD_DEFAULT = "1.0"
SIZE_FACTORS = {"500g": "0.15", "1kg": "0.35"}
SIZE_FACTOR_DEFAULT = "0.0"
STATUS_MULTIPLIERS = {"Canceled": "0.3", "Returned": "2.0"}
STATUS_MULTIPLIER_DEFAULT = "1.0"
MAX_TRANSIT_AGE_DAYS = 30
MAX_DELIVERY_AFTER_SHIP_DAYS = 30

# ---- FIXED VALUES: payment status by delivery status -------------------------
PAYMENT_STATUS = {"Canceled": "Refunded", "Returned": "Refunded",
                  "Delivered": "Paid", "In Transit": "Pending"}
PAYMENT_STATUS_DEFAULT = "Paid"

# ---- FIXED VALUES: UUIDv5 DNS namespace (RFC 4122, appendix C) --------------
NAMESPACE_DNS_HEX = "6ba7b8109dad11d180b400c04fd430c8"


def country_region_pairs() -> list[tuple[str, str]]:
    """(country, region) rows of REGIONS, first region wins on a repeat."""
    seen: dict[str, str] = {}
    for region, countries in REGIONS.items():
        for c in countries:
            seen.setdefault(c, region)
    return list(seen.items())


def dec(x: str) -> Decimal:
    return Decimal(x)
