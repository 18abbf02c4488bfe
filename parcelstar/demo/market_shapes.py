"""More shaped feeds: snapshots of listings, property records, market documents, coordinates.

SQL text that Spark and DuckDB share, as in `shapes`.
"""

from __future__ import annotations

# Four snapshots of the API listings: prices change, listings appear, go and come back.
LOAD_DATES = ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"]
ORDER = "cast(split_part(id, '-', 1) AS bigint)"
LINE = "cast(split_part(id, '-', 2) AS bigint)"
LISTED = f"({LINE} <= 5 OR n >= 2) AND NOT ({ORDER} % 11 = 0 AND n IN (2, 3))"
SNAPSHOT = {
    "id": "id",
    "price": f"CASE WHEN {ORDER} % 5 = 0 AND n >= 2 AND NOT ({ORDER} % 10 = 0 AND n = 4)"
             " THEN price + 1000 ELSE price END",
    "status": f"CASE WHEN {ORDER} % 7 = 0 AND n = 4 THEN 'Inactive' ELSE status END",
}

# What a place is known for, month by month.
PLACE_ATTRIBUTES = {
    "price_level": "cast(floor(median_listing_price / 20000) AS bigint)",
    "busy": "total_listings > 2",
}

# Property records from customers and their orders, by year.
YEARLY = {
    "year": "substr(cast(o_orderdate AS string), 1, 4)",
    "value": "max(o_totalprice)",
    "land": "min(o_totalprice)",
    "total": "cast(count(*) AS double) * 250",
}
ASSESSED = "(o_custkey + cast(year AS bigint)) % 4 <> 0 AND o_custkey % 10 <> 0"
TAXED = "(o_custkey + cast(year AS bigint)) % 3 <> 0"
SOLD = "o_orderstatus = 'F' AND o_custkey % 7 <> 0"

# Market documents from items and suppliers; entries without a type are in no breakdown.
STATISTICS = {
    "averagePrice": "cast(sum(cast(price AS decimal(18,4))) AS double) / count(price)",
    "medianPrice": "min(price)",
    "minPrice": "min(price)",
    "maxPrice": "max(price)",
    "averageDaysOnMarket": "cast(sum(\"daysOnMarket\") AS double) / nullif(count(\"daysOnMarket\"), 0)",
    "newListings": "cast(sum(CASE WHEN status = 'Active' THEN 1 ELSE 0 END) AS int)",
    "totalListings": "cast(count(*) AS int)",
}

# Statements on a zip code and month: three files, of which the later two correct some months.
# Each has the months whose listings its modulus divides, a date, and what it adds to prices.
FILES = {"first": (1, "2025-01-10", 0), "corrections": (3, "2025-02-10", 1000), "late": (2, "2025-01-20", 500)}

# Coordinates of orders: a third lies within a mile, many at the same places.
HOT = "o_orderkey % 3 = 0"
LATITUDE = (
    f"CASE WHEN {HOT} THEN 40.0e0 + (o_custkey % 97) / 20000.0e0"
    " ELSE 25.0e0 + (o_orderkey * 7919 % 20011) / 10000.0e0 END"
)
LONGITUDE = (
    f"CASE WHEN {HOT} THEN -75.0e0 - (o_orderkey % 89) / 20000.0e0"
    " ELSE -100.0e0 + (o_orderkey * 104729 % 19997) / 10000.0e0 END"
)
MILES, NEAREST = 10.0, 5
