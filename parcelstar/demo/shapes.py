"""Column expressions that shape the raw feeds; SQL text that Spark and DuckDB share."""

from __future__ import annotations

from parcelstar.constants import STATE_CODES

_STATES = list(STATE_CODES.items())[:25]


# Stands for the index of an array's first element: 0 in Spark, 1 in DuckDB.
FIRST = "@FIRST"


def pick(index: str, values: list[str]) -> str:
    """The value at an index, from a constant array; '' gives NULL.

    A branch per value would make the generated code too large to be compiled.
    """
    return f"nullif(split('{','.join(values)}', ',')[cast({index} AS int) + {FIRST}], '')"


def state_name(key: str) -> str:
    return pick(key, [name for name, _ in _STATES])


def state_code(key: str) -> str:
    return pick(key, [code for _, code in _STATES])


# Bulk listings from orders and customer, with planted defects.
BULK_FROM = "orders JOIN customer ON o_custkey = c_custkey"
BULK_RAW = {
    "brokered_by": "cast(o_custkey AS double)",
    "status": "CASE WHEN o_orderstatus = 'F' THEN 'sold' ELSE 'for_sale' END",
    "price": "CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 41 = 0 THEN -o_totalprice"
             " WHEN o_orderkey % 53 = 0 THEN o_totalprice * 1000 ELSE o_totalprice END",
    "bed": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE cast(o_orderkey % 23 AS double) END",
    "bath": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE cast(o_orderkey % 4 + 1 AS double) END",
    "acre_lot": "CASE WHEN o_orderkey % 9 = 0 THEN NULL"
                " ELSE cast(o_orderkey % 64 AS double) / 64 END",
    "street": "cast(o_custkey % 1000 AS double)",
    "city": "CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE ' ' || c_mktsegment || '  ' END",
    "state": f"' ' || {state_name('c_nationkey')} || ' '",
    "zip_code": "CASE WHEN o_orderkey % 67 = 0 THEN 0"
                " ELSE cast(501 + c_nationkey * 100 + o_custkey % 3 AS double) END",
    "house_size": "CASE WHEN o_orderkey % 13 = 0 THEN NULL"
                  " ELSE cast(500 + o_orderkey % 3000 AS double) END",
    "prev_sold_date": "CASE WHEN o_orderkey % 11 = 0 THEN 'not-a-date'"
                      " ELSE substr(cast(o_orderdate AS string), 1, 10) END",
}

# API listings from lineitem and supplier, with planted defects.
API_FROM = "lineitem JOIN supplier ON l_suppkey = s_suppkey"
API_RAW = {
    "id": "CASE WHEN l_orderkey % 97 = 0 THEN NULL"
          " ELSE cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) END",
    "addressLine1": "cast(l_partkey AS string) || ' ' || "
                    + pick(
                        "l_partkey % 8",
                        ["Main Street", "Oak Avenue", "Sunset Boulevard", "Lake Drive",
                         "Hill Road", "Penny Lane", "Streetside Court", "Street Street Road"],
                    ),
    "city": pick(
        "l_suppkey % 5", ["Household", "Machinery", "Furniture", "Building", "Automobile"]
    ) + " || ' '",
    "state": state_code("s_nationkey"),
    "zipCode": "lpad(cast(501 + s_nationkey * 100 + l_orderkey % 3 AS string), 5, '0')",
    "latitude": "CASE WHEN l_partkey % 29 = 0 THEN NULL WHEN l_partkey % 31 = 0 THEN 60.0e0"
                " ELSE cast(25 + l_partkey % 20 AS double) END",
    "longitude": "CASE WHEN l_suppkey % 13 = 0 THEN 10.0e0"
                 " ELSE cast(-70 - l_partkey % 50 AS double) END",
    "propertyType": pick(
        "l_partkey % 6", ["Single Family", "Condo", "Townhouse", "Multi-Family", "Land", ""]
    ),
    "price": "l_extendedprice",
    "status": "CASE WHEN l_linestatus = 'O' THEN 'Active' ELSE 'Inactive' END",
    "bedrooms": "cast(l_linenumber AS double)",
    "bathrooms": "cast(l_linenumber % 3 + 1 AS double)",
    "squareFootage": "l_quantity * 50",
    "lotSize": "CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE cast(l_partkey AS double) END",
    "daysOnMarket": "CASE WHEN l_linenumber = 7 THEN NULL ELSE cast(l_quantity AS int) END",
    "listedDate": "CASE WHEN l_orderkey % 19 = 0 THEN NULL"
                  " ELSE substr(cast(l_shipdate AS string), 1, 10) || 'T00:00:00.000Z' END",
}

# Monthly market figures per zip code from orders and customer.
MARKET_KEYS = {
    "zip_code": "lpad(cast(501 + c_nationkey * 100 + o_custkey % 3 AS string), 5, '0')",
    "month": "substr(cast(o_orderdate AS string), 1, 7)",
}
MARKET_FIGURES = {
    "medianPrice": "min(o_totalprice)",
    "medianPricePerSquareFoot": "max(o_totalprice) / 1024",
    "medianDaysOnMarket": "cast(count(*) % 60 AS double)",
    "totalListings": "cast(count(*) AS int)",
    "newListings": "cast(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS int)",
}

# Defects planted in a star for the quality checks, by column.
LISTING_DEFECTS = {
    "price": "CASE WHEN cast(floor(price) AS bigint) % 50 = 0 THEN NULL ELSE price END",
    "location_id": "CASE WHEN location_id % 17 = 0 THEN location_id + 1000000 ELSE location_id END",
    "property_type_id": "CASE WHEN property_type_id = 4 AND location_id % 5 = 0 THEN 9"
                        " ELSE property_type_id END",
    "address": "CASE WHEN location_id % 23 = 0 THEN repeat('x', 300) ELSE address END",
}
MARKET_DEFECTS = {
    "location_id": "CASE WHEN location_id % 19 = 0 THEN location_id + 1000000 ELSE location_id END",
}
LOCATION_DEFECTS = {
    "city": "CASE WHEN location_id % 29 = 0 THEN NULL ELSE city END",
    "state": "CASE WHEN location_id % 11 = 0 THEN 'tx' ELSE state END",
}
TWICE = "location_id % 37 = 3 AND location_id % 11 <> 0 AND location_id % 29 <> 0"
ALLOWED = 15

# Rows of a second feed, and the order that a third of the items is put on.
EVERY_SEVENTH = "cast(brokered_by AS bigint) % 7 = 0"
HOT_ORDER = "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_orderkey END"

BATCH_BULK, BATCH_API = "bulk-batch", "api-batch"
INGESTED_AT = "2026-01-01T00:00:00+00:00"


def select_items(columns: dict[str, str], first: int = 0) -> list[str]:
    return [f"{expr} AS {name}".replace(FIRST, str(first)) for name, expr in columns.items()]
