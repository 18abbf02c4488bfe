"""DuckDB statements that give the same rows as `history`, written on their own."""

from __future__ import annotations

from parcelstar.demo import market_shapes as m
from parcelstar.demo.oracles import _ORDER_TYPES, _TYPES, _with
from parcelstar.demo.oracles import ORACLES as BASE
from parcelstar.demo.shapes import FIRST, state_code

_LOADS = ", ".join(f"({n}, DATE '{day}')" for n, day in enumerate(m.LOAD_DATES, start=1))

_VERSIONS = f"""
    , base AS (
        SELECT id, price, status FROM api
        QUALIFY row_number() OVER (
            PARTITION BY id ORDER BY price DESC NULLS LAST, status DESC NULLS LAST) = 1),
    grid AS (
        SELECT {", ".join(f"{sql} AS {c}" for c, sql in m.SNAPSHOT.items())}, n, day, {m.LISTED} AS here
        FROM base CROSS JOIN (VALUES {_LOADS}) AS loads(n, day)),
    marked AS (
        SELECT *, here AND (lag(here) OVER w IS NOT TRUE OR lag(price) OVER w IS DISTINCT FROM price
                            OR lag(status) OVER w IS DISTINCT FROM status) AS starts
        FROM grid WINDOW w AS (PARTITION BY id ORDER BY n)),
    versions AS (
        SELECT *, min(CASE WHEN starts OR NOT here THEN day END) OVER (
            PARTITION BY id ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS valid_to
        FROM marked)
"""

_MARKET = """
    , market AS (
        SELECT zip_code, CASE WHEN "totalListings" % 7 = 0 THEN NULL
                              ELSE cast(month || '-01' AS date) END AS snapshot_date,
               "medianPrice" AS median_listing_price, "totalListings" AS total_listings
        FROM monthly)
"""

_YEARLY = f"""
    yearly AS (
        SELECT o_custkey, {", ".join(f"{sql} AS {c}" for c, sql in m.YEARLY.items())}
        FROM orders GROUP BY o_custkey, 2),
    sales AS (
        SELECT o_custkey, substr(day, 1, 4) AS year, arg_max(price, day) AS sale_price
        FROM (SELECT o_custkey, substr(cast(o_orderdate AS varchar), 1, 10) AS day,
                     max(o_totalprice) AS price
              FROM orders WHERE {m.SOLD} GROUP BY 1, 2)
        GROUP BY 1, 2),
    assessed AS (SELECT * FROM yearly WHERE {m.ASSESSED}),
    taxed AS (SELECT * FROM yearly WHERE {m.TAXED}),
    years AS (
        SELECT o_custkey, year FROM assessed UNION SELECT o_custkey, year FROM taxed
        UNION SELECT o_custkey, year FROM sales),
    aligned AS (
        SELECT o_custkey, year, a.value, a.land, a.value - a.land AS improvements, t.total, sale_price,
               lag(a.value IGNORE NULLS) OVER w AS prior,
               lag(CASE WHEN a.value IS NOT NULL THEN year END IGNORE NULLS) OVER w AS prior_year
        FROM years JOIN customer ON c_custkey = o_custkey
             LEFT JOIN assessed a USING (o_custkey, year) LEFT JOIN taxed t USING (o_custkey, year)
             LEFT JOIN sales USING (o_custkey, year)
        WINDOW w AS (PARTITION BY o_custkey ORDER BY year))
"""


def _statistics() -> str:
    return ", ".join(f'{sql} AS "{c}"' for c, sql in m.STATISTICS.items())


def _entries() -> str:
    details = {
        "all": ("cast(NULL AS varchar)", "true"),
        "property_type": ('"propertyType"', '"propertyType" IS NOT NULL'),
        "bedrooms": ("cast(cast(bedrooms AS int) AS varchar)", "bedrooms IS NOT NULL"),
        "month": ('substr("listedDate", 1, 7)', '"listedDate" IS NOT NULL'),
    }
    return " UNION ALL ".join(
        f"SELECT \"zipCode\" AS zip_code, '{kind}' AS kind, {detail} AS detail, {_statistics()}"
        f" FROM api_raw WHERE {condition} GROUP BY 1, 3"
        for kind, (detail, condition) in details.items()
    )


def _weighted(value: str) -> str:
    weighted = f'sum(cast("{value}" * "totalListings" AS decimal(18,4)))'
    listings = f'sum(CASE WHEN "{value}" IS NOT NULL THEN "totalListings" END)'
    return f"cast({weighted} AS double) / nullif({listings}, 0)"


def _files() -> str:
    return " UNION ALL ".join(
        f"SELECT zip_code, detail AS month, '{day}' AS updated, \"medianPrice\" + {more} AS median_price,"
        f" \"totalListings\" AS total_listings FROM entries"
        f" WHERE kind = 'month' AND \"totalListings\" % {modulus} = 0"
        for modulus, day, more in m.FILES.values()
    )


_SALES = f"""
    sales AS (
        SELECT o_orderkey, o_orderpriority, o_totalprice, {m.LATITUDE} AS lat, {m.LONGITUDE} AS lon
        FROM orders),
    met AS (
        SELECT a.o_orderkey, b.o_orderkey AS comparable_id, b.o_totalprice,
               round(2 * 3958.8 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2)
                   + cos(radians(a.lat)) * cos(radians(b.lat))
                     * pow(sin(radians(b.lon - a.lon) / 2), 2))), 6) AS distance
        FROM sales a JOIN sales b ON a.o_orderpriority = b.o_orderpriority
             AND b.lat BETWEEN a.lat - {m.MILES} / 69 AND a.lat + {m.MILES} / 69
             AND a.o_orderkey <> b.o_orderkey),
    best AS (
        SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY distance, comparable_id) AS rank
        FROM met WHERE distance <= {m.MILES}
        QUALIFY rank <= {m.NEAREST})
"""

ORACLES: dict[str, str] = {
    "listing_versions": _with(
        ["api"],
        f"{_VERSIONS} SELECT id, price, status, day AS valid_from, valid_to FROM versions WHERE starts",
    ),
    "listings_as_of": _with(
        ["api"],
        f"""{_VERSIONS} SELECT id, price, status FROM versions WHERE starts
            AND day <= DATE '2024-02-15' AND (valid_to IS NULL OR valid_to > DATE '2024-02-15')""",
    ),
    "place_versions": _with(
        ["monthly"],
        f"""{_MARKET},
        known AS (
            SELECT zip_code, snapshot_date,
                   {", ".join(f"{sql} AS {c}" for c, sql in m.PLACE_ATTRIBUTES.items())}
            FROM market WHERE snapshot_date IS NOT NULL),
        starts AS (
            SELECT * FROM known WINDOW w AS (PARTITION BY zip_code ORDER BY snapshot_date)
            QUALIFY row_number() OVER w = 1 OR lag(price_level) OVER w IS DISTINCT FROM price_level
                 OR lag(busy) OVER w IS DISTINCT FROM busy)
        SELECT zip_code, price_level, busy, snapshot_date AS valid_from,
               lead(snapshot_date) OVER (PARTITION BY zip_code ORDER BY snapshot_date) AS valid_to
        FROM starts""",
    ),
    "value_at_date": _with(
        ["api", "monthly"],
        f"""{_MARKET},
        listed AS (SELECT id, zip_code, price, cast(substr("listedDate", 1, 10) AS date) AS listed_date
                   FROM api),
        dated AS (SELECT * FROM market WHERE snapshot_date IS NOT NULL)
        SELECT id, l.zip_code, price, listed_date, median_listing_price, total_listings
        FROM listed l ASOF LEFT JOIN dated d
             ON l.zip_code = d.zip_code AND l.listed_date >= d.snapshot_date""",
    ),
    "property_values": f"""
        WITH {_YEARLY}
        SELECT 'c-' || o_custkey AS rentcast_id, cast(year AS int) AS year, value AS assessed_value,
               land AS land_value, improvements AS improvement_value, total AS tax_total, sale_price,
               CASE WHEN value IS NOT NULL THEN cast(prior_year AS int) END AS prior_year,
               value - prior AS value_change,
               round((value - prior) / nullif(prior, 0) * 100, 2) + 0.0 AS value_pct_change,
               round(total / nullif(value, 0) * 100, 4) AS tax_pct
        FROM aligned
    """,
    "property_details": _with(
        ["dim"],
        f""", records AS (
            SELECT c_custkey, lower(trim(c_mktsegment)) AS city,
                   {state_code("c_nationkey").replace(FIRST, "1")} AS code,
                   lpad(cast(501 + c_nationkey * 100 + c_custkey % 3 AS varchar), 5, '0') AS zip_code,
                   CASE c_custkey % 4 WHEN 0 THEN 'condo' WHEN 2 THEN 'townhouse' ELSE 'unknown' END
                       AS property_type
            FROM customer),
        placed AS (SELECT r.*, name AS state FROM records r JOIN codes ON codes.code = lower(r.code))
        SELECT 'c-' || c_custkey AS rentcast_id, location_id, property_type_id,
               c_custkey || ' Main St' AS address, cast(1950 + c_custkey % 70 AS int) AS year_built,
               c_custkey % 2 = 0 AS cooling
        FROM placed JOIN (VALUES {_TYPES}) AS t(property_type_id, property_type) USING (property_type)
             LEFT JOIN dim USING (city, state, zip_code)""",
    ),
    "market_breakdown": _with(
        ["api_raw"],
        f""", entries AS ({_entries()}),
        places AS (SELECT "zipCode" AS zip_code, min(state) AS state FROM api_raw GROUP BY 1)
        SELECT cast(grouping(state) * 2 + grouping(detail) AS int) AS level, state, kind, detail,
               cast(sum("totalListings") AS bigint) AS listings,
               cast(sum("newListings") AS bigint) AS new_listings,
               {_weighted("averagePrice")} AS avg_price,
               {_weighted("averageDaysOnMarket")} AS avg_days_on_market,
               min("minPrice") AS min_price, max("maxPrice") AS max_price
        FROM entries JOIN places USING (zip_code)
        GROUP BY GROUPING SETS ((state, kind, detail), (state, kind), (kind, detail), (kind))""",
    ),
    "market_breakdown_gaps": _with(
        ["api_raw"],
        f""", entries AS ({_entries()}), sums AS (
            SELECT zip_code,
                   coalesce(sum("totalListings") FILTER (kind = 'all'), 0) AS listings,
                   coalesce(sum("totalListings") FILTER (kind = 'property_type'), 0) AS by_type,
                   coalesce(sum("totalListings") FILTER (kind = 'bedrooms'), 0) AS by_bedrooms
            FROM entries GROUP BY zip_code)
        SELECT zip_code, cast(listings AS bigint) AS listings, cast(by_type AS bigint) AS by_type,
               cast(by_bedrooms AS bigint) AS by_bedrooms
        FROM sums WHERE listings <> by_type OR listings <> by_bedrooms""",
    ),
    "market_ingest": _with(
        ["api_raw"],
        f""", entries AS ({_entries()}), said AS ({_files()})
        SELECT * FROM said
        QUALIFY row_number() OVER (PARTITION BY zip_code, month ORDER BY updated DESC) = 1""",
    ),
    "nearest_comparables": f"""
        WITH {_SALES}
        SELECT o_orderkey, cast(rank AS int) AS rank, comparable_id, distance, o_totalprice FROM best
    """,
    "profile_by_batch": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,"
        " true AS distinct_is_close, true AS median_is_close FROM orders"
        for c in _ORDER_TYPES
    ),
    "latest_by_stream": BASE["market_latest"],
    "valuations": f"""
        WITH {_SALES}
        SELECT o_orderkey, cast(count(*) AS int) AS comparable_count,
               round(sum(o_totalprice ORDER BY rank) / count(*), 4) AS estimate,
               min(o_totalprice) AS range_low, max(o_totalprice) AS range_high
        FROM best GROUP BY o_orderkey
    """,
}
