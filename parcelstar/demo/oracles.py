"""DuckDB statements that give the same rows as `queries`, written on their own."""

from __future__ import annotations

from parcelstar.demo import shapes

# Fixed values of the contract, written out here on their own.
_STATE_PAIRS = (
    "alabama al,alaska ak,arizona az,arkansas ar,california ca,colorado co,connecticut ct,"
    "delaware de,florida fl,georgia ga,hawaii hi,idaho id,illinois il,indiana in,iowa ia,"
    "kansas ks,kentucky ky,louisiana la,maine me,maryland md,massachusetts ma,michigan mi,"
    "minnesota mn,mississippi ms,missouri mo,montana mt,nebraska ne,nevada nv,"
    "new hampshire nh,new jersey nj,new mexico nm,new york ny,north carolina nc,"
    "north dakota nd,ohio oh,oklahoma ok,oregon or,pennsylvania pa,rhode island ri,"
    "south carolina sc,south dakota sd,tennessee tn,texas tx,utah ut,vermont vt,virginia va,"
    "washington wa,west virginia wv,wisconsin wi,wyoming wy"
)
_CODES = ", ".join(
    f"('{pair.rpartition(' ')[2]}', '{pair.rpartition(' ')[0]}')" for pair in _STATE_PAIRS.split(",")
)
_TYPES = (
    "(1::bigint, 'studio'), (2, 'single_family'), (3, 'multi_family'), (4, 'condo'),"
    " (5, 'townhouse'), (6, 'unknown')"
)
_SUFFIXES = [
    ("Street", "St"), ("Avenue", "Ave"), ("Boulevard", "Blvd"), ("Drive", "Dr"),
    ("Road", "Rd"), ("Lane", "Ln"), ("Court", "Ct"),
]


def _select_list(columns: dict[str, str]) -> str:
    return ", ".join(shapes.select_items(columns, first=1))


def _short_street(text: str) -> str:
    for word, short in _SUFFIXES:
        text = f"regexp_replace({text}, '\\b{word}\\b', '{short}')"
    return text


def _mean(value: str, condition: str = "true") -> str:
    """Fixed-point mean of the rows that meet a condition."""
    chosen = f"CASE WHEN {condition} THEN {value} END"
    return (
        f"cast(sum(cast({chosen} AS decimal(18,4))) AS double) / nullif(count({chosen}), 0)"
    )


# Common table expressions in dependency order.
_CTES = {
    "bulk_raw": f"SELECT {_select_list(shapes.BULK_RAW)} FROM {shapes.BULK_FROM}",
    "api_raw": f"SELECT {_select_list(shapes.API_RAW)} FROM {shapes.API_FROM}",
    "codes": f"SELECT * FROM (VALUES {_CODES}) AS t(code, name)",
    "types": f"SELECT * FROM (VALUES {_TYPES}) AS t(property_type_id, property_type)",
    "bulk": """
        SELECT * REPLACE (
            lower(trim(city)) AS city,
            lower(trim(state)) AS state,
            lpad(cast(cast(zip_code AS bigint) AS varchar), 5, '0') AS zip_code,
            try_cast(prev_sold_date AS date) AS prev_sold_date)
        FROM bulk_raw
        WHERE price > 0 AND price <= 100000000 AND (bed IS NULL OR bed <= 20)
          AND city IS NOT NULL AND state IS NOT NULL AND zip_code > 0
          AND (bed IS NOT NULL OR bath IS NOT NULL)
    """,
    "api": f"""
        SELECT r.* EXCLUDE (city, state, "zipCode"),
               lower(trim(city)) AS city,
               coalesce(codes.name, lower(state)) AS state,
               "zipCode" AS zip_code,
               {_short_street('"addressLine1"')} AS address
        FROM api_raw r LEFT JOIN codes ON codes.code = lower(r.state)
        WHERE id IS NOT NULL
          AND (latitude IS NULL OR latitude BETWEEN 24.0 AND 49.5)
          AND (longitude IS NULL
               OR longitude BETWEEN -125.0 AND -66.0)
    """,
    "bulk_typed": """
        SELECT *, CASE WHEN bed = 0 THEN 'studio' WHEN bed <= 4 THEN 'single_family'
                       WHEN bed >= 5 THEN 'multi_family' ELSE 'unknown' END AS property_type
        FROM bulk
    """,
    "api_typed": """
        SELECT *, CASE "propertyType" WHEN 'Single Family' THEN 'single_family'
                       WHEN 'Condo' THEN 'condo' WHEN 'Townhouse' THEN 'townhouse'
                       WHEN 'Multi-Family' THEN 'multi_family' ELSE 'unknown' END AS property_type
        FROM api
    """,
    "dim_bulk": """
        SELECT row_number() OVER (ORDER BY state, city, zip_code) AS location_id, *
        FROM (SELECT DISTINCT city, state, zip_code FROM bulk)
    """,
    "dim_api": """
        SELECT row_number() OVER (ORDER BY state, city, zip_code) AS location_id, *
        FROM (SELECT DISTINCT city, state, zip_code FROM api)
    """,
    "dim": """
        SELECT row_number() OVER (ORDER BY state, city, zip_code) AS location_id, *
        FROM (SELECT city, state, zip_code FROM bulk UNION SELECT city, state, zip_code FROM api)
    """,
    "fact": f"""
        SELECT location_id, property_type_id, price, status, 'kaggle' AS source,
               '{shapes.BATCH_BULK}' AS batch_id, bed, bath, acre_lot, house_size,
               prev_sold_date, cast(cast(brokered_by AS bigint) AS varchar) AS brokered_by,
               NULL AS rentcast_id, NULL AS address, NULL AS bedrooms, NULL AS bathrooms,
               NULL AS square_footage, NULL AS lot_size, NULL AS latitude, NULL AS longitude,
               NULL AS days_on_market, NULL AS listed_date
        FROM bulk_typed JOIN dim USING (city, state, zip_code) JOIN types USING (property_type)
        UNION ALL
        SELECT location_id, property_type_id, price, status, 'rentcast',
               '{shapes.BATCH_API}', NULL, NULL, NULL, NULL, NULL, NULL,
               id, address, bedrooms, bathrooms, "squareFootage", "lotSize", latitude, longitude,
               "daysOnMarket", cast(substr("listedDate", 1, 10) AS date)
        FROM api_typed JOIN dim USING (city, state, zip_code) JOIN types USING (property_type)
    """,
    "monthly": f"""
        SELECT {_select_list(shapes.MARKET_KEYS | shapes.MARKET_FIGURES)}
        FROM {shapes.BULK_FROM}
        GROUP BY 1, 2
    """,
    "stats": """
        SELECT location_id,
               CASE WHEN "totalListings" % 7 = 0 THEN NULL
                    ELSE cast(month || '-01' AS date) END AS snapshot_date,
               "medianPrice" AS median_listing_price,
               "medianPricePerSquareFoot" AS median_price_per_sqft,
               "medianDaysOnMarket" AS median_days_on_market,
               "totalListings" AS total_listings,
               "newListings" AS new_listings
        FROM monthly LEFT JOIN dim USING (zip_code)
    """,
}

_USES = {
    "bulk": ["bulk_raw"],
    "api": ["api_raw", "codes"],
    "bulk_typed": ["bulk"],
    "api_typed": ["api"],
    "dim_bulk": ["bulk"],
    "dim_api": ["api"],
    "dim": ["bulk", "api"],
    "fact": ["bulk_typed", "api_typed", "dim", "types"],
    "stats": ["monthly", "dim"],
}


def _with(names: list[str], query: str) -> str:
    """The query after the common table expressions it needs."""
    needed, todo = set(), list(names)
    while todo:
        name = todo.pop()
        needed.add(name)
        todo += _USES.get(name, [])
    parts = [f"{name} AS ({sql})" for name, sql in _CTES.items() if name in needed]
    return f"WITH {', '.join(parts)} {query}"


_KAGGLE, _RENTCAST = "source = 'kaggle'", "source = 'rentcast'"

_FEED_MEANS = f"""
    kaggle AS (SELECT location_id, {_mean('price')} AS avg_kaggle_price
               FROM fact WHERE {_KAGGLE} GROUP BY location_id),
    rentcast AS (SELECT location_id, {_mean('price')} AS avg_rentcast_price
                 FROM fact WHERE {_RENTCAST} GROUP BY location_id)
"""

_GAP = """
    avg_kaggle_price, avg_rentcast_price,
    avg_rentcast_price - avg_kaggle_price AS price_gap,
    round((avg_rentcast_price - avg_kaggle_price) / nullif(avg_kaggle_price, 0) * 100, 2)
        AS pct_change
"""

_LANDED = """
    SELECT lower(trim(state)) AS state, count(*) AS record_count, count(city) AS with_city,
           cast(sum(cast(price AS decimal(18,4))) AS double) AS price_total
    FROM bulk_raw GROUP BY 1
"""

def _remap_unscoped() -> str:
    staged = """
        staged AS (SELECT 'kaggle' AS feed, * FROM dim_bulk
                   UNION ALL SELECT 'rentcast', * FROM dim_api),
        staged_fact AS (
            SELECT 'kaggle' AS source, location_id
            FROM bulk JOIN dim_bulk USING (city, state, zip_code)
            UNION ALL
            SELECT 'rentcast', location_id FROM api JOIN dim_api USING (city, state, zip_code))
    """
    query = """
        SELECT f.source, dim.location_id, count(*) AS listing_count
        FROM staged_fact f JOIN staged s ON f.location_id = s.location_id
             JOIN dim ON s.city = dim.city AND s.state = dim.state AND s.zip_code = dim.zip_code
        GROUP BY 1, 2
    """
    return _with(["dim_bulk", "dim_api", "dim"], f", {staged} {query}")


def _defects(table: str, columns: dict[str, str]) -> str:
    changed = ", ".join(f"{sql} AS {c}" for c, sql in columns.items())
    return f"SELECT * REPLACE ({changed}) FROM {table}"


def _quality(allowed: int = shapes.ALLOWED) -> str:
    planted = f"""
        bad_fact AS ({_defects('fact', shapes.LISTING_DEFECTS)}),
        bad_stats AS ({_defects('stats', shapes.MARKET_DEFECTS)}),
        bad_dim AS ({_defects('dim', shapes.LOCATION_DEFECTS)}
            UNION ALL SELECT * REPLACE (location_id + 500000 AS location_id) FROM dim
            WHERE {shapes.TWICE})
    """
    checks = {
        "null_price_fact_listings": "SELECT count(*) FROM bad_fact WHERE price IS NULL",
        "orphan_fk_location_fact_listings":
            "SELECT count(*) FROM bad_fact WHERE location_id NOT IN (SELECT location_id FROM bad_dim)",
        "orphan_fk_property_type_fact_listings":
            "SELECT count(*) FROM bad_fact WHERE property_type_id NOT BETWEEN 1 AND 6",
        "text_too_long_fact_listings": "SELECT count(*) FROM bad_fact WHERE length(address) > 200",
        "orphan_fk_location_fact_market_stats":
            "SELECT count(*) FROM bad_stats WHERE coalesce(location_id, -1)"
            " NOT IN (SELECT location_id FROM bad_dim)",
        "null_location_fields_dim_location":
            "SELECT count(*) FROM bad_dim WHERE city IS NULL OR state IS NULL OR zip_code IS NULL",
        "state_code_dim_location": "SELECT count(*) FROM bad_dim WHERE length(state) <= 2",
        "duplicate_natural_key_dim_location":
            "SELECT count(*) FROM (SELECT 1 FROM bad_dim GROUP BY city, state, zip_code"
            " HAVING count(*) > 1)",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS name, ({sql}) AS value" for name, sql in checks.items()
    )
    return _with(
        ["fact", "stats"],
        f", {planted} SELECT name, value, value <= {allowed} AS passed FROM ({rows})",
    )


def _null_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count"
        " FROM bulk_raw WHERE price IS NOT NULL OR state IS NOT NULL OR zip_code IS NOT NULL"
        for c in shapes.BULK_RAW
    )


_ORDER_TYPES = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
    "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}


_EMPTY_MARKET = {
    "location_id": "bigint", "snapshot_date": "date", "median_listing_price": "double",
    "median_price_per_sqft": "double", "median_days_on_market": "double",
    "total_listings": "int", "new_listings": "int", "source": "string", "batch_id": "string",
    "ingested_at": "string",
}


def _profile() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{kind}' AS column_type, count(*) AS row_count,"
        f" count(*) - count({c}) AS null_count FROM orders"
        for c, kind in _ORDER_TYPES.items()
    )


def _extremes() -> str:
    def shown(value: str, kind: str) -> str:
        return f"printf('%.6f', {value})" if kind == "double" else f"cast({value} AS varchar)"

    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {shown(f'min({c})', kind)} AS min_value,"
        f" {shown(f'max({c})', kind)} AS max_value FROM orders"
        for c, kind in _ORDER_TYPES.items()
    )


_KNOWN_MONTHS = "SELECT count(*) FROM monthly JOIN dim_api USING (zip_code)"
# Months of zip codes without an API listing, and those of the unknown zip code.
_LOST_MONTHS = """
    SELECT (SELECT count(*) FROM monthly LEFT JOIN dim_api USING (zip_code) WHERE city IS NULL)
         + (SELECT count(*) FROM monthly WHERE zip_code = (SELECT min(zip_code) FROM monthly))
"""
_LOADED = {
    ("all", "dim_location"): "SELECT count(*) FROM dim",
    ("kaggle", "fact_listings"): "SELECT count(*) FROM fact WHERE source = 'kaggle'",
    ("rentcast", "fact_listings"): "SELECT count(*) FROM fact WHERE source = 'rentcast'",
    # Staged market rows see the API feed's locations only.
    ("rentcast", "fact_market_stats"): _KNOWN_MONTHS,
}


def _load_audit() -> str:
    rows = [
        f"SELECT cast({run} AS bigint) AS run, '{source}' AS source, '{table}' AS table_name,"
        f" {f'({sql})' if run == 1 else '0::bigint'} AS row_count,"
        f" {f'({_LOST_MONTHS})' if table == 'fact_market_stats' and run == 1 else '0::bigint'}"
        " AS dropped_rows, 'SUCCESS' AS status"
        for run in (1, 2)
        for (source, table), sql in _LOADED.items()
    ]
    return _with(["fact", "monthly", "dim_api"], " UNION ALL ".join(rows))


def _failed_load() -> str:
    """The first load breaks off in the market table; dimension and listings are loaded."""
    again = {("all", "dim_location"): "SELECT 0::bigint"}
    rows = ["SELECT 1::bigint AS load_id, 'all' AS source, 'pipeline' AS table_name,"
            " 0::bigint AS row_count, 'FAILED' AS status"]
    rows += [
        f"SELECT {i}::bigint, '{source}', '{table}', ({again.get((source, table), sql)}), 'SUCCESS'"
        for i, ((source, table), sql) in enumerate(_LOADED.items(), start=2)
    ]
    return _with(["fact", "monthly", "dim_api"], " UNION ALL ".join(rows))


def _quality_log() -> str:
    checks = [
        ("null_price_fact_listings", "SELECT count(*) FROM fact WHERE price IS NULL"),
        ("orphan_fk_location_fact_listings", "SELECT 0::bigint"),
        ("orphan_fk_location_fact_market_stats", "SELECT 0::bigint"),
        ("null_location_fields_dim_location", "SELECT 0::bigint"),
    ]
    rows = " UNION ALL ".join(
        f"SELECT {i}::bigint AS check_id, '{name}' AS check_name, ({sql}) AS result_value"
        for i, (name, sql) in enumerate(checks, start=1)
    )
    query = f"SELECT *, result_value <= 0 AS passed FROM ({rows})"
    return _with(
        ["fact"],
        f"SELECT *, CASE WHEN (SELECT bool_and(passed) FROM ({query})) THEN 'passed'"
        f" ELSE 'failed' END AS gate FROM ({query})",
    )


_OTHERS = f"SELECT * REPLACE (price + 1 AS price) FROM bulk_raw WHERE {shapes.EVERY_SEVENTH}"

_PAGES = """
    WITH paged AS (
        SELECT event_type AS state, 500 * ((row_number() OVER (
                   PARTITION BY event_type ORDER BY event_id) - 1) // 500) AS "offset"
        FROM events),
    landed AS (
        SELECT state, "offset", count(*) AS record_count FROM paged GROUP BY 1, 2
        HAVING ("offset" // 500 + length(state)) % 7 <> 2),
    totals AS (SELECT event_type AS state, count(*) AS expected_total FROM events GROUP BY 1),
    chained AS (
        SELECT *, lag("offset") OVER (PARTITION BY state ORDER BY "offset") AS previous FROM landed),
    summed AS (
        SELECT state, count(*) AS pages, cast(sum(record_count) AS bigint) AS records,
               max("offset") // 500 + 1 - count(*) AS missing_pages,
               count(*) FILTER ("offset" > 0 AND coalesce(previous, -1) <> "offset" - 500) AS gaps,
               max_by(record_count, "offset") < 500 AS ended_short
        FROM chained GROUP BY 1)
    SELECT state, pages, records, expected_total, cast(missing_pages AS bigint) AS missing_pages,
           gaps, ended_short, missing_pages = 0 AND records >= expected_total AS complete
    FROM summed JOIN totals USING (state)
"""


def _cross_source() -> str:
    return _with(
        ["fact", "stats"],
        f"""
        SELECT zip_code, city, state,
               count(CASE WHEN {_KAGGLE} THEN 1 END) AS kaggle_listings,
               count(CASE WHEN {_RENTCAST} THEN 1 END) AS rentcast_listings,
               {_mean('price', _KAGGLE)} AS avg_kaggle_price,
               {_mean('price', _RENTCAST)} AS avg_rentcast_price,
               {_mean('median_listing_price')} AS market_median_price
        FROM fact JOIN dim USING (location_id) LEFT JOIN stats USING (location_id)
        GROUP BY ALL
        HAVING kaggle_listings > 0 AND rentcast_listings > 0
        """,
    )


def _cross_source_preagg() -> str:
    return _with(
        ["fact", "stats"],
        f"""
        SELECT zip_code, city, state, kaggle_listings, rentcast_listings,
               avg_kaggle_price, avg_rentcast_price, market_median_price
        FROM dim JOIN (
            SELECT location_id,
                   count(CASE WHEN {_KAGGLE} THEN 1 END) AS kaggle_listings,
                   count(CASE WHEN {_RENTCAST} THEN 1 END) AS rentcast_listings,
                   {_mean('price', _KAGGLE)} AS avg_kaggle_price,
                   {_mean('price', _RENTCAST)} AS avg_rentcast_price
            FROM fact GROUP BY location_id) USING (location_id)
        LEFT JOIN (
            SELECT location_id, {_mean('median_listing_price')} AS market_median_price
            FROM stats GROUP BY location_id) USING (location_id)
        WHERE kaggle_listings > 0 AND rentcast_listings > 0
        """,
    )


ORACLES: dict[str, str] = {
    "clean_bulk": _with(["bulk"], "SELECT * FROM bulk"),
    "clean_bulk_legacy_zip": _with(
        ["bulk_raw"],
        "SELECT cast(zip_code AS varchar) AS zip_code, count(*) AS listing_count FROM bulk_raw"
        " WHERE price BETWEEN 0.001 AND 100000000 AND coalesce(bed, 0) <= 20"
        " AND city IS NOT NULL AND state IS NOT NULL AND zip_code > 0"
        " AND coalesce(bed, bath) IS NOT NULL GROUP BY 1",
    ),
    "clean_api": _with(["api"], 'SELECT * EXCLUDE ("addressLine1") FROM api'),
    "state_codes": _with(
        ["bulk_raw", "codes"],
        "SELECT upper(code) AS code, count(*) AS listing_count"
        " FROM bulk_raw JOIN codes ON name = lower(trim(state)) GROUP BY 1",
    ),
    "property_type_bulk": _with(
        ["bulk_typed", "types"],
        "SELECT property_type, count(*) AS listing_count, min(property_type_id)"
        " AS property_type_id FROM bulk_typed JOIN types USING (property_type) GROUP BY 1",
    ),
    "property_type_api": _with(
        ["api_typed", "types"],
        "SELECT property_type, count(*) AS listing_count, min(property_type_id)"
        " AS property_type_id FROM api_typed JOIN types USING (property_type) GROUP BY 1",
    ),
    "dim_location": _with(["dim"], "SELECT * FROM dim"),
    "dim_location_merge": _with(
        ["dim_bulk", "dim_api"],
        """
        SELECT location_id, city, state, zip_code FROM dim_bulk
        UNION ALL
        SELECT (SELECT max(location_id) FROM dim_bulk)
                   + row_number() OVER (ORDER BY state, city, zip_code), city, state, zip_code
        FROM dim_api a
        WHERE NOT EXISTS (SELECT 1 FROM dim_bulk b WHERE b.city = a.city AND b.state = a.state
                          AND b.zip_code = a.zip_code)
        """,
    ),
    "fact_listings_unified": _with(
        ["fact"], "SELECT *, '2026-01-01 00:00:00' AS ingested_at FROM fact"
    ),
    "remap_unscoped": _remap_unscoped(),
    "batch_guard": """
        SELECT o_orderkey, o_orderstatus AS batch_id, o_totalprice FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_linestatus = o_orderstatus)
    """,
    "orphan_keys": """
        SELECT user_id, count(*) AS row_count
        FROM events LEFT JOIN supplier ON user_id = s_suppkey
        WHERE s_suppkey IS NULL GROUP BY 1
    """,
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS row_count
        FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """,
    "market_stats": _with(["stats"], "SELECT * FROM stats"),
    "market_latest": _with(
        ["stats"],
        """
        SELECT zip_code, state, city, snapshot_date, median_listing_price, median_price_per_sqft,
               median_days_on_market, total_listings, new_listings
        FROM stats JOIN dim USING (location_id)
        QUALIFY row_number() OVER (PARTITION BY zip_code ORDER BY snapshot_date DESC NULLS LAST,
                                   location_id DESC) = 1
        """,
    ),
    "market_trends": _with(
        ["stats"],
        """
        SELECT zip_code, state, snapshot_date, median_listing_price, median_days_on_market,
               total_listings
        FROM stats JOIN dim USING (location_id) ORDER BY zip_code, snapshot_date
        """,
    ),
    "avg_price_by_state": _with(
        ["fact"],
        f"""
        SELECT state, {_mean('price')} AS avg_price, count(*) AS listing_count
        FROM fact JOIN dim USING (location_id) WHERE {_KAGGLE}
        GROUP BY state ORDER BY avg_price DESC
        """,
    ),
    "price_by_property_type": _with(
        ["fact"],
        f"""
        SELECT property_type, {_mean('price')} AS avg_price,
               round(median(price), 4) AS median_price, count(*) AS listing_count
        FROM fact JOIN types USING (property_type_id) WHERE {_RENTCAST}
        GROUP BY property_type ORDER BY avg_price DESC
        """,
    ),
    "price_gap": _with(
        ["fact"],
        f""", {_FEED_MEANS}
        SELECT zip_code, state, {_GAP}
        FROM dim JOIN kaggle USING (location_id) JOIN rentcast USING (location_id)
        ORDER BY pct_change DESC NULLS LAST
        """,
    ),
    "price_comparison": _with(
        ["fact"],
        f""", {_FEED_MEANS}
        SELECT zip_code, state, city, {_GAP}
        FROM dim LEFT JOIN kaggle USING (location_id) LEFT JOIN rentcast USING (location_id)
        WHERE avg_kaggle_price IS NOT NULL OR avg_rentcast_price IS NOT NULL
        """,
    ),
    "inventory": _with(
        ["fact"],
        f"""
        SELECT zip_code, state, city, count(*) AS listing_count,
               cast(sum(days_on_market) AS double) / count(*) AS avg_days_on_market,
               {_mean('price')} AS avg_price
        FROM fact JOIN dim USING (location_id)
        WHERE {_RENTCAST} AND days_on_market IS NOT NULL
        GROUP BY zip_code, state, city ORDER BY listing_count DESC
        """,
    ),
    "cross_source": _cross_source(),
    "cross_source_preagg": _cross_source_preagg(),
    "quality_checks": _quality(),
    "quality_by_batch": _quality(allowed=0),
    "profile_nulls": _with(["bulk_raw"], _null_counts()),
    "profile_orders": _profile(),
    "profile_orders_extremes": _extremes(),
    "json_props": """
        SELECT event_type,
               cast(sum(cast(json_extract(props, '$.k') AS bigint)) AS bigint) AS k_total,
               count(json_extract(props, '$.absent')) AS absent_count
        FROM events GROUP BY 1
    """,
    "landing_by_state": _with(["bulk_raw"], _LANDED),
    # The feed and the other rows by the stream, and all of them once more as a whole.
    "incremental_landing": _with(
        ["bulk_raw"],
        f"SELECT state, 2 * record_count AS record_count, 2 * with_city AS with_city,"
        f" 2 * price_total AS price_total FROM ("
        + _LANDED.replace("FROM bulk_raw", f"FROM (SELECT * FROM bulk_raw UNION ALL {_OTHERS})")
        + ")",
    ),
    "landing_api_by_state": _with(
        ["api_raw"],
        """
        SELECT state, cast(ceil(count(*) / 500.0) AS bigint) AS page_count,
               count(*) AS record_count, count(id) AS with_id,
               cast(sum(cast(CASE WHEN state < 'M' THEN price ELSE price + 1 END AS decimal(18,4)))
                    AS double) AS price_total
        FROM api_raw GROUP BY 1
        """,
    ),
    "landed_totals": _with(
        ["api_raw"],
        """
        SELECT count(DISTINCT state) AS states_processed, count(*) AS records_count,
               (SELECT string_agg(s, ',' ORDER BY s)
                FROM (VALUES ('AL'), ('CA'), ('FL'), ('XX')) AS t(s)
                WHERE s NOT IN (SELECT state FROM api_raw)) AS absent
        FROM api_raw WHERE state IN ('AL', 'CA', 'FL')
        """,
    ),
    "page_reconciliation": _PAGES,
    "load_fact_listings": _with(
        ["fact"],
        """
        SELECT source, batch_id, city, state, zip_code, property_type_id,
               count(*) AS listing_count, count(rentcast_id) AS with_id,
               cast(sum(cast(price AS decimal(18,4))) AS double) AS price_total
        FROM fact JOIN dim USING (location_id) GROUP BY ALL
        """,
    ),
    "load_market_stats": _with(
        ["monthly", "dim_api"],
        """
        SELECT city, state, zip_code,
               CASE WHEN "totalListings" % 7 = 0 THEN NULL
                    ELSE cast(month || '-01' AS date) END AS snapshot_date,
               "medianPrice" AS median_listing_price, "totalListings" AS total_listings
        FROM monthly JOIN dim_api USING (zip_code)
        """,
    ),
    "load_quality_log": _quality_log(),
    "failed_load": _failed_load(),
    "market_files": _with(
        ["monthly"],
        """
        SELECT zip_code,
               CASE WHEN "totalListings" % 7 = 0 THEN NULL
                    ELSE cast(month || '-01' AS date) END AS snapshot_date,
               "medianPrice" AS median_listing_price,
               "medianPricePerSquareFoot" AS median_price_per_sqft,
               "medianDaysOnMarket" AS median_days_on_market,
               "totalListings" AS total_listings, "newListings" AS new_listings
        FROM monthly
        """,
    ),
    "first_orders": """
        SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place,
               o_orderkey, o_totalprice
        FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
    """,
    "first_look": _with(
        ["bulk_raw"],
        "SELECT least(count(*), 1000) AS row_count, 12::int AS column_count, true AS has_beds FROM bulk_raw",
    ),
    "empty_market": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{kind}' AS column_type, 0::bigint AS row_count,"
        " 0::bigint AS null_count"
        for c, kind in _EMPTY_MARKET.items()
    ),
    "load_times": " UNION ALL ".join(
        f"SELECT '{source}' AS source, '{table}' AS table_name, true AS started_in_run,"
        " true AS in_order"
        for source, table in _LOADED
    ),
    "median_by_position": """
        SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 4) AS median_price
        FROM lineitem GROUP BY 1, 2
    """,
    "skewed_lookup": f"""
        SELECT o_orderpriority, count(*) AS item_count, sum(l_quantity) AS quantity
        FROM (SELECT {shapes.HOT_ORDER} AS o_orderkey, l_quantity FROM lineitem)
             LEFT JOIN orders USING (o_orderkey) GROUP BY 1
    """,
    "whole_price_averages": _with(
        ["fact"],
        f"""
        SELECT state, round(sum(floor(price)) / count(price), 2) AS avg_price,
               count(*) AS listing_count
        FROM fact JOIN dim USING (location_id) WHERE {_KAGGLE} GROUP BY state
        """,
    ),
    "deduplicated_api": _with(
        ["api"],
        """
        SELECT id, city, zip_code, price
        FROM (SELECT * FROM api
              UNION ALL SELECT * REPLACE (price - 1 AS price) FROM api WHERE id LIKE '%-1')
        QUALIFY row_number() OVER (
            PARTITION BY id ORDER BY "addressLine1", city, state, zip_code, latitude NULLS FIRST,
                longitude NULLS FIRST, "propertyType" NULLS FIRST, price) = 1
        """,
    ),
    "ranked_states": _with(
        ["fact"],
        f"""
        SELECT state, row_number() OVER (ORDER BY avg_price DESC, state) AS place
        FROM (SELECT state, {_mean('price')} AS avg_price
              FROM fact JOIN dim USING (location_id) WHERE {_KAGGLE} GROUP BY state)
        """,
    ),
    "load_warehouse": _load_audit(),
}

# The named views answer the questions of two queries.
ORACLES["view_price_comparison"] = ORACLES["price_comparison"]
ORACLES["view_market_summary"] = ORACLES["market_latest"]

# The SQL forms answer the same questions.
ORACLES |= {
    f"sql_{name}": ORACLES[name]
    for name in (
        "avg_price_by_state", "price_by_property_type", "price_gap", "price_comparison",
        "inventory", "market_latest", "market_trends", "cross_source",
    )
}
