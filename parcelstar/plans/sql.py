"""The views and queries of `analytics` as Spark SQL over the registered tables.

Run them after `register_views`. They follow the same shape: reduce the fact by location,
then join. The median is exact: the middle prices are picked by position among the counted
distinct prices of a property type, which one task sorts; `price_by_property_type` in
`analytics` spreads them when there are very many.
"""

from __future__ import annotations

_BY_SOURCE = """
    SELECT location_id,
           count(*) AS n,
           count_if(source = 'kaggle') AS kaggle_n,
           count_if(source = 'rentcast') AS rentcast_n,
           count(price) FILTER (WHERE source = 'kaggle') AS kaggle_priced,
           count(price) FILTER (WHERE source = 'rentcast') AS rentcast_priced,
           sum(price) FILTER (WHERE source = 'kaggle') AS kaggle_sum,
           sum(price) FILTER (WHERE source = 'rentcast') AS rentcast_sum
    FROM fact_listings
    GROUP BY location_id
"""


def _mean(total: str, count: str) -> str:
    return f"cast({total} AS double) / nullif({count}, 0)"


_FEED_MEANS = f"""
    SELECT *,
           {_mean('kaggle_sum', 'kaggle_priced')} AS avg_kaggle_price,
           {_mean('rentcast_sum', 'rentcast_priced')} AS avg_rentcast_price
    FROM dim_location JOIN ({_BY_SOURCE}) USING (location_id)
"""

_GAP = """
    avg_kaggle_price,
    avg_rentcast_price,
    avg_rentcast_price - avg_kaggle_price AS price_gap,
    round((avg_rentcast_price - avg_kaggle_price) / nullif(avg_kaggle_price, 0) * 100, 2)
        AS pct_change
"""

QUERIES = {
    "avg_price_by_state": f"""
        WITH sums AS (
            SELECT location_id, sum(price) AS s, count(price) AS c, count(*) AS n
            FROM fact_listings
            WHERE source = 'kaggle'
            GROUP BY location_id
        )
        SELECT state, {_mean("sum(s)", "sum(c)")} AS avg_price, sum(n) AS listing_count
        FROM sums JOIN dim_location USING (location_id)
        GROUP BY state
        ORDER BY avg_price DESC NULLS FIRST
    """,
    "price_by_property_type": f"""
        WITH prices AS (
            SELECT property_type_id, price, count(*) AS n
            FROM fact_listings
            WHERE source = 'rentcast'
            GROUP BY property_type_id, price
        ),
        placed AS (
            SELECT *, sum(n) OVER (PARTITION BY property_type_id ORDER BY price) AS upto,
                   sum(n) OVER (PARTITION BY property_type_id) AS total
            FROM prices
            WHERE price IS NOT NULL
        ),
        medians AS (
            SELECT property_type_id,
                   if(min(price) = max(price), cast(min(price) AS double),
                      cast(min(price) AS double) / 2 + cast(max(price) AS double) / 2)
                       AS median_price
            FROM placed
            WHERE upto > floor((total - 1) / 2) AND upto - n <= floor(total / 2)
            GROUP BY property_type_id
        )
        SELECT property_type,
               {_mean("sum(price * n)", "sum(n) FILTER (WHERE price IS NOT NULL)")} AS avg_price,
               any_value(median_price) AS median_price,
               sum(n) AS listing_count
        FROM prices JOIN dim_property_type USING (property_type_id)
                    LEFT JOIN medians USING (property_type_id)
        GROUP BY property_type
        ORDER BY avg_price DESC NULLS FIRST
    """,
    "price_gap": f"""
        SELECT zip_code, state, {_GAP}
        FROM ({_FEED_MEANS})
        WHERE kaggle_n > 0 AND rentcast_n > 0
        ORDER BY pct_change DESC NULLS LAST
    """,
    "price_comparison": f"""
        SELECT zip_code, state, city, {_GAP}
        FROM ({_FEED_MEANS})
        WHERE kaggle_priced > 0 OR rentcast_priced > 0
    """,
    "market_summary": """
        SELECT zip_code, state, city, snapshot_date, median_listing_price,
               median_price_per_sqft, median_days_on_market, total_listings, new_listings
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY zip_code
                ORDER BY snapshot_date DESC NULLS LAST, ingested_at DESC NULLS LAST,
                         stat_id DESC NULLS LAST, location_id DESC NULLS LAST
            ) AS place
            FROM fact_market_stats JOIN dim_location USING (location_id)
        )
        WHERE place = 1
    """,
    "market_trends": """
        SELECT zip_code, state, snapshot_date, median_listing_price,
               median_days_on_market, total_listings
        FROM fact_market_stats JOIN dim_location USING (location_id)
        ORDER BY zip_code NULLS LAST, snapshot_date NULLS LAST
    """,
    "inventory": f"""
        WITH sums AS (
            SELECT location_id, count(*) AS n, sum(days_on_market) AS days,
                   sum(price) AS s, count(price) AS c
            FROM fact_listings
            WHERE source = 'rentcast' AND days_on_market IS NOT NULL
            GROUP BY location_id
        )
        SELECT zip_code, state, city, sum(n) AS listing_count,
               {_mean("sum(days)", "sum(n)")} AS avg_days_on_market,
               {_mean("sum(s)", "sum(c)")} AS avg_price
        FROM sums JOIN dim_location USING (location_id)
        GROUP BY zip_code, state, city
        ORDER BY listing_count DESC NULLS FIRST
    """,
    "cross_source": f"""
        WITH market AS (
            SELECT location_id, count(*) AS snapshots, count(median_listing_price) AS medians,
                   sum(median_listing_price) AS median_sum
            FROM fact_market_stats
            GROUP BY location_id
        ),
        located AS (
            SELECT *, coalesce(snapshots, 1) AS times
            FROM ({_BY_SOURCE}) JOIN dim_location USING (location_id)
                 LEFT JOIN market USING (location_id)
        )
        SELECT zip_code, city, state,
               sum(kaggle_n * times) AS kaggle_listings,
               sum(rentcast_n * times) AS rentcast_listings,
               {_mean("sum(kaggle_sum * times)", "sum(kaggle_priced * times)")}
                   AS avg_kaggle_price,
               {_mean("sum(rentcast_sum * times)", "sum(rentcast_priced * times)")}
                   AS avg_rentcast_price,
               {_mean("sum(n * median_sum)", "sum(n * medians)")} AS market_median_price
        FROM located
        GROUP BY zip_code, city, state
        HAVING kaggle_listings > 0 AND rentcast_listings > 0
        ORDER BY avg_rentcast_price - avg_kaggle_price DESC NULLS FIRST
    """,
}
