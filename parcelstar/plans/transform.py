"""Raw zone to staged star tables, per feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelstar.constants import API_SOURCE, BULK_SOURCE
from parcelstar.operators import facts
from parcelstar.operators.cleaning import clean_api, clean_bulk
from parcelstar.operators.dimensions import build_dim_location, dim_property_type
from parcelstar.runs import new_batch_id, today, utc_now
from parcelstar.session import write_through
from parcelstar.sources.api import read_api_listings, read_market
from parcelstar.sources.bulk import read_raw_bulk
from parcelstar.sources.paths import raw_api_listings, raw_bulk, raw_market
from parcelstar.sources.staged import write_staged


def transform_bulk(
    raw: DataFrame,
    batch_id: str,
    ingested_at: str,
    zip_mode: str = "canonical",
    dedupe: bool = False,
) -> dict[str, DataFrame]:
    """Bulk listings to dim_location, dim_property_type and fact_listings."""
    # The dimension and the fact each read the listings: clean them once, what they need of them.
    cleaned = write_through(clean_bulk(raw, zip_mode, dedupe).select(*facts.BULK_FIELDS), "cleaned")
    locations = build_dim_location(cleaned)
    types = dim_property_type(raw.sparkSession)
    return {
        "dim_location": locations,
        "dim_property_type": types,
        "fact_listings": facts.bulk_fact(cleaned, locations, types, batch_id, ingested_at),
    }


def transform_api(
    listings: DataFrame,
    market: DataFrame,
    batch_id: str,
    ingested_at: str,
    dedupe: bool = False,
) -> dict[str, DataFrame]:
    """API listings and market documents to the star tables and fact_market_stats."""
    cleaned = write_through(clean_api(listings, dedupe).select(*facts.API_FIELDS), "cleaned")
    locations = build_dim_location(cleaned)
    types = dim_property_type(listings.sparkSession)
    return {
        "dim_location": locations,
        "dim_property_type": types,
        "fact_listings": facts.api_fact(cleaned, locations, types, batch_id, ingested_at),
        "fact_market_stats": facts.market_stats_fact(market, locations, batch_id, ingested_at),
    }


def _summary(source: str, batch_id: str, execution_date: str, counts: dict[str, int]) -> dict:
    return {
        "status": "success",
        "source": source,
        "batch_id": batch_id,
        "execution_date": execution_date,
        **{f"{table}_rows": n for table, n in counts.items() if table != "dim_property_type"},
    }


def stage_bulk(
    spark: SparkSession,
    raw_root: str,
    staging_root: str,
    execution_date: str | None = None,
    batch_id: str | None = None,
    zip_mode: str = "canonical",
    dedupe: bool = False,
) -> dict:
    """Transform one date of the landed bulk feed into the staging zone."""
    execution_date = execution_date or today()
    batch_id = batch_id or new_batch_id()
    raw = read_raw_bulk(spark, raw_bulk(raw_root, execution_date))
    tables = transform_bulk(raw, batch_id, utc_now().isoformat(), zip_mode, dedupe)
    counts = write_staged(tables, staging_root, BULK_SOURCE, execution_date)
    return _summary(BULK_SOURCE, batch_id, execution_date, counts)


def stage_api(
    spark: SparkSession,
    raw_root: str,
    staging_root: str,
    execution_date: str | None = None,
    batch_id: str | None = None,
    multi_line: bool = False,
    dedupe: bool = False,
) -> dict:
    """Transform one date of the landed API feed into the staging zone."""
    execution_date = execution_date or today()
    batch_id = batch_id or new_batch_id()
    listings = read_api_listings(spark, raw_api_listings(raw_root, execution_date), multi_line)
    market = read_market(spark, raw_market(raw_root, execution_date), multi_line)
    tables = transform_api(listings, market, batch_id, utc_now().isoformat(), dedupe)
    counts = write_staged(tables, staging_root, API_SOURCE, execution_date)
    return _summary(API_SOURCE, batch_id, execution_date, counts)
