"""Fact tables of the two feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstar.constants import API_SOURCE, BULK_SOURCE, LOCATION_KEY
from parcelstar.functions.dates import iso_instant_date
from parcelstar.functions.property_types import type_from_bedrooms, type_from_label
from parcelstar.operators.joins import lookup_join
from parcelstar.schemas import FACT_LISTINGS, conform

# The columns of the staged facts, and the API fields they stand for.
AUDIT_COLUMNS = ["source", "batch_id", "ingested_at"]

BULK_FACT_COLUMNS = [
    "location_id", "property_type_id", "status", "price", "bed", "bath", "acre_lot",
    "house_size", "prev_sold_date", "brokered_by",
]

API_FACT_COLUMNS = [
    "location_id", "property_type_id", "rentcast_id", "address", "price", "status",
    "bedrooms", "bathrooms", "square_footage", "lot_size", "latitude", "longitude",
    "days_on_market", "listed_date",
]

API_RENAMES = {
    "id": "rentcast_id",
    "squareFootage": "square_footage",
    "lotSize": "lot_size",
    "daysOnMarket": "days_on_market",
    "listedDate": "listed_date",
}

# Fields of the cleaned feeds that locations and facts are made from; the others are not staged.
BULK_FIELDS = [*LOCATION_KEY, *BULK_FACT_COLUMNS[2:]]
API_FIELDS = [
    *LOCATION_KEY, "propertyType",
    *[{new: old for old, new in API_RENAMES.items()}.get(c, c) for c in API_FACT_COLUMNS[2:]],
]

MARKET_COLUMNS = [
    "location_id", "snapshot_date", "median_listing_price", "median_price_per_sqft",
    "median_days_on_market", "total_listings", "new_listings",
]


def audit(df: DataFrame, source: str, batch_id: str, ingested_at: str) -> DataFrame:
    """Append the audit columns as literals."""
    return df.withColumns(
        {
            "source": F.lit(source),
            "batch_id": F.lit(batch_id),
            "ingested_at": F.lit(ingested_at),
        }
    )


def _with_dimension_ids(
    df: DataFrame, property_type: Column, dim_location: DataFrame, dim_property_type: DataFrame
) -> DataFrame:
    typed = df.withColumn("property_type", property_type)
    # The property types are six fixed rows.
    typed = typed.join(F.broadcast(dim_property_type), "property_type", "left")
    return lookup_join(typed, dim_location, LOCATION_KEY, "left")


def bulk_fact(
    df: DataFrame,
    dim_location: DataFrame,
    dim_property_type: DataFrame,
    batch_id: str,
    ingested_at: str,
) -> DataFrame:
    """Cleaned bulk listings as fact rows."""
    keyed = _with_dimension_ids(
        df, type_from_bedrooms(F.col("bed")), dim_location, dim_property_type
    )
    return audit(keyed.select(*BULK_FACT_COLUMNS), BULK_SOURCE, batch_id, ingested_at)


def api_fact(
    df: DataFrame,
    dim_location: DataFrame,
    dim_property_type: DataFrame,
    batch_id: str,
    ingested_at: str,
) -> DataFrame:
    """Cleaned API listings as fact rows."""
    keyed = _with_dimension_ids(
        df, type_from_label(F.col("propertyType")), dim_location, dim_property_type
    )
    named = keyed.withColumnsRenamed(API_RENAMES)
    return audit(named.select(*API_FACT_COLUMNS), API_SOURCE, batch_id, ingested_at)


def market_rows(documents: DataFrame) -> DataFrame:
    """One row per month of each market document.

    The date inside the entry counts; an entry without one takes the first day of its
    month key. A date that does not parse gives NULL.
    """
    months = documents.select("zipCode", F.explode("saleData.history").alias("month", "entry"))
    first_day = F.try_to_date(F.concat(F.col("month"), F.lit("-01")), "yyyy-MM-dd")
    dated = F.when(F.col("entry.date").isNull(), first_day).otherwise(
        iso_instant_date(F.col("entry.date"))
    )
    return months.select(
        F.col("zipCode").alias("zip_code"),
        dated.alias("snapshot_date"),
        F.col("entry.medianPrice").alias("median_listing_price"),
        F.col("entry.medianPricePerSquareFoot").alias("median_price_per_sqft"),
        F.col("entry.medianDaysOnMarket").alias("median_days_on_market"),
        F.col("entry.totalListings").alias("total_listings"),
        F.col("entry.newListings").alias("new_listings"),
    )


def market_stats_fact(
    documents: DataFrame, dim_location: DataFrame, batch_id: str, ingested_at: str
) -> DataFrame:
    """Market months for every location of their zip code.

    A zip code shared by several cities yields a row for each; an unknown one keeps a
    NULL location.
    """
    by_zip = dim_location.select("zip_code", "location_id")
    keyed = lookup_join(market_rows(documents), by_zip, ["zip_code"], "left")
    return audit(keyed.select(*MARKET_COLUMNS), API_SOURCE, batch_id, ingested_at)


def unified_fact(*facts: DataFrame) -> DataFrame:
    """Facts of several feeds in the one warehouse shape; foreign columns are NULL."""
    first, *rest = [conform(fact, FACT_LISTINGS) for fact in facts]
    for fact in rest:
        first = first.unionByName(fact)
    return first
