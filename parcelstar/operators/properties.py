"""Property records: details of each property, and its values from year to year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstar.constants import API_SOURCE, LOCATION_KEY
from parcelstar.functions.aggregates import percent_change
from parcelstar.functions.dates import iso_instant_date
from parcelstar.functions.property_types import type_from_label
from parcelstar.functions.text import clean_name, expand_state, shorten_street
from parcelstar.operators.cleaning import within_bounds
from parcelstar.operators.facts import audit
from parcelstar.operators.joins import lookup_join
from parcelstar.schemas import PROPERTY

DETAIL_COLUMNS = [
    "rentcast_id", "location_id", "property_type_id", "address", "bedrooms", "bathrooms",
    "square_footage", "lot_size", "year_built", "last_sale_date", "last_sale_price", "hoa_fee",
    "cooling", "garage", "pool", "owner_occupied", "latitude", "longitude",
]
YEAR = r"^\d{4}$"


def read_properties(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Property records, a JSON object a line or, with `multi_line`, an array a file."""
    return spark.read.schema(PROPERTY).options(multiLine=multi_line, mode="FAILFAST").json(path)


def clean_properties(df: DataFrame) -> DataFrame:
    """Identified records in bounds, with their places and addresses as listings have them."""
    kept = within_bounds(df.where(F.col("id").isNotNull()))
    return kept.withColumnRenamed("zipCode", "zip_code").withColumns(
        {
            "address": shorten_street(F.col("addressLine1")),
            "state": expand_state(F.col("state")),
            "city": clean_name(F.col("city")),
        }
    )


def property_details_fact(
    df: DataFrame,
    dim_location: DataFrame,
    dim_property_type: DataFrame,
    batch_id: str,
    ingested_at: str,
) -> DataFrame:
    """Cleaned records as rows of `fact_property_details`; an unknown place keeps a NULL id."""
    typed = df.withColumn("property_type", type_from_label(F.col("propertyType")))
    typed = typed.join(F.broadcast(dim_property_type), "property_type", "left")  # six fixed rows
    keyed = lookup_join(typed, dim_location, LOCATION_KEY, "left")
    named = keyed.select(
        F.col("id").alias("rentcast_id"),
        "location_id",
        "property_type_id",
        "address",
        "bedrooms",
        "bathrooms",
        F.col("squareFootage").alias("square_footage"),
        F.col("lotSize").alias("lot_size"),
        F.col("yearBuilt").alias("year_built"),
        iso_instant_date(F.col("lastSaleDate")).alias("last_sale_date"),
        F.col("lastSalePrice").alias("last_sale_price"),
        F.col("hoa.fee").alias("hoa_fee"),
        F.col("features.cooling").alias("cooling"),
        F.col("features.garage").alias("garage"),
        F.col("features.pool").alias("pool"),
        F.col("ownerOccupied").alias("owner_occupied"),
        "latitude",
        "longitude",
    )
    return audit(named.select(*DETAIL_COLUMNS), API_SOURCE, batch_id, ingested_at)


def _keys(c: str) -> Column:
    return F.coalesce(F.map_keys(c), F.array().cast("array<string>"))


def _years() -> Column:
    """The years of all three maps of a record, ascending; keys that are no year are left out."""
    sold = F.transform(_keys("history"), lambda day: F.substring(day, 1, 4))
    every = F.array_distinct(F.concat(_keys("taxAssessments"), _keys("propertyTaxes"), sold))
    return F.array_sort(F.filter(every, lambda year: year.rlike(YEAR)))


def _sale(year: Column) -> Column:
    """The last sale of a year, by its day."""
    own = F.filter(F.map_entries("history"), lambda e: F.substring(e["key"], 1, 4) == year)
    return F.array_max(F.transform(own, lambda e: F.struct(e["key"], e["value"]["price"].alias("price"))))


def aligned_years() -> Column:
    """A record's assessments, taxes and sales as one array, an element per year of any.

    The maps are looked up by the union of their years inside the record, so they are never
    exploded and joined.
    """
    def at(year: Column) -> Column:
        assessed, taxed = F.col("taxAssessments")[year], F.col("propertyTaxes")[year]
        return F.struct(
            year.cast("int").alias("year"),
            assessed["value"].alias("assessed_value"),
            assessed["land"].alias("land_value"),
            assessed["improvements"].alias("improvement_value"),
            taxed["total"].alias("tax_total"),
            _sale(year)["price"].alias("sale_price"),
        )

    return F.transform(_years(), at)


def property_values(df: DataFrame) -> DataFrame:
    """A row per property and year of any of its maps, with the change of the assessed value.

    The change is to the last earlier year with an assessment, `prior_year`. A map that is
    NULL or lacks a year gives NULLs there; a record without any year has no row.
    """
    def with_prior(entry: Column, i: Column) -> Column:
        earlier = F.filter(
            F.slice("_years", F.lit(1), i), lambda e: e["assessed_value"].isNotNull()
        )
        prior = F.try_element_at(earlier, F.lit(-1))
        return F.struct(
            entry.alias("at"), prior["year"].alias("year"), prior["assessed_value"].alias("value")
        )

    rows = df.select("id", aligned_years().alias("_years")).select(
        "id", F.explode(F.transform("_years", with_prior)).alias("e")
    )
    value, prior = F.col("e.at.assessed_value"), F.col("e.value")
    known = value.isNotNull()
    return rows.select(
        F.col("id").alias("rentcast_id"),
        "e.at.*",
        F.when(known, F.col("e.year")).alias("prior_year"),
        (value - prior).alias("value_change"),
        percent_change(prior, value).alias("value_pct_change"),
        F.round(F.col("e.at.tax_total") / F.nullif(value, F.lit(0.0)) * 100, 4).alias("tax_pct"),
    )
