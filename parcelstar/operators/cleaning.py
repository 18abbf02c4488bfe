"""Cleaning rules of the two feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstar.constants import LATITUDE_RANGE, LONGITUDE_RANGE, MAX_BED, MAX_PRICE
from parcelstar.functions.dates import plain_date
from parcelstar.functions.text import clean_name, expand_state, shorten_street, zip_text


def clean_bulk(df: DataFrame, zip_mode: str = "canonical", dedupe: bool = False) -> DataFrame:
    """Keep plausible, located bulk listings and conform their text and dates.

    All row tests are on raw columns, so they reach the Parquet scan.
    """
    price, bed, bath, zip_code = (F.col(c) for c in ("price", "bed", "bath", "zip_code"))
    kept = df.where(
        price.isNotNull()
        & (price > 0)
        & (price <= MAX_PRICE)
        & (bed.isNull() | (bed <= MAX_BED))
        & (bed.isNotNull() | bath.isNotNull())
        & F.col("city").isNotNull()
        & F.col("state").isNotNull()
        & zip_code.isNotNull()
        & (zip_code > 0)
    )
    cleaned = kept.withColumns(
        {
            "prev_sold_date": plain_date(F.col("prev_sold_date")),
            "zip_code": zip_text(zip_code, zip_mode),
            "city": clean_name(F.col("city")),
            "state": clean_name(F.col("state")),
        }
    )
    return cleaned.dropDuplicates() if dedupe else cleaned


def within_bounds(
    df: DataFrame,
    latitude: tuple[float, float] = LATITUDE_RANGE,
    longitude: tuple[float, float] = LONGITUDE_RANGE,
) -> DataFrame:
    """Drop rows with a coordinate outside the box; a missing coordinate passes."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return df.where(
        (lat.isNull() | lat.between(*latitude)) & (lon.isNull() | lon.between(*longitude))
    )


def clean_api(df: DataFrame, dedupe: bool = False) -> DataFrame:
    """Keep identified API listings in bounds and conform their text.

    There is no price rule here: a missing price is left to the quality checks. Of rows
    with one id, `dedupe` keeps the least, column by column from the left, NULLs first.
    """
    kept = within_bounds(df.where(F.col("id").isNotNull()))
    cleaned = kept.withColumnRenamed("zipCode", "zip_code").withColumns(
        {
            "address": shorten_street(F.col("addressLine1")),
            "state": expand_state(F.col("state")),
            "city": clean_name(F.col("city")),
        }
    )
    if not dedupe:
        return cleaned
    row = F.struct(*[F.col(f"`{c}`") for c in cleaned.columns])
    return cleaned.groupBy("id").agg(F.min(row).alias("_row")).select("_row.*")
