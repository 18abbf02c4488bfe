"""Location and property-type dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstar.constants import LOCATION_KEY, PROPERTY_TYPES
from parcelstar.operators.ordering import dense_keys
from parcelstar.schemas import DIM_PROPERTY_TYPE, literal_frame

LOCATION_ORDER = ["state", "city", "zip_code"]


def dim_property_type(spark: SparkSession) -> DataFrame:
    """The six fixed property types."""
    return literal_frame(spark, PROPERTY_TYPES, DIM_PROPERTY_TYPE)


def has_location() -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in LOCATION_KEY])


def distinct_locations(df: DataFrame) -> DataFrame:
    """Distinct complete (city, state, zip_code); incomplete ones are no dimension rows."""
    return df.where(has_location()).select(*LOCATION_KEY).distinct()


def build_dim_location(df: DataFrame) -> DataFrame:
    """Locations of cleaned listings, numbered from 1 by state, city and zip code."""
    return dense_keys(distinct_locations(df), LOCATION_ORDER, "location_id")


def new_locations(staged: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Members a merge adds: staged keys the dimension lacks, numbered after its last id.

    A key that several feeds stage is added once.
    """
    top = dim_location.agg(F.coalesce(F.max("location_id"), F.lit(0)).alias("top")).first()["top"]
    missing = distinct_locations(staged).join(
        dim_location.select(*LOCATION_KEY), LOCATION_KEY, "left_anti"
    )
    return dense_keys(missing, LOCATION_ORDER, "location_id", start=top + 1)


def merge_dim_location(dim_location: DataFrame, staged: DataFrame) -> DataFrame:
    """The dimension with the staged locations it lacked; present members never change."""
    return dim_location.unionByName(new_locations(staged, dim_location))
