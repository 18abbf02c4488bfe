"""Market documents broken down by property type, bedrooms and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstar.functions.aggregates import mean, total
from parcelstar.operators.joins import lookup_join

#: What a row of a document is about: all its listings now, those of a type, of a number of
#: bedrooms, or all those of a month.
ALL, TYPE, BEDROOMS, MONTH = "all", "property_type", "bedrooms", "month"


def _entry(kind: str, detail: Column, statistics: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        detail.cast("string").alias("detail"),
        statistics["totalListings"].cast("bigint").alias("listings"),
        statistics["newListings"].cast("bigint").alias("new_listings"),
        statistics["averagePrice"].alias("average_price"),
        statistics["averageDaysOnMarket"].alias("average_days"),
        statistics["minPrice"].alias("min_price"),
        statistics["maxPrice"].alias("max_price"),
    )


def breakdown_rows(documents: DataFrame) -> DataFrame:
    """A row per statistic of each document, from one pass over both arrays and the map.

    `kind` tells what it is about and `detail` which one; all listings have no detail.
    """
    sale = F.col("saleData")
    by_type = F.transform(
        sale["dataByPropertyType"], lambda e: _entry(TYPE, e["propertyType"], e)
    )
    by_bedrooms = F.transform(sale["dataByBedrooms"], lambda e: _entry(BEDROOMS, e["bedrooms"], e))
    by_month = F.transform(
        F.map_entries(sale["history"]), lambda e: _entry(MONTH, e["key"], e["value"])
    )
    now = F.when(sale.isNotNull(), F.array(_entry(ALL, F.lit(None), sale)))
    # A NULL array is an empty one.
    parts = F.filter(F.array(now, by_type, by_bedrooms, by_month), lambda part: part.isNotNull())
    return documents.select(F.col("zipCode").alias("zip_code"), F.inline(F.flatten(parts)))


def _sums(exact: bool) -> list[Column]:
    """Sums that can be merged; an average counts with the listings it is of."""
    listings = F.col("listings")
    priced = F.when(F.col("average_price").isNotNull(), listings)
    timed = F.when(F.col("average_days").isNotNull(), listings)
    return [
        F.sum(listings).alias("listings"),
        F.sum("new_listings").alias("new_listings"),
        F.sum(priced).alias("priced"),
        total(F.col("average_price") * listings, exact).alias("price_sum"),
        F.sum(timed).alias("timed"),
        total(F.col("average_days") * listings, exact).alias("days_sum"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
    ]


def market_breakdown(documents: DataFrame, places: DataFrame, exact: bool = False) -> DataFrame:
    """Listings, mean price and days, least and greatest price by state and detail.

    `places` gives one state per zip_code; zip codes it lacks count under a NULL state. There
    is a row for each state, kind and detail, for each state and kind over all details, and
    the same over all states (`level` 0 to 3). All come from one pass: documents are summed by
    state, kind and detail, and these few sums are merged by grouping sets.
    """
    rows = lookup_join(breakdown_rows(documents), places.select("zip_code", "state"), ["zip_code"])
    finest = rows.groupBy("state", "kind", "detail").agg(*_sums(exact))
    merged = finest.groupingSets(
        [
            [F.col("state"), F.col("kind"), F.col("detail")],
            [F.col("state"), F.col("kind")],
            [F.col("kind"), F.col("detail")],
            [F.col("kind")],
        ],
        "state", "kind", "detail",
    ).agg(
        (F.grouping("state") * 2 + F.grouping("detail")).cast("int").alias("level"),
        *[F.sum(c).alias(c) for c in ("listings", "new_listings", "priced", "price_sum", "timed", "days_sum")],
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
    )
    return merged.select(
        "level", "state", "kind", "detail", "listings", "new_listings",
        mean(F.col("price_sum"), F.col("priced")).alias("avg_price"),
        mean(F.col("days_sum"), F.col("timed")).alias("avg_days_on_market"),
        "min_price", "max_price",
    )


def breakdown_gaps(documents: DataFrame) -> DataFrame:
    """Zip codes whose listings by type or by bedrooms do not add up to all of them."""
    def of(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("listings"))), F.lit(0))

    rows = breakdown_rows(documents).groupBy("zip_code").agg(
        of(ALL).alias("listings"), of(TYPE).alias("by_type"), of(BEDROOMS).alias("by_bedrooms")
    )
    differs = (F.col("by_type") != F.col("listings")) | (F.col("by_bedrooms") != F.col("listings"))
    return rows.where(differs)
