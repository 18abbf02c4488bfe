"""Views and analytical queries over the star schema.

Every query reduces the fact to one row per location (or property type) before it meets
a dimension, so the fact itself is read once and never shuffled row by row. `exact=True`
sums in fixed point, which makes averages repeatable to the last bit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelstar.constants import API_SOURCE, BULK_SOURCE
from parcelstar.functions.aggregates import mean, percent_change, total
from parcelstar.operators.joins import lookup_join
from parcelstar.operators.median import (
    approx_median_by,
    median_of_counts,
    value_counts,
)
from parcelstar.sources.warehouse import Warehouse


@dataclass(frozen=True)
class Star:
    dim_location: DataFrame
    dim_property_type: DataFrame
    fact_listings: DataFrame
    fact_market_stats: DataFrame

    @classmethod
    def of(cls, warehouse: Warehouse) -> Star:
        return cls(**{name: warehouse.table(name) for name in cls.__dataclass_fields__})


def _of_source(source: str) -> Column:
    return F.col("source") == source


def _prices_by_source(fact: DataFrame, exact: bool) -> DataFrame:
    """Per location, in one pass: rows, priced rows and price sum of each feed."""
    figures = [F.count(F.lit(1)).alias("rows")]
    for tag, source in (("kaggle", BULK_SOURCE), ("rentcast", API_SOURCE)):
        mine = _of_source(source)
        price = F.when(mine, F.col("price"))
        figures += [
            F.count_if(mine).alias(f"{tag}_rows"),
            F.count(price).alias(f"{tag}_priced"),
            total(price, exact).alias(f"{tag}_sum"),
        ]
    return fact.groupBy("location_id").agg(*figures)


def _feed_mean(tag: str) -> Column:
    return mean(F.col(f"{tag}_sum"), F.col(f"{tag}_priced"))


def _gap_columns() -> list[Column]:
    old, new = F.col("avg_kaggle_price"), F.col("avg_rentcast_price")
    return [
        old,
        new,
        (new - old).alias("price_gap"),
        percent_change(old, new).alias("pct_change"),
    ]


def avg_price_by_state(star: Star, exact: bool = False) -> DataFrame:
    """Mean price and number of bulk listings by state, dearest first."""
    per_location = (
        star.fact_listings.where(_of_source(BULK_SOURCE))
        .groupBy("location_id")
        .agg(
            total(F.col("price"), exact).alias("_sum"),
            F.count("price").alias("_priced"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    return (
        per_location.join(star.dim_location, "location_id")
        .groupBy("state")
        .agg(
            mean(F.sum("_sum"), F.sum("_priced")).alias("avg_price"),
            F.sum("_rows").alias("listing_count"),
        )
        .orderBy(F.desc_nulls_first("avg_price"))
    )


def price_by_property_type(
    star: Star, exact: bool = False, approximate_median: bool = False
) -> DataFrame:
    """Mean and median price and number of API listings by property type, dearest first.

    Mean, median and count all come from one table of value counts, so the fact is read
    once; `approximate_median` reads it again for a one-pass estimate.
    """
    key = ["property_type_id"]
    listings = star.fact_listings.where(_of_source(API_SOURCE))
    counts = value_counts(listings, key, "price")
    price = F.col("price").cast("decimal(18,4)") if exact else F.col("price")
    means = counts.groupBy(*key).agg(
        mean(
            F.sum(price * F.col("_n")), F.sum(F.when(F.col("price").isNotNull(), F.col("_n")))
        ).alias("avg_price"),
        F.sum("_n").alias("listing_count"),
    )
    if approximate_median:
        medians = approx_median_by(listings, key, "price", "median_price")
    else:
        medians = median_of_counts(counts, key, "price", "median_price")
    return (
        F.broadcast(star.dim_property_type)  # six fixed rows
        .join(means, key)
        .join(medians, key, "left")
        .select("property_type", "avg_price", "median_price", "listing_count")
        .orderBy(F.desc_nulls_first("avg_price"))
    )


def price_gap(star: Star, exact: bool = False) -> DataFrame:
    """Bulk against API mean price of the locations both feeds have."""
    both = _prices_by_source(star.fact_listings, exact).where(
        (F.col("kaggle_rows") > 0) & (F.col("rentcast_rows") > 0)
    )
    return (
        star.dim_location.join(both, "location_id")
        .withColumns(
            {
                "avg_kaggle_price": _feed_mean("kaggle"),
                "avg_rentcast_price": _feed_mean("rentcast"),
            }
        )
        .select("zip_code", "state", *_gap_columns())
        .orderBy(F.desc_nulls_last("pct_change"))
    )


def price_comparison(star: Star, exact: bool = False) -> DataFrame:
    """Mean prices of every location at least one feed has a price for."""
    return (
        star.dim_location.join(_prices_by_source(star.fact_listings, exact), "location_id")
        .where((F.col("kaggle_priced") > 0) | (F.col("rentcast_priced") > 0))
        .withColumns(
            {
                "avg_kaggle_price": _feed_mean("kaggle"),
                "avg_rentcast_price": _feed_mean("rentcast"),
            }
        )
        .select("zip_code", "state", "city", *_gap_columns())
    )


def market_summary(star: Star) -> DataFrame:
    """Latest market snapshot of each zip code.

    Ties fall to the later ingestion, then the higher ids; a NULL date comes last. Spark
    keeps one row per zip code in each task before the shuffle, so a hot zip code is no
    burden.
    """
    latest = Window.partitionBy("zip_code").orderBy(
        F.desc_nulls_last("snapshot_date"),
        F.desc_nulls_last("ingested_at"),
        F.desc_nulls_last("stat_id"),
        F.desc_nulls_last("location_id"),
    )
    return (
        _located_market(star)
        .withColumn("_rank", F.row_number().over(latest))
        .where(F.col("_rank") == 1)
        .select(
            "zip_code", "state", "city", "snapshot_date", "median_listing_price",
            "median_price_per_sqft", "median_days_on_market", "total_listings", "new_listings",
        )
    )


def _located_market(star: Star) -> DataFrame:
    return lookup_join(star.fact_market_stats, star.dim_location, ["location_id"], "inner")


def market_trends(star: Star) -> DataFrame:
    """Market snapshots by zip code and date."""
    return (
        _located_market(star)
        .select(
            "zip_code", "state", "snapshot_date", "median_listing_price",
            "median_days_on_market", "total_listings",
        )
        .orderBy(F.asc_nulls_last("zip_code"), F.asc_nulls_last("snapshot_date"))
    )


def inventory(star: Star, exact: bool = False) -> DataFrame:
    """Listings, mean days on market and mean price of API listings by zip code."""
    per_location = (
        star.fact_listings.where(_of_source(API_SOURCE) & F.col("days_on_market").isNotNull())
        .groupBy("location_id")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.sum("days_on_market").alias("_days"),
            total(F.col("price"), exact).alias("_sum"),
            F.count("price").alias("_priced"),
        )
    )
    return (
        per_location.join(star.dim_location, "location_id")
        .groupBy("zip_code", "state", "city")
        .agg(
            F.sum("_rows").alias("listing_count"),
            mean(F.sum("_days"), F.sum("_rows")).alias("avg_days_on_market"),
            mean(F.sum("_sum"), F.sum("_priced")).alias("avg_price"),
        )
        .orderBy(F.desc_nulls_first("listing_count"))
    )


def cross_source(star: Star, exact: bool = False, per_snapshot: bool = True) -> DataFrame:
    """Listings and mean price of both feeds beside the market's median, by zip code.

    The defining query joins each listing to every market snapshot of its location, so
    its counts grow with the snapshots. `per_snapshot` gives those figures by multiplying
    per-location sums; the listings and snapshots are never paired. `False` counts each
    listing once.
    """
    listings = _prices_by_source(star.fact_listings, exact)
    market = star.fact_market_stats.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("_snapshots"),
        F.count("median_listing_price").alias("_medians"),
        total(F.col("median_listing_price"), exact).alias("_median_sum"),
    )
    located = listings.join(star.dim_location, "location_id").join(market, "location_id", "left")
    # Each listing meets every snapshot of its location, or stands alone without any.
    repeats = F.coalesce("_snapshots", F.lit(1)) if per_snapshot else F.lit(1)
    listed = F.col("rows") if per_snapshot else F.lit(1)

    def times(c: str, factor: Column) -> Column:
        return F.sum(F.col(c) * factor)

    old = mean(times("kaggle_sum", repeats), times("kaggle_priced", repeats))
    new = mean(times("rentcast_sum", repeats), times("rentcast_priced", repeats))
    return (
        located.groupBy("zip_code", "city", "state")
        .agg(
            times("kaggle_rows", repeats).alias("kaggle_listings"),
            times("rentcast_rows", repeats).alias("rentcast_listings"),
            old.alias("avg_kaggle_price"),
            new.alias("avg_rentcast_price"),
            mean(times("_median_sum", listed), times("_medians", listed)).alias(
                "market_median_price"
            ),
        )
        .where((F.col("kaggle_listings") > 0) & (F.col("rentcast_listings") > 0))
        .orderBy((F.col("avg_rentcast_price") - F.col("avg_kaggle_price")).desc_nulls_first())
    )


def register_views(star: Star, exact: bool = False) -> SparkSession:
    """Register the tables and views for `parcelstar.plans.sql.QUERIES`.

    `exact` gives the summed columns in fixed point.
    """
    tables = {name: getattr(star, name) for name in Star.__dataclass_fields__}
    if exact:
        for name, column in (
            ("fact_listings", "price"), ("fact_market_stats", "median_listing_price")
        ):
            fixed = F.col(column).cast("decimal(18,4)")
            tables[name] = tables[name].withColumn(column, fixed)
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    price_comparison(star, exact).createOrReplaceTempView("v_price_comparison_by_zip")
    market_summary(star).createOrReplaceTempView("v_market_summary")
    return star.fact_listings.sparkSession
