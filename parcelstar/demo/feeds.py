"""The shaped feeds and the star schema built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstar.constants import API_SOURCE, BULK_SOURCE, LOCATION_KEY
from parcelstar.demo import shapes
from parcelstar.operators import facts
from parcelstar.operators.cleaning import clean_api, clean_bulk
from parcelstar.operators.dimensions import build_dim_location, dim_property_type
from parcelstar.plans.analytics import Star
from parcelstar.schemas import FACT_MARKET_STATS, MARKET, conform, literal_frame
from parcelstar.session import write_through


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shaped(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*shapes.select_items(columns))


def _orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Catalyst broadcasts the customers by file size; beyond that AQE splits hot keys.
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def bulk_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(_orders_customers(spark, sf_dir), shapes.BULK_RAW)


def api_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, suppliers = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    return _shaped(
        items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")), shapes.API_RAW
    )


def market_documents(
    spark: SparkSession, sf_dir: str, unknown_zip: str | None = None
) -> DataFrame:
    """One JSON document per zip code, parsed back with the contract's schema.

    `unknown_zip` is the zip code of one more document, a copy of the first one's.

    Every second month carries its date, every seventh an unreadable one. A document
    holds one entry per calendar month.
    """
    monthly = (
        _orders_customers(spark, sf_dir)
        .groupBy(*[F.expr(e).alias(c) for c, e in shapes.MARKET_KEYS.items()])
        .agg(*[F.expr(e).alias(c) for c, e in shapes.MARKET_FIGURES.items()])
    )
    if unknown_zip is not None:
        first = monthly.agg(F.min("zip_code").alias("zip_code"))
        copy = monthly.join(F.broadcast(first), "zip_code").withColumn("zip_code", F.lit(unknown_zip))
        monthly = monthly.unionByName(copy)
    date = (
        F.when(F.col("totalListings") % 7 == 0, "unknown")
        .when(F.col("totalListings") % 2 == 0, F.concat("month", F.lit("-01T00:00:00.000Z")))
        .alias("date")
    )
    entry = F.struct("month", F.struct(date, *shapes.MARKET_FIGURES))
    document = F.struct(
        F.col("zip_code").alias("zipCode"),
        F.struct(F.map_from_entries(F.collect_list(entry)).alias("history")).alias("saleData"),
    )
    texts = monthly.groupBy("zip_code").agg(F.to_json(document).alias("json"))
    return texts.select(F.from_json("json", MARKET).alias("d")).select("d.*")


def cleaned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return clean_bulk(bulk_raw(spark, sf_dir)), clean_api(api_raw(spark, sf_dir))


def cleaned_once(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The cleaned feeds, written: for dimensions and facts that both read them."""
    bulk, api = cleaned(spark, sf_dir)
    return write_through(bulk, "bulk"), write_through(api, "api")


def locations(bulk: DataFrame, api: DataFrame) -> DataFrame:
    """One dimension over both feeds."""
    return build_dim_location(bulk.select(*LOCATION_KEY).unionByName(api.select(*LOCATION_KEY)))


def star(spark: SparkSession, sf_dir: str, market: bool = True) -> Star:
    """Both feeds as a warehouse would hold them."""
    # Cleaned twice, each time with the columns needed: cheaper than writing them all.
    bulk, api = cleaned(spark, sf_dir)
    # Used by every join below: written once.
    dim = write_through(locations(bulk, api), "dim-location")
    types = dim_property_type(spark)
    listings = facts.unified_fact(
        facts.bulk_fact(bulk, dim, types, shapes.BATCH_BULK, shapes.INGESTED_AT),
        facts.api_fact(api, dim, types, shapes.BATCH_API, shapes.INGESTED_AT),
    )
    if market:
        documents = market_documents(spark, sf_dir)
        stats = facts.market_stats_fact(documents, dim, shapes.BATCH_API, shapes.INGESTED_AT)
    else:
        stats = literal_frame(spark, [], FACT_MARKET_STATS)
    return Star(dim, types, listings, conform(stats, FACT_MARKET_STATS))


def staged_locations(bulk: DataFrame, api: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The two staged dimensions and their union, each row with its feed."""
    dim_bulk, dim_api = build_dim_location(bulk), build_dim_location(api)
    both = dim_bulk.withColumn("source", F.lit(BULK_SOURCE)).unionByName(
        dim_api.withColumn("source", F.lit(API_SOURCE))
    )
    return dim_bulk, dim_api, both
