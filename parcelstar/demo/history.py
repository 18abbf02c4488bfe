"""Queries on versions, values at a date, property records, market documents and comparables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from parcelstar.demo import feeds, market_shapes, shapes
from parcelstar.demo.feeds import table
from parcelstar.operators import breakdown, comparables, facts, properties, timeline
from parcelstar.operators.cleaning import clean_api
from parcelstar.operators.dimensions import dim_property_type
from parcelstar.schemas import FULL_MARKET, PROPERTY, struct
from parcelstar.session import scratch_path, write_through
from parcelstar.sources.market import MarketMonths
from parcelstar.sources.profiles import Profiles
from parcelstar.sources.versions import VersionedTable
from parcelstar.streaming.latest import SNAPSHOT, LatestSnapshots, keep_latest, stream_snapshots

_SNAPSHOT = struct(id=StringType(), price=DoubleType(), status=StringType())


def _columns(columns: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in columns.items()]


def _snapshots(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    listings = write_through(clean_api(feeds.api_raw(spark, sf_dir)).select("id", "price", "status"), "listings")
    out = []
    for n, date in enumerate(market_shapes.LOAD_DATES, start=1):
        numbered = listings.withColumn("n", F.lit(n)).where(market_shapes.LISTED)
        out.append((date, numbered.selectExpr(*_columns(market_shapes.SNAPSHOT))))
    return out


def _listing_versions(spark: SparkSession, sf_dir: str) -> VersionedTable:
    versions = VersionedTable(spark, scratch_path(spark, "versions"), _SNAPSHOT, ["id"], parts=16)
    for date, rows in _snapshots(spark, sf_dir):
        versions.load(rows, date)
    return versions


def listing_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of the API listings after four snapshots, the third without a change."""
    return _listing_versions(spark, sf_dir).history()


def listings_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings as they were between the second snapshot and the third."""
    return _listing_versions(spark, sf_dir).as_of("2024-02-15")


def _market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.market_rows(feeds.market_documents(spark, sf_dir))


def place_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of what a zip code is known for, from its market months."""
    known = _market(spark, sf_dir).selectExpr(
        "zip_code", "snapshot_date", *_columns(market_shapes.PLACE_ATTRIBUTES)
    )
    return timeline.versions(known, ["zip_code"], "snapshot_date", list(market_shapes.PLACE_ATTRIBUTES))


def value_at_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each API listing with the market figures of its zip code that held when it was listed."""
    api = clean_api(feeds.api_raw(spark, sf_dir))
    listed = F.to_date(F.substring("listedDate", 1, 10))
    rows = api.select("id", "zip_code", "price", listed.alias("listed_date"))
    return timeline.value_at(
        rows, _market(spark, sf_dir), ["zip_code"], "listed_date", "snapshot_date",
        ["median_listing_price", "total_listings"],
    )


def _map_of(rows: DataFrame, key: str, year: str, name: str, *values: str) -> DataFrame:
    entry = F.struct(year, F.struct(*values))
    return rows.groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias(name))


def property_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A property per customer, its maps with gaps and some absent, through JSON."""
    orders = table(spark, sf_dir, "orders")
    m = market_shapes
    yearly = orders.groupBy("o_custkey", F.expr(m.YEARLY["year"]).alias("year")).agg(
        *[F.expr(m.YEARLY[c]).alias(c) for c in ("value", "land", "total")]
    )
    yearly = yearly.withColumn("improvements", F.col("value") - F.col("land"))
    sales = orders.where(m.SOLD).groupBy(
        "o_custkey", F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("date")
    ).agg(F.max("o_totalprice").alias("price"), F.lit("Sale").alias("event"))
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.expr("'c-' || cast(c_custkey AS string)").alias("id"),
        F.expr("cast(c_custkey AS string) || ' Main Street'").alias("addressLine1"),
        F.concat(F.lit(" "), "c_mktsegment").alias("city"),
        F.expr(shapes.state_code("c_nationkey").replace(shapes.FIRST, "0")).alias("state"),
        F.expr("lpad(cast(501 + c_nationkey * 100 + c_custkey % 3 AS string), 5, '0')").alias("zipCode"),
        F.expr("nullif(element_at(array('Condo', 'Land', 'Townhouse', ''), cast(c_custkey % 4 + 1 AS int)), '')").alias("propertyType"),
        F.expr("cast(1950 + c_custkey % 70 AS int)").alias("yearBuilt"),
        F.struct(F.expr("c_custkey % 2 = 0").alias("cooling")).alias("features"),
    )
    parts = [
        _map_of(yearly.where(m.ASSESSED), "o_custkey", "year", "taxAssessments", "value", "land", "improvements"),
        _map_of(yearly.where(m.TAXED), "o_custkey", "year", "propertyTaxes", "total"),
        _map_of(sales, "o_custkey", "date", "history", "event", "price"),
    ]
    records = reduce(lambda left, right: left.join(right, "o_custkey", "left"), parts, people)
    texts = records.select(F.to_json(F.struct("*")).alias("json"))
    return texts.select(F.from_json("json", PROPERTY).alias("r")).select("r.*")


def property_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assessments, taxes and sales by year, with the change of the assessed value."""
    return properties.property_values(property_records(spark, sf_dir))


def property_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of fact_property_details, with the places of both feeds."""
    dim = write_through(feeds.locations(*feeds.cleaned(spark, sf_dir)), "dim-location")
    cleaned = properties.clean_properties(property_records(spark, sf_dir))
    fact = properties.property_details_fact(
        cleaned, dim, dim_property_type(spark), shapes.BATCH_API, shapes.INGESTED_AT
    )
    return fact.select(
        "rentcast_id", "location_id", "property_type_id", "address", "year_built", "cooling"
    )


def _statistics() -> list:
    return [F.expr(sql.replace('"', "`")).alias(c) for c, sql in market_shapes.STATISTICS.items()]


def full_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A market document per zip code with both breakdowns and its months, through JSON."""
    raw = feeds.api_raw(spark, sf_dir).withColumns(
        {"month": F.substring("listedDate", 1, 7), "bedrooms": F.col("bedrooms").cast("int")}
    )
    raw = write_through(raw, "api-raw")

    def entries(detail: str) -> DataFrame:
        found = raw.where(F.col(detail).isNotNull()).groupBy("zipCode", detail).agg(*_statistics())
        return found.withColumn("e", F.struct(detail, *market_shapes.STATISTICS))

    def listed(detail: str, name: str) -> DataFrame:
        return entries(detail).groupBy("zipCode").agg(F.collect_list("e").alias(name))

    months = entries("month").groupBy("zipCode").agg(
        F.map_from_entries(F.collect_list(F.struct("month", "e"))).alias("history")
    )
    parts = [
        listed("propertyType", "dataByPropertyType"), listed("bedrooms", "dataByBedrooms"), months,
    ]
    whole = reduce(
        lambda left, right: left.join(right, "zipCode", "left"),
        parts,
        raw.groupBy("zipCode").agg(*_statistics()),
    )
    sale = F.struct(*[c for c in whole.columns if c != "zipCode"]).alias("saleData")
    texts = whole.select(F.to_json(F.struct("zipCode", sale)).alias("json"))
    return texts.select(F.from_json("json", FULL_MARKET).alias("d")).select("d.*")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.api_raw(spark, sf_dir)
    return raw.groupBy(F.col("zipCode").alias("zip_code")).agg(F.min("state").alias("state"))


def market_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings and prices by state and type, bedrooms or month, with all totals."""
    return breakdown.market_breakdown(
        full_documents(spark, sf_dir), _places(spark, sf_dir), exact=True
    )


def market_breakdown_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zip codes whose breakdowns do not add up: listings without a type are in none."""
    return breakdown.breakdown_gaps(full_documents(spark, sf_dir))


def _said_in(documents: DataFrame, modulus: int, updated: str, more: int) -> DataFrame:
    """A file: the months whose listings a modulus divides, with other prices and a date."""
    sale = F.col("saleData")
    said = F.map_filter(sale["history"], lambda _, e: e["totalListings"] % modulus == 0)
    said = F.transform_values(said, lambda _, e: e.withField("medianPrice", e["medianPrice"] + more))
    sale = sale.withField("history", said)
    return documents.withColumn(
        "saleData", sale.withField("lastUpdatedDate", F.lit(f"{updated}T00:00:00.000Z"))
    )


def market_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market documents landed file by file: a late one, one twice; the latest statements stay."""
    documents = write_through(full_documents(spark, sf_dir), "documents")
    months = MarketMonths(spark, scratch_path(spark, "market-months"))
    for name in ("first", "corrections", "late", "first"):
        months.land(_said_in(documents, *market_shapes.FILES[name]))
    return months.months().select(
        "zip_code", "month", F.date_format("updated_at", "yyyy-MM-dd").alias("updated"),
        F.col("entry.medianPrice").alias("median_price"), F.col("entry.totalListings").alias("total_listings"),
    )


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice",
        F.expr(market_shapes.LATITUDE).alias("latitude"),
        F.expr(market_shapes.LONGITUDE).alias("longitude"),
    )


def nearest_comparables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest sales of the same kind; a third of all lie within a mile."""
    return comparables.comparables(
        _sales(spark, sf_dir), "o_orderkey", "o_orderpriority", "o_totalprice",
        market_shapes.NEAREST, market_shapes.MILES,
    )


def valuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An estimate for each sale from its nearest comparables."""
    found = comparables.valuations(
        _sales(spark, sf_dir), "o_orderkey", "o_orderpriority", "o_totalprice",
        market_shapes.NEAREST, market_shapes.MILES,
    )
    return found.withColumn("estimate", F.round("estimate", 4))


def profile_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders profiled in three batches, and whether the merged estimates are close.

    Distinct values to 5 % of their number, the median to 2 % of the rows.
    """
    orders = table(spark, sf_dir, "orders")
    store = Profiles(spark, scratch_path(spark, "profiles"))
    for n in (0, 1, 2, 0):  # the first batch comes twice
        store.add(f"b{n}", orders.where(F.col("o_orderkey") % 3 == n))
    found = write_through(store.profile((0.5,)), "profile")
    numbers = ["o_orderkey", "o_custkey", "o_totalprice"]
    medians = {r["column_name"]: r["quantiles"][0] for r in found.collect() if r["quantiles"]}
    exact = [F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("distinct"),
             *([F.avg((F.col(c) <= medians[c]).cast("int")).alias("rank")] if c in numbers
               else [F.lit(0.5).alias("rank")])) for c in orders.columns]
    row = orders.agg(*[e.alias(f"e{i}") for i, e in enumerate(exact)])
    known = row.select(F.inline(F.array(*[f"e{i}" for i in range(len(exact))])))
    off = F.abs(F.col("approx_distinct") - F.col("distinct")) / F.col("distinct")
    return found.join(known, "column_name").select(
        "column_name", "row_count", "null_count",
        (off <= 0.05).alias("distinct_is_close"),
        (F.abs(F.col("rank") - 0.5) <= 0.02).alias("median_is_close"),
    )


def latest_by_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest market snapshots by a stream that is started three times, in any order of rows."""
    star = feeds.star(spark, sf_dir)
    located = star.fact_market_stats.join(star.dim_location, "location_id")
    located = write_through(located.select(*SNAPSHOT.names), "located")
    drop, checkpoint = scratch_path(spark, "drop"), scratch_path(spark, "stream")
    latest = LatestSnapshots(spark, scratch_path(spark, "latest"))
    third = F.pmod(F.xxhash64("zip_code", "snapshot_date", "location_id"), F.lit(3))
    for n in (2, 0, 1):
        located.where(third == n).write.mode("append").parquet(drop)
        keep_latest(stream_snapshots(spark, drop), latest, checkpoint)
    return latest.read().drop("ingested_at", "stat_id", "location_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "listing_versions": listing_versions,
    "listings_as_of": listings_as_of,
    "place_versions": place_versions,
    "value_at_date": value_at_date,
    "property_values": property_values,
    "property_details": property_details,
    "market_breakdown": market_breakdown,
    "market_breakdown_gaps": market_breakdown_gaps,
    "market_ingest": market_ingest,
    "nearest_comparables": nearest_comparables,
    "valuations": valuations,
    "profile_by_batch": profile_by_batch,
    "latest_by_stream": latest_by_stream,
}
