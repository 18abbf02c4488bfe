from datetime import date

from parcelstar.operators import facts
from parcelstar.plans.transform import transform_api, transform_bulk
from parcelstar.schemas import (
    FACT_LISTINGS,
    MARKET,
    STAGED_BULK_FACT,
    conform,
    literal_frame,
)
from tests.conftest import BATCH, NOW, bulk, listings, market, market_entry

DIM = "location_id long, city string, state string, zip_code string"


def test_transform_bulk(spark):
    tables = transform_bulk(
        bulk(spark, {}, {"city": "Dallas", "bed": 0.0}, {"price": None}), BATCH, NOW
    )
    fact = tables["fact_listings"]
    assert fact.columns == facts.BULK_FACT_COLUMNS + facts.AUDIT_COLUMNS
    rows = {r.location_id: r for r in fact.collect()}
    assert set(rows) == {1, 2}
    assert (rows[1].property_type_id, rows[2].property_type_id) == (1, 2)
    assert (rows[1].source, rows[1].batch_id, rows[1].ingested_at) == ("kaggle", BATCH, NOW)
    assert tables["dim_location"].count() == 2


def test_transform_api_types_and_keys(spark):
    labels = ["Single Family", "Condo", "Townhouse", "Multi-Family", "Land", None]
    given = [{"id": str(i), "propertyType": label} for i, label in enumerate(labels)]
    given.append({"id": "x", "city": "Dallas", "zipCode": "75201"})
    given.append({"id": "y", "city": None})
    tables = transform_api(listings(spark, *given), literal_frame(spark, [], MARKET), BATCH, NOW)
    fact = tables["fact_listings"]
    assert fact.columns == facts.API_FACT_COLUMNS + facts.AUDIT_COLUMNS
    rows = {r.rentcast_id: r for r in fact.collect()}
    assert [rows[str(i)].property_type_id for i in range(6)] == [2, 4, 5, 3, 6, 6]
    assert (rows["0"].location_id, rows["x"].location_id, rows["y"].location_id) == (2, 1, None)
    assert tables["fact_market_stats"].count() == 0
    assert tables["fact_market_stats"].columns == facts.MARKET_COLUMNS + facts.AUDIT_COLUMNS


def test_dimensions_of_both_feeds_align(spark):
    api = transform_api(listings(spark), literal_frame(spark, [], MARKET), BATCH, NOW)
    both = api["dim_location"], transform_bulk(bulk(spark), BATCH, NOW)["dim_location"]
    assert both[0].dtypes == both[1].dtypes
    # The canonical zip code makes them the same place.
    assert both[0].collect() == both[1].collect()


def test_market_rows(spark):
    documents = market(
        spark,
        {
            "97401": {
                "2025-01": market_entry("2025-01-01T00:00:00.000Z"),
                "2025-02": market_entry(None, 413_500.0),
                "2025-03": market_entry("soon"),
            },
            "00000": {},
        },
    )
    rows = sorted(facts.market_rows(documents).collect(), key=lambda r: str(r.snapshot_date))
    assert [r.snapshot_date for r in rows] == [date(2025, 1, 1), date(2025, 2, 1), None]
    assert rows[1].median_listing_price == 413_500.0 and rows[1].zip_code == "97401"


def test_market_stats_fan_out_by_city(spark):
    dim = spark.createDataFrame(
        [(1, "eugene", "oregon", "97401"), (2, "rollingwood", "oregon", "97401")], DIM
    )
    documents = market(
        spark,
        {"97401": {f"2025-0{i}": market_entry() for i in range(1, 6)},
         "99999": {"2025-01": market_entry()}},
    )
    stats = facts.market_stats_fact(documents, dim, BATCH, NOW).collect()
    assert sorted(str(r.location_id) for r in stats) == ["1"] * 5 + ["2"] * 5 + ["None"]


def test_unified_fact_and_conform(spark):
    b = transform_bulk(bulk(spark), BATCH, NOW)["fact_listings"]
    a = transform_api(listings(spark), literal_frame(spark, [], MARKET), BATCH, NOW)
    rows = {r.source: r for r in facts.unified_fact(b, a["fact_listings"]).collect()}
    assert list(rows["kaggle"].asDict()) == FACT_LISTINGS.names
    assert rows["kaggle"].brokered_by == "7" and rows["kaggle"].rentcast_id is None
    assert rows["rentcast"].listed_date == date(2023, 11, 20) and rows["rentcast"].bed is None


def test_conform_by_name_in_any_case(spark):
    schema = "LOCATION_ID string, Brokered_By double, extra string"
    df = spark.createDataFrame([("7", 2.5, "z")], schema)
    row = conform(df, STAGED_BULK_FACT).first()
    assert (row.location_id, row.brokered_by, row.price) == (7, "2.5", None)
    assert list(row.asDict()) == STAGED_BULK_FACT.names


def test_staging_writes_only_the_fields_that_locations_and_facts_need(spark):
    api = transform_api(listings(spark), literal_frame(spark, [], MARKET), BATCH, NOW)
    staged = {"api": api["fact_listings"], "bulk": transform_bulk(bulk(spark), BATCH, NOW)["fact_listings"]}
    unused = {"api": "addressLine1", "bulk": "street"}
    for feed, fact in staged.items():
        files = [f for f in fact.inputFiles() if "/cleaned-" in f]
        assert files
        assert unused[feed] not in spark.read.parquet(*files).columns
