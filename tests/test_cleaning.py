from datetime import date

import pytest

from parcelstar.operators.cleaning import clean_api, clean_bulk, within_bounds
from parcelstar.operators.profiling import drop_empty, null_counts, profile
from tests.conftest import bulk, listings, plan, settings

NAN = float("nan")


@pytest.mark.parametrize(
    ("override", "kept"),
    [
        ({}, True),
        ({"price": None}, False),
        ({"price": 0.0}, False),
        ({"price": -100.0}, False),
        ({"price": NAN}, False),
        ({"price": 100_000_000.0}, True),
        ({"price": 100_000_001.0}, False),
        ({"bed": 20.0}, True),
        ({"bed": 21.0}, False),
        ({"bed": None}, True),
        ({"bed": None, "bath": None}, False),
        ({"bath": None}, True),
        ({"city": None}, False),
        ({"state": None}, False),
        ({"zip_code": None}, False),
        ({"zip_code": 0.0}, False),
    ],
)
def test_bulk_rules(spark, override, kept):
    assert clean_bulk(bulk(spark, override)).count() == kept


def test_bulk_conforms_text_and_dates(spark):
    row = clean_bulk(
        bulk(spark, {"city": "\t Eugene \n", "state": " Oregon", "zip_code": 601.0,
                     "prev_sold_date": "not-a-date"})
    ).first()
    assert (row.city, row.state, row.zip_code, row.prev_sold_date) == (
        "eugene", "oregon", "00601", None,
    )
    assert clean_bulk(bulk(spark)).first().prev_sold_date == date(2019, 7, 4)


def test_bulk_dedupe_is_optional(spark):
    twice = bulk(spark, {}, {})
    assert clean_bulk(twice).count() == 2
    assert clean_bulk(twice, dedupe=True).count() == 1


def test_bulk_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    bulk(spark).write.parquet(path)
    with settings(spark, spark__sql__maxMetadataStringLength="2000"):
        text = plan(clean_bulk(spark.read.parquet(path)).select("price"))
    for pushed in ("GreaterThan(price,0.0)", "LessThanOrEqual(price,1.0E8)", "IsNotNull(city)",
                   "GreaterThan(zip_code,0.0)"):
        assert pushed in text
    assert "street" not in text.split("ReadSchema")[1]


def test_api_rules(spark):
    cleaned = clean_api(listings(spark, {"id": None}, {}, {"price": None}))
    assert cleaned.count() == 2
    row = cleaned.first()
    assert "zipCode" not in cleaned.columns
    assert (row.zip_code, row.state, row.city, row.address) == (
        "97401", "oregon", "eugene", "48 Cedar St",
    )


@pytest.mark.parametrize(
    ("lat", "lon", "kept"),
    [
        (35.0, -90.0, True), (0.0, -90.0, False), (35.0, 10.0, False), (None, None, True),
        (24.0, -125.0, True), (49.5, -66.0, True), (23.9999, -90.0, False),
        (None, 10.0, False), (NAN, -90.0, False),
    ],
)
def test_bounding_box(spark, lat, lon, kept):
    assert within_bounds(listings(spark, {"latitude": lat, "longitude": lon})).count() == kept


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, None)], "n int, t string")
    rows = {r.column_name: r for r in profile(df).collect()}
    assert (rows["n"].row_count, rows["n"].null_count, rows["n"].min_value) == (3, 2, "1")
    assert (rows["t"].approx_distinct, rows["t"].max_value) == (2, "b")
    assert {r.column_name: r.null_count for r in null_counts(df).collect()} == {"n": 2, "t": 1}
    assert drop_empty(df, ["n", "t"]).count() == 2
