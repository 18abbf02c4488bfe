import itertools
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from parcelstar.operators.breakdown import breakdown_gaps, breakdown_rows, market_breakdown
from parcelstar.operators import comparables as nearby
from parcelstar.operators.comparables import comparables, valuations
from parcelstar.operators.dimensions import dim_property_type
from parcelstar.operators.properties import (
    clean_properties,
    property_details_fact,
    property_values,
    read_properties,
)
from parcelstar.schemas import FULL_MARKET, MARKET_STATISTICS, PROPERTY
from parcelstar.sources.market import MarketMonths


def parsed(spark, records, schema):
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "j string")
    return df.select(F.from_json("j", schema).alias("r")).select("r.*")


RECORD = {
    "id": "p-1", "addressLine1": "5 Oak Street", "city": " Eugene ", "state": "OR", "zipCode": "97401",
    "propertyType": "Condo", "yearBuilt": 1990, "lastSaleDate": "2021-06-15T00:00:00.000Z", "lastSalePrice": 295000,
    "hoa": {"fee": 45}, "features": {"cooling": True, "garage": False},
    "taxAssessments": {"2020": {"value": 100.0, "land": 40.0, "improvements": 60.0}, "2023": {"value": 150.0}, "2022": {"land": 1.0}},
    "propertyTaxes": {"2021": {"total": 5.0}, "2023": {"total": 6.0}, "n/a": {"total": 1.0}},
    "history": {"2021-06-15": {"event": "Sale", "price": 295.0}, "2021-08-01": {"price": 300.0}, "2016-03-22": {"price": 210.0}},
}


def test_maps_are_aligned_on_the_union_of_their_years(spark):
    rows = property_values(parsed(spark, [RECORD], PROPERTY)).collect()
    got = [(r.year, r.assessed_value, r.land_value, r.tax_total, r.sale_price, r.prior_year, r.value_change) for r in rows]
    assert sorted(got) == [
        (2016, None, None, None, 210.0, None, None),
        (2020, 100.0, 40.0, None, None, None, None),
        (2021, None, None, 5.0, 300.0, None, None),
        (2022, None, 1.0, None, None, None, None),
        (2023, 150.0, None, 6.0, None, 2020, 50.0),
    ]
    last = [r for r in rows if r.year == 2023][0]
    assert (last.value_pct_change, last.tax_pct) == (50.0, 4.0)


def test_absent_and_empty_maps(spark):
    records = [{"id": "a"}, {"id": "b", "taxAssessments": {}}, {"id": "c", "propertyTaxes": {"2020": None, "2021": {"total": 0}}}]
    rows = property_values(parsed(spark, records, PROPERTY)).collect()
    assert [(r.rentcast_id, r.year, r.tax_total, r.tax_pct) for r in rows] == [("c", 2020, None, None), ("c", 2021, 0.0, None)]
    zero = {"id": "z", "taxAssessments": {"2020": {"value": 0}, "2021": {"value": 5}}}
    assert [r.value_pct_change for r in property_values(parsed(spark, [zero], PROPERTY)).collect()] == [None, None]


def test_property_details(spark, tmp_path):
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, [RECORD, RECORD | {"id": None}, RECORD | {"id": "p-2", "zipCode": "1", "latitude": 5.0}, RECORD | {"id": "p-3", "zipCode": "1"}])))
    dim = spark.createDataFrame([(7, "eugene", "oregon", "97401")], "location_id long, city string, state string, zip_code string")
    cleaned = clean_properties(read_properties(spark, str(tmp_path / "p.json")))
    rows = property_details_fact(cleaned, dim, dim_property_type(spark), "b", "2026-01-01T00:00:00+00:00").collect()
    got = sorted((r.rentcast_id, r.location_id, r.property_type_id, r.address, str(r.last_sale_date), r.hoa_fee, r.cooling, r.pool) for r in rows)
    assert got == [
        ("p-1", 7, 4, "5 Oak St", "2021-06-15", 45.0, True, None),
        ("p-3", None, 4, "5 Oak St", "2021-06-15", 45.0, True, None),
    ]


def stats(n, price, **more):
    return {"totalListings": n, "averagePrice": price, "minPrice": price, "maxPrice": price, "newListings": 1, "averageDaysOnMarket": 10.0} | more


def document(zip_code, types, beds, months=None, total=None):
    sale = stats(total or sum(n for n, _ in types.values()), 100.0) | {
        "dataByPropertyType": [stats(n, p, propertyType=t) for t, (n, p) in types.items()],
        "dataByBedrooms": [stats(n, p, bedrooms=b) for b, (n, p) in beds.items()],
        "history": {m: stats(n, p) for m, (n, p) in (months or {}).items()},
    }
    return {"zipCode": zip_code, "saleData": sale}


def test_totals_of_all_groupings(spark):
    documents = parsed(
        spark,
        [
            document("1", {"Condo": (2, 10.0), "Land": (3, 20.0)}, {0: (4, 1.0), 3: (1, 6.0)}, {"2025-01": (5, 7.0)}),
            document("2", {"Condo": (6, 30.0)}, {3: (6, 2.0)}),
            document("9", {"Condo": (1, 50.0)}, {}),
            {"zipCode": "3"}, {"zipCode": "4", "saleData": {"dataByPropertyType": None}},
        ],
        FULL_MARKET,
    )
    places = spark.createDataFrame([("1", "x"), ("2", "y")], "zip_code string, state string")
    rows = {(r.level, r.state, r.kind, r.detail): r for r in market_breakdown(documents, places).collect()}
    assert rows[0, "x", "property_type", "Condo"].avg_price == 10.0
    assert rows[1, "x", "property_type", None].listings == 5
    assert rows[1, "x", "property_type", None].avg_price == 16.0
    assert rows[2, None, "property_type", "Condo"].listings == 9
    assert rows[0, None, "property_type", "Condo"].listings == 1  # no place known
    assert rows[3, None, "property_type", None].listings == rows[3, None, "all", None].listings == 12
    assert rows[3, None, "bedrooms", None].listings == 11
    assert rows[2, None, "bedrooms", "3"].max_price == 6.0
    assert rows[3, None, "month", None].listings == 5
    gaps = breakdown_gaps(documents).collect()
    assert [(r.zip_code, r.listings, r.by_type, r.by_bedrooms) for r in gaps] == [("9", 1, 1, 0)]
    assert breakdown_rows(documents.limit(0)).count() == 0


def said(spark, zip_code, updated, **months):
    history = {m.replace("m", "2025-"): stats(n, float(n)) for m, n in months.items()}
    return parsed(spark, [{"zipCode": zip_code, "saleData": {"lastUpdatedDate": updated and f"{updated}T00:00:00.000Z", "history": history}}], FULL_MARKET)


def months_of(store):
    return sorted((r.zip_code, r.month, r.entry.totalListings) for r in store.months().collect())


def test_files_in_any_order_and_repeated_give_one_state(spark, tmp_path):
    files = [
        ("1", "2025-03-01", {"m01": 5, "m02": 6}), ("1", "2025-04-01", {"m02": 7, "m03": 8}),
        ("1", "2025-02-01", {"m01": 1, "m02": 2, "m00": 3}),
    ]
    for number, order in enumerate(itertools.permutations(range(3))):
        store = MarketMonths(spark, str(tmp_path / f"s{number}"))
        for i in (*order, order[0]):
            zip_code, updated, months = files[i]
            store.land(said(spark, zip_code, updated, **months))
        assert months_of(store) == [("1", "2025-00", 3), ("1", "2025-01", 5), ("1", "2025-02", 7), ("1", "2025-03", 8)]


def test_only_changed_months_are_rewritten(spark, tmp_path):
    store = MarketMonths(spark, str(tmp_path / "s"))
    assert store.land(said(spark, "1", "2025-03-01", m01=5, m02=6)) == {"entries": 2, "months": ["2025-01", "2025-02"]}
    assert store.land(said(spark, "1", "2025-03-01", m01=5, m02=6)) == {"entries": 0, "months": []}
    assert store.land(said(spark, "2", "2025-01-01", m02=9)) == {"entries": 1, "months": ["2025-02"]}
    assert store.land(said(spark, "1", None, m01=99)) == {"entries": 0, "months": []}
    assert store.land(said(spark, None, "2026-01-01", m01=99)) == {"entries": 0, "months": []}
    assert months_of(store) == [("1", "2025-01", 5), ("1", "2025-02", 6), ("2", "2025-02", 9)]
    assert store.months().schema["entry"].dataType == MARKET_STATISTICS


def miles(a, b):
    north = math.sin(math.radians(b[3] - a[3]) / 2) ** 2
    east = math.sin(math.radians(b[4] - a[4]) / 2) ** 2
    inner = north + math.cos(math.radians(a[3])) * math.cos(math.radians(b[3])) * east
    return round(2 * 3958.8 * math.asin(math.sqrt(inner)), 6)


def places(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind, price = rng.choice("ab"), rng.choice([float(rng.randint(1, 99)), None])
        at = rng.random()
        if at < 0.4:  # one cell, few places
            lat, lon = 40 + rng.randint(0, 20) / 20000, -75 - rng.randint(0, 20) / 20000
        elif at < 0.6:
            lat, lon = 40 + rng.random() / 3, -75 - rng.random() / 3
        else:
            lat, lon = 24 + rng.random() * 25, -66 - rng.random() * 59
        rows.append((i, kind, price, lat, lon))
    return rows


@pytest.mark.parametrize("k, radius", [(5, 10.0), (1, 2.0), (12, 60.0)])
def test_comparables_equal_all_pairs(spark, k, radius):
    rows = places(900, k)
    bad = [(5000, None, 1.0, 40.0, -75.0), (5001, "a", 1.0, None, -75.0), (None, "a", 1.0, 40.0, -75.0), rows[3]]
    df = spark.createDataFrame(rows + bad, "id long, kind string, price double, latitude double, longitude double")
    got = {}
    for r in comparables(df, "id", "kind", "price", k, radius).collect():
        got.setdefault(r.id, []).append((r["rank"], r.distance, r.comparable_id, r.price))
    for a in rows:
        near = sorted((miles(a, b), b[0], b[2]) for b in rows if b[0] != a[0] and b[1] == a[1] and abs(a[3] - b[3]) < 2)
        near = [(i, *x) for i, x in enumerate([x for x in near if x[0] <= radius][:k], start=1)]
        assert sorted(got.get(a[0], [])) == near
    assert set(got) <= {r[0] for r in rows}


def test_valuations_leave_out_missing_values(spark):
    rows = [(1, "a", 10.0, 40.0, -75.0), (2, "a", None, 40.0, -75.0), (3, "a", 30.0, 40.001, -75.0), (4, "b", 1.0, 40.0, -75.0)]
    df = spark.createDataFrame(rows, "id long, kind string, price double, latitude double, longitude double")
    got = {r.id: (r.comparable_count, r.estimate, r.range_low, r.range_high) for r in valuations(df, "id", "kind", "price").collect()}
    assert got == {1: (1, 30.0, 30.0, 30.0), 2: (2, 20.0, 10.0, 30.0), 3: (1, 10.0, 10.0, 10.0)}
    assert valuations(df.limit(0), "id", "kind", "price").count() == 0


def test_a_level_sorts_only_what_lies_within_its_radius(spark):
    rows = [(i, "a", float(i), 40.0 + i / 500, -75.0) for i in range(40)]  # a row of points, 0.138 miles apart
    df = spark.createDataFrame(rows, "_id long, _kind string, _value double, _lat double, _lon double")
    grid = nearby.Grid(5.0)
    points = nearby._points(df, grid, 20)
    level = F.lit(nearby.FINEST * nearby.STEP // 5)  # cells for a quarter of the radius
    found = nearby._found(points, points.select(*nearby._POINT, level.alias("_level")), grid, 20).collect()
    assert len(found) == 40
    assert all(one["_miles"] <= 1.25 for r in found for one in r["_near"])
    assert {len(r["_near"]) for r in found} == set(range(10, 20))  # 9 to each side, fewer at the ends
