import random
from dataclasses import replace

import pytest

from parcelstar.operators import facts
from parcelstar.operators.dimensions import dim_property_type
from parcelstar.plans import analytics
from parcelstar.plans.analytics import Star
from parcelstar.plans.sql import QUERIES
from parcelstar.schemas import DIM_LOCATION, FACT_LISTINGS, FACT_MARKET_STATS, conform
from tests.conftest import plan

LISTING = "location_id long, property_type_id long, price double, source string, days_on_market int"
STAT = ("stat_id long, location_id long, snapshot_date string, median_listing_price double,"
        " ingested_at string")


@pytest.fixture(scope="module")
def star(spark):
    rng = random.Random(3)
    dim = spark.createDataFrame(
        [(i, f"c{i % 5}", f"s{i % 3}", f"z{i // 2}") for i in range(1, 13)], DIM_LOCATION
    )
    rows = []
    for _ in range(600):
        source = rng.choice(["kaggle", "rentcast", "rentcast"])
        place = rng.choice([1, 1, 1, 1, *range(2, 11), 99, None])
        # Location 2 has unpriced bulk listings only, 3 has no API listing, 4 a zero mean.
        if place == 3:
            source = "kaggle"
        price = None if rng.random() < 0.1 or (place == 2 and source == "kaggle") else round(
            rng.uniform(1e5, 9e5), 2)
        if place == 4 and source == "kaggle":
            price = 0.0
        rows.append((place, rng.randint(1, 6), price, source, rng.choice([None, 5, 9])))
    rows.append((11, 7, None, "kaggle", 1))
    stats = [
        (1, 1, "2025-01-01", 10.0, "2025-02-01 00:00:00"),
        (2, 1, "2025-02-01", 11.0, "2025-02-01 00:00:00"),
        (3, 2, "2025-02-01", 12.0, "2025-03-01 00:00:00"),
        (4, 3, "2025-02-01", None, "2025-03-01 00:00:00"),
        (5, 3, None, 14.0, "2025-03-01 00:00:00"),
        (6, 5, "2025-01-01", 15.0, "2025-01-01 00:00:00"),
        (7, 5, "2025-01-01", 16.0, "2025-01-01 00:00:00"),
        (8, 77, "2025-01-01", 16.0, "2025-01-01 00:00:00"),
    ]
    return Star(
        dim,
        dim_property_type(spark),
        conform(spark.createDataFrame(rows, LISTING), FACT_LISTINGS).cache(),
        conform(spark.createDataFrame(stats, STAT), FACT_MARKET_STATS).cache(),
    )


def rounded(df):
    return sorted(
        str([round(r[c], 6) if isinstance(r[c], float) else r[c] for c in sorted(df.columns)])
        for r in df.collect()
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_sql_equals_dataframe(spark, star, name):
    analytics.register_views(star)
    result = getattr(analytics, name)(star)
    statement = spark.sql(QUERIES[name])
    assert statement.columns == result.columns
    assert rounded(statement) == rounded(result)
    assert rounded(result)


@pytest.mark.parametrize(
    "name", ["avg_price_by_state", "price_by_property_type", "price_gap", "price_comparison",
             "inventory", "cross_source"],
)
def test_exact_equals_plain(star, name):
    query = getattr(analytics, name)
    assert rounded(query(star, exact=True)) == rounded(query(star))


def brute(star):
    """Listings with their place, as plain Python rows."""
    places = {r.location_id: r for r in star.dim_location.collect()}
    rows = star.fact_listings.collect()
    return [(places[r.location_id], r) for r in rows if r.location_id in places]


def mean(values):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


def test_cross_source_equals_pairing(star):
    stats = star.fact_market_stats.collect()
    groups = {}
    for place, listing in brute(star):
        mine = [s for s in stats if s.location_id == place.location_id] or [None]
        groups.setdefault((place.zip_code, place.city, place.state), []).extend(
            (listing, s) for s in mine
        )
    expected = {}
    for key, pairs in groups.items():
        old = [l.price for l, _ in pairs if l.source == "kaggle"]
        new = [l.price for l, _ in pairs if l.source == "rentcast"]
        if old and new:
            market = mean([s and s.median_listing_price for _, s in pairs])
            expected[key] = (len(old), len(new), mean(old), mean(new), market)
    got = {
        (r.zip_code, r.city, r.state): (
            r.kaggle_listings, r.rentcast_listings, r.avg_kaggle_price, r.avg_rentcast_price,
            r.market_median_price,
        )
        for r in analytics.cross_source(star).collect()
    }
    assert set(got) == set(expected)
    for key, values in expected.items():
        assert got[key] == pytest.approx(values)
    singly = analytics.cross_source(star, per_snapshot=False).collect()
    once = {r.zip_code + r.city: r for r in singly}
    assert once["z0c1"].kaggle_listings * 2 == got[("z0", "c1", "s1")][0]


def test_price_gap_and_comparison_membership(star):
    gap = {r.zip_code + r.state: r for r in analytics.price_gap(star).collect()}
    assert gap["z1s2"].avg_kaggle_price is None  # unpriced bulk listings still pair up
    assert gap["z2s1"].pct_change is None and gap["z2s1"].avg_kaggle_price == 0.0
    comparison = analytics.price_comparison(star).collect()
    assert {r.city for r in comparison if r.zip_code == "z5"} <= {"c0"}  # 11 has no price
    assert any(r.avg_rentcast_price is None for r in comparison)


def test_null_ordering(star):
    gaps = [r.pct_change for r in analytics.price_gap(star).collect()]
    known = [g for g in gaps if g is not None]
    assert known == sorted(known, reverse=True) and gaps[len(known):] == [None, None]
    states = [r.avg_price for r in analytics.avg_price_by_state(star).collect()]
    assert states == sorted(states, reverse=True)
    trends = [(r.zip_code, r.snapshot_date) for r in analytics.market_trends(star).collect()]
    assert trends == sorted(trends, key=lambda t: (t[0], t[1] is None, t[1] or 0))


def test_latest_snapshot_ties(star):
    latest = {r.zip_code: r.median_listing_price for r in analytics.market_summary(star).collect()}
    # z0: one row; z1: same date, later id wins; z2: same date and ingestion, later id.
    assert latest == {"z0": 11.0, "z1": None, "z2": 16.0}


def test_plans(star):
    assert "WindowGroupLimit" in plan(analytics.market_summary(star))
    gap = plan(analytics.price_gap(star))
    physical = gap.split("== Physical Plan ==")[1]
    assert "partial_sum" in physical and "CartesianProduct" not in physical


def test_approximate_median(star):
    exact = {r.property_type: r for r in analytics.price_by_property_type(star).collect()}
    rough = analytics.price_by_property_type(star, approximate_median=True).collect()
    for r in rough:
        assert r.median_price == pytest.approx(exact[r.property_type].median_price, rel=0.2)


def test_facts_have_the_columns_the_queries_use():
    assert set(facts.BULK_FACT_COLUMNS) | set(facts.API_FACT_COLUMNS) <= set(FACT_LISTINGS.names)


def in_order(rows, key, descending, nulls_first):
    values = [key(r) for r in rows]
    known = [v for v in values if v is not None]
    nulls = [None] * (len(values) - len(known))
    assert values == (nulls + sorted(known, reverse=descending) if nulls_first else sorted(known, reverse=descending) + nulls)


def gap(row):
    new, old = row.avg_rentcast_price, row.avg_kaggle_price
    return None if None in (new, old) else new - old


ORDERS = {
    "avg_price_by_state": (lambda r: r.avg_price, True, True),
    "price_by_property_type": (lambda r: r.avg_price, True, True),
    "price_gap": (lambda r: r.pct_change, True, False),
    "inventory": (lambda r: r.listing_count, True, True),
    "cross_source": (gap, True, True),
    "market_trends": (lambda r: (r.zip_code, str(r.snapshot_date)), False, False),
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_statements_give_their_rows_in_order(spark, star, name):
    frame = getattr(analytics, name)(star).collect()
    analytics.register_views(star)
    for rows in (frame, spark.sql(QUERIES[name]).collect()):
        assert rows
        in_order(rows, *ORDERS[name])


def test_the_median_of_the_statement_follows_the_table(spark, star):
    analytics.register_views(star)
    exact = {r.property_type: r.median_price for r in analytics.price_by_property_type(star).collect()}
    assert {r.property_type: r.median_price for r in spark.sql(QUERIES["price_by_property_type"]).collect()} == exact
    star.fact_listings.where("price > 0").createOrReplaceTempView("fact_listings")
    positive = analytics.price_by_property_type(replace(star, fact_listings=star.fact_listings.where("price > 0")))
    after = {r.property_type: r.median_price for r in spark.sql(QUERIES["price_by_property_type"]).collect()}
    assert after == {r.property_type: r.median_price for r in positive.collect()}
