import sys
from contextlib import contextmanager
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from parcelstar.schemas import BULK, LISTING, MARKET  # noqa: E402
from parcelstar.session import build_session  # noqa: E402

BATCH, NOW = "batch-one", "2025-03-09T06:30:00+00:00"

BULK_ROW = {
    "brokered_by": 7.0, "status": "for_sale", "price": 412_500.0, "bed": 2.0, "bath": 1.0,
    "acre_lot": 0.25, "street": 88.0, "city": "Eugene", "state": "Oregon", "zip_code": 97401.0,
    "house_size": 1180.0, "prev_sold_date": "2019-07-04",
}

LISTING_ROW = {
    "id": "listing-0001", "addressLine1": "48 Cedar Street", "city": "Eugene",
    "state": "OR", "zipCode": "97401", "latitude": 44.052, "longitude": -123.087,
    "propertyType": "Townhouse", "price": 462_500.0, "status": "Active", "bedrooms": 4.0,
    "bathrooms": 3.0, "squareFootage": 2150.0, "lotSize": 6400.0, "daysOnMarket": 21,
    "listedDate": "2023-11-20T00:00:00.000Z",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def bulk(spark, *overrides):
    rows = [BULK_ROW | o for o in overrides or [{}]]
    return spark.createDataFrame([tuple(r[n] for n in BULK.names) for r in rows], BULK)


def listings(spark, *overrides):
    rows = [LISTING_ROW | o for o in overrides or [{}]]
    return spark.createDataFrame([tuple(r[n] for n in LISTING.names) for r in rows], LISTING)


def market_entry(date=None, price=412_500.0, total=100):
    return (date, price, 180.0, 40.0, total, 10)


def market(spark, documents):
    """Documents as {zip: {month: entry}}."""
    return spark.createDataFrame([(z, (history,)) for z, history in documents.items()], MARKET)


@contextmanager
def settings(spark, **conf):
    """Settings for a while; names with __ for the dots."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def many_runs(spark):
    """Keep all shuffle partitions, so that small test data spreads over several."""
    return settings(spark, **{"spark__sql__adaptive__coalescePartitions__enabled": "false"})


def plan(df):
    """The executed plan with the pushed filters."""
    return df._jdf.queryExecution().toString()
