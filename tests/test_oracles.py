"""Every registered query against its SQL counterpart in DuckDB, over whole tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from parcelstar.demo.registry import QUERIES

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
TABLES = ["nation", "customer", "supplier", "orders", "lineitem", "events"]

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    yield con
    con.close()


def text(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, database, name):
    df = entry_points.queries()[name](spark, str(DATA))
    result = database.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    theirs = sorted(
        tuple(text(row[names.index(c)]) for c in sorted(names)) for row in result.fetchall()
    )
    ours = sorted(tuple(text(row[c]) for c in sorted(names)) for row in df.collect())
    assert ours == theirs and ours


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
