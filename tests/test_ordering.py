import random
import statistics

import pytest
from pyspark.sql import functions as F

from parcelstar.operators.median import approx_median_by, median_by
from parcelstar.operators.ordering import (
    RUN,
    dense_keys,
    group_positions,
    numbered,
    pages,
    sorted_runs,
)
from tests.conftest import many_runs


@pytest.fixture(scope="module")
def hot(spark):
    """Half of the rows in one group, one group NULL."""
    rows = [("hot" if i % 2 else random.Random(i).choice(["a", "b", None]), i) for i in range(3000)]
    return spark.createDataFrame(rows, "g string, v long").repartition(5)


def by_group(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["g"], []).append(r)
    return groups


def test_runs_split_a_hot_group(spark, hot):
    with many_runs(spark):
        runs = sorted_runs(hot, ["g", "v"])
    assert runs.where("g = 'hot'").select(RUN).distinct().count() > 2


def test_dense_keys_follow_sort_order(spark, hot):
    with many_runs(spark):
        keyed = dense_keys(hot, ["g", "v"], "id", start=7).collect()
    order = sorted(keyed, key=lambda r: ((r.g is not None, r.g or ""), r.v))
    assert [r.id for r in order] == list(range(7, 7 + 3000))


def test_dense_keys_of_nothing(spark, hot):
    assert dense_keys(hot.limit(0), ["v"], "id").count() == 0


def test_group_positions(spark, hot):
    with many_runs(spark):
        groups = by_group(group_positions(hot, ["g"], ["v"]).collect())
    assert set(groups) == {"hot", "a", "b", None}
    for rows in groups.values():
        assert [r.position for r in sorted(rows, key=lambda r: r.v)] == list(range(len(rows)))


def test_pages_are_bounded_and_complete(spark, hot):
    with many_runs(spark):
        paged = pages(hot, ["g"], ["v"], 100).collect()
    assert max(len(p.records) for p in paged) == 100
    for g, rows in by_group(hot.collect()).items():
        mine = sorted((p for p in paged if p.g == g), key=lambda p: p.offset)
        assert [p.offset for p in mine] == list(range(0, len(rows), 100))
        assert [x.v for p in mine for x in p.records] == sorted(r.v for r in rows)


@pytest.mark.parametrize("small_values", [1_000_000, 0])
def test_median(spark, small_values):
    rng = random.Random(4)
    values = [None, *range(900)]
    rows = [(rng.choice(["a", "b", None]), rng.choice(values)) for _ in range(4001)]
    rows += [("even", 1), ("even", 2), ("even", 10), ("even", 20), ("one", 5), ("none", None)]
    rows += [("heavy", 3)] * 2000 + [("heavy", 4)] * 2001
    df = spark.createDataFrame(rows, "g string, v int").withColumn("v", F.col("v").cast("double"))
    with many_runs(spark):
        got = {r.g: r.m for r in median_by(df, ["g"], "v", "m", small_values).collect()}
    expected = {
        r.g: r.m
        for r in df.where("v is not null").groupBy("g").agg(F.median("v").alias("m")).collect()
    }
    assert got == expected
    assert got["even"] == statistics.median([1, 2, 10, 20]) and got["heavy"] == 4.0


@pytest.mark.parametrize("small_values", [1_000_000, 0])
@pytest.mark.parametrize(
    "kind, values, median",
    [
        ("decimal(12,2)", ["1.10", "2.20", "2.30", "9.00"], 2.25),
        ("bigint", [str(2**63 - 1), str(2**63 - 3)], float(2**63)),
        ("double", ["1e308", "1.5e308"], 1.25e308),
        ("double", ["5e-324", "5e-324", "5e-324"], 5e-324),
        ("int", ["7"], 7.0),
    ],
)
def test_median_is_a_double_of_any_type(spark, small_values, kind, values, median):
    df = spark.createDataFrame([(v,) for v in values], "v string").select(
        F.lit("g").alias("g"), F.col("v").cast(kind).alias("v")
    )
    found = median_by(df, ["g"], "v", "m", small_values)
    assert dict(found.dtypes)["m"] == "double" and found.first().m == median


def test_numbers_without_gaps(spark):
    df = spark.range(1000).repartition(7).withColumn("run", F.col("id") % 3)
    out = numbered(df, "key", 5)
    assert sorted(r.key for r in out.collect()) == list(range(5, 1005))
    assert out.columns == ["key", *df.columns] and numbered(df.limit(0), "key").count() == 0


def test_approx_median(spark):
    df = spark.range(1, 1002).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    assert abs(approx_median_by(df, ["g"], "v").first()["median"] - 501) <= 1
