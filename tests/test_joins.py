import math
import random

import pytest
from pyspark.sql import functions as F

from parcelstar.operators import joins
from parcelstar.operators.dimensions import (
    build_dim_location,
    dim_property_type,
    merge_dim_location,
)
from tests.conftest import many_runs, plan, settings

DIM = "location_id long, city string, state string, zip_code string"


@pytest.fixture(scope="module")
def large(spark):
    rng = random.Random(1)
    rows = [("k0" if rng.random() < 0.4 else rng.choice([None, *"abcdef"]), i) for i in range(900)]
    return spark.createDataFrame(rows, "k string, v int").repartition(4)


@pytest.fixture(scope="module")
def lookup(spark):
    rows = [("k0", 1), ("a", 2), ("a", 3), ("b", 4), ("zz", 5), (None, 6)]
    return spark.createDataFrame(rows, "k string, x int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(large, lookup, how):
    plain = sorted(map(str, large.join(lookup, "k", how).collect()))
    assert sorted(map(str, joins.lookup_join(large, lookup, ["k"], how).collect())) == plain
    for slots in ("2", "8", "900"):
        with settings(large.sparkSession, spark__sql__shuffle__partitions=slots):
            salted = joins.salted_join(large, lookup, ["k"], how)
            assert sorted(map(str, salted.collect())) == plain
    shuffled = joins.lookup_join(large, lookup, ["k"], how, max_rows=0)
    assert sorted(map(str, shuffled.collect())) == plain


def test_large_lookup_is_not_broadcast_by_hint(large, lookup):
    assert "_salt" in plan(joins.lookup_join(large, lookup, ["k"], max_rows=2))
    assert "_salt" not in plan(joins.lookup_join(large, lookup, ["k"]))
    assert not joins.fits_broadcast(lookup, max_bytes=3)


def test_hot_and_null_keys_spread_over_the_partitions(spark):
    rows = spark.range(8000).select(
        F.when(F.col("id") % 3 == 0, "k0").when(F.col("id") % 3 == 1, None)
        .otherwise(F.col("id").cast("string")).alias("k"), "id",
    )
    lookup = spark.createDataFrame([("k0", 1), ("2", 2)], "k string, x int")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"), many_runs(spark):
        joined = joins.salted_join(rows, lookup, ["k"], "left")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert joined.where("x = 1").count() == 2667
    assert len(sizes) == 8 and max(sizes) < 2200


def test_hot_keys(large):
    total, n = large.count(), large.where("k = 'k0'").count()
    (hot,) = joins.hot_keys(large, ["k"], 5).collect()
    assert hot.k == "k0" and hot._salts == min(5, math.ceil(2 * n / (total / 5)))
    assert joins.hot_keys(large, ["k"], 1).count() == 0


def test_copies_follow_the_size_of_a_key(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in joins.hot_keys(rows, ["k"], 10).collect()] == [(0, 8)]


def test_every_column_counts_towards_the_broadcast_bound(spark):
    rows = spark.range(10).select("id", F.array_repeat(F.lit(7), 1000).alias("numbers"))
    assert not joins.fits_broadcast(rows, max_bytes=10_000)
    assert joins.fits_broadcast(rows.select("id"), max_bytes=10_000)


def test_batch_guard_keeps_new_and_null_batches(spark):
    new = spark.createDataFrame([("b1", 1), ("b2", 2), (None, 3)], "batch_id string, v int")
    old = spark.createDataFrame([("b1",), (None,)], "batch_id string")
    guarded = joins.batch_guard(new, old)
    assert sorted(r.v for r in guarded.collect()) == [2, 3]
    assert "LeftAnti" in plan(guarded)


def test_remap_location(spark):
    staged = spark.createDataFrame(
        [("bulk", 1, "a", "s", "1"), ("bulk", 2, "b", "s", "2"),
         ("api", 1, "b", "s", "2"), ("api", 2, "c", "s", "3")],
        "source string, location_id long, city string, state string, zip_code string",
    )
    dim = spark.createDataFrame(
        [(10, "a", "s", "1"), (11, "b", "s", "2"), (12, "c", "s", "3")], DIM
    )
    fact = spark.createDataFrame(
        [("bulk", 1, "x"), ("bulk", 2, "y"), ("api", 2, "z"), ("api", None, "lost")],
        "source string, location_id long, tag string",
    )
    scoped = joins.remap_location(fact, staged, dim)
    assert scoped.columns == fact.columns
    assert {(r.tag, r.location_id) for r in scoped.collect()} == {("x", 10), ("y", 11), ("z", 12)}
    loose = joins.remap_location(fact, staged, dim, scope_by_source=False)
    assert sorted((r.tag, r.location_id) for r in loose.collect()) == [
        ("x", 10), ("x", 11), ("y", 11), ("y", 12), ("z", 11), ("z", 12),
    ]


def test_orphans_and_duplicates(spark):
    fact = spark.createDataFrame([(1,), (9,), (9,), (None,)], "location_id long")
    dim = spark.createDataFrame([(1,), (2,)], "location_id long")
    lost = {r.location_id: r.row_count for r in joins.orphans(fact, dim, "location_id").collect()}
    assert lost == {9: 2, None: 1}
    assert [tuple(r) for r in joins.duplicate_keys(fact, ["location_id"]).collect()] == [(9, 2)]


def test_dim_location(spark):
    rows = [("b", "s1", "1"), ("b", "s1", "1"), ("a", "s1", "9"), ("a", "s0", "5"),
            (None, "s0", "5"), ("a", None, "5"), ("a", "s0", None)]
    with many_runs(spark):
        df = spark.createDataFrame(rows, "city string, state string, zip_code string")
        dim = build_dim_location(df)
        got = [tuple(r) for r in dim.orderBy("location_id").collect()]
    assert dim.columns == ["location_id", "city", "state", "zip_code"]
    assert got == [(1, "a", "s0", "5"), (2, "a", "s1", "9"), (3, "b", "s1", "1")]


def test_merge_adds_only_new_members_once(spark):
    dim = spark.createDataFrame([(5, "a", "s", "1")], DIM)
    staged = spark.createDataFrame(
        [(1, "a", "s", "1"), (2, "c", "s", "3"), (1, "b", "s", "2"), (2, "c", "s", "3")], DIM
    )
    merged = sorted(map(tuple, merge_dim_location(dim, staged).collect()))
    assert merged == [(5, "a", "s", "1"), (6, "b", "s", "2"), (7, "c", "s", "3")]
    again = spark.createDataFrame(merged, DIM)
    assert sorted(map(tuple, merge_dim_location(again, staged).collect())) == merged


def test_dim_property_type(spark):
    rows = [tuple(r) for r in dim_property_type(spark).orderBy("property_type_id").collect()]
    assert rows[0] == (1, "studio") and rows[5] == (6, "unknown") and len(rows) == 6
