import random

import pytest
from pyspark.sql import functions as F

from parcelstar.operators.timeline import carried, neighbours, value_at, versions
from tests.conftest import many_runs


def rows_of(n, seed=1, hot=0.4):
    rng = random.Random(seed)
    key = lambda: "hot" if rng.random() < hot else rng.choice(["a", "b", "c", None])
    return [
        (key(), rng.randint(1, n) if rng.random() > 0.05 else None, rng.choice([1.0, 2.0, None]), i) for i in range(n)
    ]


SCHEMA = "k string, t int, v double, n int"


def less(value):
    return (value is not None, value or 0)


def by_key(rows):
    out = {}
    for row in rows:
        out.setdefault(row[0], []).append(row)
    return {k: sorted(own, key=lambda r: (less(r[1]), r[3])) for k, own in out.items()}


def test_last_known_values_cross_runs(spark):
    rows = rows_of(400)
    with many_runs(spark):
        got = {r.n: r.last for r in carried(spark.createDataFrame(rows, SCHEMA), ["k"], ["t", "n"], "v", "last").collect()}
    for own in by_key(rows).values():
        last = None
        for _, _, value, n in own:
            last = value if value is not None else last
            assert got[n] == last


def test_a_key_without_values_for_whole_runs(spark):
    rows = [("x", i, 5.0 if i == 0 else None, i) for i in range(300)]
    with many_runs(spark):
        got = carried(spark.createDataFrame(rows, SCHEMA), ["k"], ["t"], "v", "last").where("last = 5.0").count()
    assert got == 300


def test_neighbours_cross_runs(spark):
    rows = rows_of(300, 2)
    with many_runs(spark):
        out = neighbours(spark.createDataFrame(rows, SCHEMA), ["k"], ["t", "n"], F.col("n"), "before", "after")
        got = {r.n: (r.before, r.after) for r in out.collect()}
    for own in by_key(rows).values():
        names = [None, *[r[3] for r in own], None]
        for i, row in enumerate(own, start=1):
            assert got[row[3]] == (names[i - 1], names[i + 1])


def test_versions_have_no_gap_and_no_overlap(spark):
    rows = rows_of(300, 3)
    with many_runs(spark):
        got = versions(spark.createDataFrame(rows, SCHEMA), ["k"], "t", ["v"]).collect()
    expected = []
    for k, own in by_key(rows).items():
        days = {}
        for _, t, v, _ in own:
            if t is not None:
                days[t] = max(days.get(t), v, key=less)
        mine = []
        for t, v in sorted(days.items()):
            if not mine or mine[-1][1] != v:
                mine.append([k, v, t, None])
        for a, b in zip(mine, mine[1:]):
            a[3] = b[2]
        expected += map(tuple, mine)
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_a_first_version_of_nulls_counts(spark):
    df = spark.createDataFrame([("a", 1, None, 0), ("a", 2, None, 1), ("a", 3, 1.0, 2)], SCHEMA)
    got = sorted((r.valid_from, r.v, r.valid_to) for r in versions(df, ["k"], "t", ["v"]).collect())
    assert got == [(1, None, 3), (3, 1.0, None)]


@pytest.mark.parametrize("hot", [0.0, 0.9])
def test_values_at_a_time(spark, hot):
    told, asked = rows_of(300, 4, hot), [(k, t, n) for k, t, _, n in rows_of(500, 5, hot)]
    with many_runs(spark):
        found = value_at(
            spark.createDataFrame(asked, "k string, at int, i int"),
            spark.createDataFrame(told, SCHEMA), ["k"], "at", "t", ["v", "n"],
        ).collect()
    assert sorted(r.i for r in found) == list(range(500))
    for r in found:
        known = [x for x in told if r.k is not None and x[0] == r.k and None not in (x[1], r.at) and x[1] <= r.at]
        best = max(known, key=lambda x: (x[1], less(x[2]), x[3]), default=(None,) * 4)
        assert (r.v, r.n) == best[2:]


def test_no_history_and_no_rows(spark):
    rows = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 1, {"x": 1})], "k string, at int, extra map<string,int>")
    none = spark.createDataFrame([], SCHEMA)
    assert [r.v for r in value_at(rows, none, ["k"], "at", "t", ["v"]).collect()] == [None, None]
    assert value_at(rows.limit(0), none, ["k"], "at", "t", ["v"]).count() == 0
    assert versions(none, ["k"], "t", ["v"]).count() == 0
