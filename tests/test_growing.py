"""Profiles by batch and the latest snapshots by stream."""

import datetime
import itertools
import time

import pytest

from parcelstar.operators.profiling import profile
from parcelstar.sources.profiles import Profiles
from parcelstar.streaming.latest import (
    SNAPSHOT,
    LatestSnapshots,
    keep_latest,
    start_latest,
    stream_snapshots,
)

ROWS = "n long, x double, s string, d date, nothing string, void double"


def rows_of(spark, numbers):
    day = datetime.date(2024, 1, 1)
    rows = [(n, None if n % 10 == 0 else n / 7, f"s{n % 50}", day + datetime.timedelta(n % 90), None, None) for n in numbers]
    return spark.createDataFrame(rows, ROWS)


def test_merged_profiles_are_close_to_the_whole_table(spark, tmp_path):
    store = Profiles(spark, str(tmp_path))
    batches = [range(0, 4000), range(4000, 4010), range(3000, 9000)]
    for i, numbers in enumerate(batches):
        store.add(f"b{i}", rows_of(spark, numbers))
    every = [n for b in batches for n in b]
    exact = {r.column_name: r for r in profile(rows_of(spark, every)).collect()}
    at = (0.1, 0.5, 0.9)
    for r in store.profile(at).collect():
        e = exact[r.column_name]
        assert (r.column_type, r.row_count, r.null_count) == (e.column_type, e.row_count, e.null_count)
        if r.column_name in ("s", "d"):
            assert (r.min_value, r.max_value) == (e.min_value, e.max_value)
        if r.column_name in ("nothing", "void"):
            assert (r.approx_distinct, r.min_value, r.quantiles) == (0, None, None)
    found = {r.column_name: r for r in store.profile(at).collect()}
    assert found["n"].approx_distinct == pytest.approx(9000, rel=0.05)
    assert found["s"].approx_distinct == pytest.approx(50, rel=0.05)
    assert (float(found["n"].min_value), float(found["n"].max_value)) == (0, 8999)
    for column, values in (("n", every), ("x", [n / 7 for n in every if n % 10])):
        for rank, q in zip(at, found[column].quantiles):
            assert sum(v <= q for v in values) / len(values) == pytest.approx(rank, abs=0.02)


def test_a_batch_replaces_itself_and_broken_ones_do_not_count(spark, tmp_path):
    store = Profiles(spark, str(tmp_path))
    assert store.profile().count() == 0
    for _ in range(2):
        store.add("a", rows_of(spark, range(10)))
    store.add("b", rows_of(spark, range(10, 30)).limit(0))
    assert {r.row_count for r in store.profile().collect()} == {10}
    (tmp_path / "batch=a" / "_SUCCESS").unlink()
    assert {r.row_count for r in store.profile().collect()} == {0}


def snapshot(zip_code, day, ingested=1, stat=1, location=1, price=1.0):
    values = {
        "zip_code": zip_code, "state": "s", "city": f"c{location}", "stat_id": stat, "location_id": location,
        "snapshot_date": day and datetime.date(2025, 1, day), "median_listing_price": price,
        "ingested_at": ingested and datetime.datetime(2025, 2, ingested),
    }
    return tuple(values.get(f.name) for f in SNAPSHOT)


def prices(latest):
    return {r.zip_code: r.median_listing_price for r in latest.read().collect()}


FILES = [
    [snapshot("a", 5, price=1.0), snapshot("b", None, price=2.0), snapshot("c", 1, 1, 1, 1, 3.0), snapshot(None, 9)],
    [snapshot("a", 4, price=4.0), snapshot("b", 1, price=5.0), snapshot("c", 1, 1, 1, 2, 6.0), snapshot("d", 2, None, price=7.0)],
    [snapshot("a", 6, price=8.0), snapshot("c", 1, 1, 2, 1, 9.0), snapshot("d", 2, 1, price=10.0), snapshot("d", 2, 1, price=10.0)],
]
LAST = {"a": 8.0, "b": 5.0, "c": 9.0, "d": 10.0}


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_three_batches_with_restarts_in_any_order(spark, tmp_path, order):
    drop, latest = str(tmp_path / "drop"), LatestSnapshots(spark, str(tmp_path / "latest"), parts=4)
    for i in order:
        spark.createDataFrame(FILES[i], SNAPSHOT).coalesce(1).write.mode("append").parquet(drop)
        keep_latest(stream_snapshots(spark, drop), latest, str(tmp_path / "checkpoint"))
    assert prices(latest) == LAST
    before = latest._table.number()
    keep_latest(stream_snapshots(spark, drop), latest, str(tmp_path / "checkpoint"))
    assert prices(latest) == LAST and latest._table.number() == before


def test_merging_is_the_same_in_any_order_and_again(spark, tmp_path):
    for n, order in enumerate(itertools.permutations(range(3))):
        latest = LatestSnapshots(spark, str(tmp_path / f"l{n}"), parts=2)
        for i in (*order, order[0]):
            latest.merge(spark.createDataFrame(FILES[i][:3], SNAPSHOT))
        assert prices(latest) == LAST


def test_a_late_row_after_its_state_expired_does_not_win(spark, tmp_path):
    drop, latest = str(tmp_path / "drop"), LatestSnapshots(spark, str(tmp_path / "latest"), parts=2)
    spark.createDataFrame([snapshot("a", 5, price=1.0)], SNAPSHOT).write.parquet(drop)
    query = start_latest(stream_snapshots(spark, drop), latest, str(tmp_path / "c"), expire_ms=500, every="200 milliseconds")
    try:
        for extra in ([snapshot("a", 4, price=2.0)], [snapshot("b", 4, price=3.0)]):
            deadline = time.time() + 40
            while time.time() < deadline and not prices(latest):
                time.sleep(0.5)
            time.sleep(3)  # the state of the zip code goes
            spark.createDataFrame(extra, SNAPSHOT).write.mode("append").parquet(drop)
        deadline = time.time() + 40
        while time.time() < deadline and len(prices(latest)) < 2:
            time.sleep(0.5)
    finally:
        query.stop()
    assert prices(latest) == {"a": 1.0, "b": 3.0}
