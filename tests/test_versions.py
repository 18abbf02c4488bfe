import datetime

import pytest

from parcelstar.schemas import struct
from parcelstar.sources.generations import PART, Generations
from parcelstar.sources.paths import partition_values
from parcelstar.sources.versions import VersionedTable
from pyspark.sql.types import LongType, StringType, StructType

SCHEMA = struct(id=LongType(), a=StringType(), b=StringType())


def day(text):
    return text and datetime.date.fromisoformat(text)


def table(spark, tmp_path, parts=4):
    return VersionedTable(spark, str(tmp_path / "t"), SCHEMA, ["id"], parts)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def history(versions):
    return sorted((tuple(r) for r in versions.history().collect()), key=repr)


def expected(*rows):
    return sorted(((*r[:3], day(r[3]), day(r[4])) for r in rows), key=repr)


def test_three_loads_and_one_without_changes(spark, tmp_path):
    t = table(spark, tmp_path)
    one = [(i, f"a{i}", None) for i in range(8)]
    assert t.load(frame(spark, one), "2024-01-01") == {"opened": 8, "closed": 0, "parts_rewritten": 4}
    assert t.load(frame(spark, one), "2024-01-15") == {"opened": 0, "closed": 0, "parts_rewritten": 0}
    two = [(0, "new", None), (1, None, "a1"), *one[3:], (9, "x", "y")]  # 2 is gone
    summary = t.load(frame(spark, two), "2024-02-01")
    assert (summary["opened"], summary["closed"]) == (3, 3)
    t.load(frame(spark, two + [one[2]]), "2024-03-01")
    assert history(t) == expected(
        (0, "a0", None, "2024-01-01", "2024-02-01"), (0, "new", None, "2024-02-01", None),
        (1, "a1", None, "2024-01-01", "2024-02-01"), (1, None, "a1", "2024-02-01", None),
        (2, "a2", None, "2024-01-01", "2024-02-01"), (2, "a2", None, "2024-03-01", None),
        *[(i, f"a{i}", None, "2024-01-01", None) for i in range(3, 8)], (9, "x", "y", "2024-02-01", None),
    )
    assert sorted(r.id for r in t.as_of("2024-01-31").collect()) == list(range(8))
    assert sorted(r.id for r in t.as_of("2024-02-01").collect()) == [0, 1, 3, 4, 5, 6, 7, 9]
    assert t.as_of("2023-12-31").count() == 0


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    t = table(spark, tmp_path, parts=8)
    rows = [(i, "a", "b") for i in range(100)]
    t.load(frame(spark, rows), "2024-01-01")
    assert t.load(frame(spark, [*rows[:-1], (99, "z", "b")]), "2024-02-01")["parts_rewritten"] == 1
    assert len(partition_values(spark, f"{tmp_path}/t/open/data/generation=2", PART)) == 1


def test_part_of_a_snapshot_closes_nothing_else(spark, tmp_path):
    t = table(spark, tmp_path)
    t.load(frame(spark, [(1, "a", None), (2, "b", None)]), "2024-01-01")
    t.load(frame(spark, [(2, "c", None)]), "2024-02-01", complete=False)
    assert t.open_versions().count() == 2 and t.history().count() == 3


def test_a_second_load_of_a_date_replaces_what_it_opened(spark, tmp_path):
    t = table(spark, tmp_path)
    t.load(frame(spark, [(1, "a", None), (3, "c", None)]), "2024-01-01")
    t.load(frame(spark, [(1, "b", None), (2, "x", None), (3, "c", None)]), "2024-02-01")
    t.load(frame(spark, [(1, "d", None), (3, "c", None)]), "2024-02-01")
    assert history(t) == expected(
        (1, "a", None, "2024-01-01", "2024-02-01"), (1, "d", None, "2024-02-01", None), (3, "c", None, "2024-01-01", None)
    )
    with pytest.raises(ValueError, match="later than"):
        t.load(frame(spark, [(1, "e", None)]), "2024-01-10")


def test_repeated_and_missing_keys(spark, tmp_path):
    t = table(spark, tmp_path)
    t.load(frame(spark, [(1, "a", None), (1, "b", None), (1, "b", None), (None, "x", None)]), "2024-01-01")
    assert history(t) == expected((1, "b", None, "2024-01-01", None))
    t.load(frame(spark, []), "2024-02-01")
    assert t.open_versions().count() == 0 and t.history().count() == 1
    assert t.load(frame(spark, []), "2024-03-01")["parts_rewritten"] == 0


def test_a_broken_write_is_not_seen(spark, tmp_path):
    t = table(spark, tmp_path)
    t.load(frame(spark, [(1, "a", None), (2, "b", None)]), "2024-01-01")
    before = history(t)
    # What a load leaves that dies before it commits: closed rows and new partitions.
    frame(spark, [(7, "q", None)]).write.parquet(f"{tmp_path}/t/closed/generation=2")
    frame(spark, [(7, "q", None)]).write.parquet(f"{tmp_path}/t/open/data/generation=2/{PART}=0")
    assert history(t) == before
    t.load(frame(spark, [(1, "z", None), (2, "b", None)]), "2024-02-01")
    assert [r[0] for r in history(t)] == [1, 1, 2]


def test_an_emptied_partition_stays_empty(spark, tmp_path):
    kind = StructType(SCHEMA.fields[:1])
    g = Generations(spark, str(tmp_path / "g"), kind)
    assert g.read().count() == 0 and g.number() == 0
    rows = spark.createDataFrame([(1, "x"), (2, "y")], f"id long, {PART} string")
    g.replace(rows, {"x", "y"})
    g.replace(rows.limit(0), {"x"})
    assert [r.id for r in g.read().collect()] == [2]
    assert [r.id for r in g.read({"x"}).collect()] == []
    assert g.holders() == {"y": 1}


def test_a_load_moves_each_row_once_and_joins_nothing(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    one = [(i, f"a{i}", None) for i in range(40)]
    t.load(frame(spark, one), "2024-01-01")

    def joined(*_, **__):
        raise AssertionError("a load joined its rows")

    monkeypatch.setattr(type(frame(spark, one)), "join", joined)
    two = [(0, None, None), *one[2:], (77, "x", None)]
    figures = t.load(frame(spark, two), "2024-02-01")
    assert (figures["opened"], figures["closed"]) == (2, 2)
    gone = [(0, "a0", None, "2024-01-01", "2024-02-01"), (1, "a1", None, "2024-01-01", "2024-02-01")]
    stays = [(i, f"a{i}", None, "2024-01-01", None) for i in range(2, 40)]
    begins = [(0, None, None, "2024-02-01", None), (77, "x", None, "2024-02-01", None)]
    assert history(t) == expected(*gone, *stays, *begins)
