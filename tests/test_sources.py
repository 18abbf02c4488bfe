import json
from datetime import date

import pyarrow
import pyarrow.parquet
import pytest
from pyspark.sql import functions as F

from parcelstar.operators.ordering import pages
from parcelstar.operators.reconciliation import landing_totals, reconcile_pages
from parcelstar.schemas import MARKET, PAGE, STAGED_API_FACT, STAGED_BULK_FACT
from parcelstar.sources import api, bulk as bulk_source, paths
from parcelstar.sources.staged import read_staged, write_staged
from parcelstar.streaming.landing import (
    land_new_files,
    land_new_pages,
    stream_bulk_csv,
    stream_pages,
)
from tests.conftest import BATCH, BULK_ROW, LISTING_ROW, NOW, bulk, settings

DATE = "2024-06-01"
STATES = ["California", "Oregon", "California", None, "New York"]


def write_csv(folder, name, states):
    folder.mkdir(exist_ok=True)
    lines = [",".join(BULK_ROW)]
    for state in states:
        row = BULK_ROW | {"state": state, "city": " Padded "}
        lines.append(",".join("" if v is None else str(v) for v in row.values()))
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder / name)


def page(state, offset, n, total=None):
    rows = [tuple((LISTING_ROW | {"id": f"{state}{offset + i}"}).values()) for i in range(n)]
    return (state, offset, total, rows)


def page_frame(spark, *given):
    return spark.createDataFrame(list(given), PAGE)


def test_read_csv(spark, tmp_path):
    path = write_csv(tmp_path / "in", "a.csv", STATES)
    rows = bulk_source.read_bulk_csv(spark, path).collect()
    assert len(rows) == 5 and rows[0].city == " Padded " and rows[0].zip_code == 97401.0
    assert bulk_source.read_bulk_csv(spark, path, limit=2).count() == 2


def test_csv_with_bad_number_or_header_is_refused(spark, tmp_path):
    path = write_csv(tmp_path / "in", "a.csv", ["Oregon"])
    bad = tmp_path / "bad.csv"
    bad.write_text(open(path).read().replace("412500.0", "dear"))
    with pytest.raises(Exception):
        bulk_source.read_bulk_csv(spark, str(bad)).collect()
    loose = bulk_source.read_bulk_csv(spark, str(bad), mode="PERMISSIVE").first()
    assert loose.price is None
    bad.write_text(open(path).read().replace("price", "cost"))
    with pytest.raises(Exception):
        bulk_source.read_bulk_csv(spark, str(bad)).collect()


def test_land_bulk_by_state_and_skip(spark, tmp_path):
    path, raw = write_csv(tmp_path / "in", "a.csv", STATES), str(tmp_path / "raw")
    first = bulk_source.land_bulk(spark, path, raw, DATE, BATCH, NOW)
    assert (first["status"], first["records_count"], first["chunks_written"]) == ("success", 5, 4)
    folder = paths.raw_bulk(raw, DATE)
    assert sorted(paths.partition_values(spark, f"{folder}/drop=*", "state_part")) == [
        "California", "New York", "Oregon", "__HIVE_DEFAULT_PARTITION__",
    ]
    again = bulk_source.land_bulk(spark, path, raw, DATE, "other", NOW)
    assert again["status"] == "skipped"
    rows = bulk_source.read_raw_bulk(spark, folder).collect()
    assert {r.batch_id for r in rows} == {BATCH} and {r.source for r in rows} == {"kaggle"}
    assert sorted(str(r.state) for r in rows) == sorted(map(str, STATES))


def test_unfinished_landing_is_done_again(spark, tmp_path):
    path, raw = write_csv(tmp_path / "in", "a.csv", STATES), str(tmp_path / "raw")
    bulk_source.land_bulk(spark, path, raw, DATE, BATCH, NOW)
    date_folder = tmp_path / "raw" / "kaggle" / f"execution_date={DATE}"
    (date_folder / "drop=whole" / "_SUCCESS").unlink()
    assert bulk_source.land_bulk(spark, path, raw, DATE, "b2", NOW)["records_count"] == 5


def test_a_large_state_is_split_over_files(spark, tmp_path):
    texans = bulk(spark).drop("street")
    big = spark.range(60_000).crossJoin(texans).withColumnRenamed("id", "street")
    with settings(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1k",
    ):
        bulk_source.write_by_state(big.repartition(8), str(tmp_path / "out"))
    files = list((tmp_path / "out" / "state_part=Oregon").glob("*.parquet"))
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60_000


def test_land_api_pages(spark, tmp_path):
    raw = str(tmp_path / "raw")
    given = [page("Oregon", 0, 3, 4), page("Oregon", 500, 1, 4), page("New York", 0, 2, 2)]
    first = api.land_api_pages(page_frame(spark, *given), raw, DATE, BATCH, NOW)
    assert (first["states_processed"], first["records_count"]) == (2, 6)
    second = api.land_api_pages(
        page_frame(spark, *given, page("Utah", 0, 1)), raw, DATE, "b2", NOW
    )
    assert (second["states_processed"], second["records_count"]) == (1, 1)
    third = api.land_api_pages(page_frame(spark, *given), raw, DATE, "b3", NOW)
    assert (third["states_processed"], third["records_count"]) == (0, 0)
    landed = api.read_envelopes(spark, first["path"])
    assert all(r.record_count == len(r.records) for r in landed.collect())
    assert api.read_api_listings(spark, first["path"]).count() == 7
    totals = landing_totals(landed).first()
    assert (totals.states_processed, totals.records_count) == (3, 7)


def test_unknown_state_is_refused(spark, tmp_path):
    mixed = page_frame(spark, page("Oregon", 0, 1), page("OR", 0, 1))
    with pytest.raises(Exception, match="unknown state name: OR"):
        api.land_api_pages(mixed, str(tmp_path), DATE, BATCH, NOW)
    folder = paths.raw_api_listings(str(tmp_path), DATE)
    assert paths.partition_values(spark, f"{folder}/drop=*", "state_part") == []


def test_requested_states(spark, tmp_path):
    raw = str(tmp_path / "raw")
    given = page_frame(spark, page("Oregon", 0, 3), page("Utah", 0, 1), page("Ohio", 0, 2))
    first = api.land_api_pages(given, raw, DATE, BATCH, NOW, states=["Utah"])
    assert (first["states_skipped"], first["states_absent"], first["records_count"]) == ([], [], 1)
    second = api.land_api_pages(given, raw, DATE, BATCH, NOW, states=["Utah", "Ohio", "Maine"])
    assert (second["states_skipped"], second["states_absent"]) == (["Utah"], ["Maine"])
    assert api.read_api_listings(spark, first["path"]).count() == 3
    with pytest.raises(ValueError, match="no states"):
        api.land_api_pages(given, raw, DATE, BATCH, NOW, states=[])


def test_pages_without_a_state_land_once(spark, tmp_path):
    given = [page("Oregon", 0, 1), page(None, 0, 2)]
    frame = page_frame(spark, *given)
    for rows in (page_frame(spark, given[0]), frame, frame):
        landed = api.land_api_pages(rows, str(tmp_path), DATE, BATCH, NOW, known_states=False)
    assert api.read_api_listings(spark, landed["path"]).count() == 3


def test_batch_and_stream_landings_stand_side_by_side(spark, tmp_path):
    csv, raw = write_csv(tmp_path / "in", "a.csv", STATES), str(tmp_path / "raw")
    drops = [tmp_path / "one", tmp_path / "two"]
    for drop in drops:
        write_csv(drop, "b.csv", ["Utah", None, "Oregon"])

    def stream(drop):
        files = stream_bulk_csv(spark, str(drop))
        land_new_files(files, raw, DATE, str(tmp_path / f"cp-{drop.name}"), BATCH, NOW)

    def count():
        return bulk_source.read_raw_bulk(spark, paths.raw_bulk(raw, DATE)).count()

    stream(drops[0])
    assert count() == 3
    for _ in range(2):
        bulk_source.land_bulk(spark, csv, raw, DATE, BATCH, NOW)
        assert count() == 8
    stream(drops[1])
    stream(drops[0])
    assert count() == 11


def test_pages_of_batch_and_stream(spark, tmp_path):
    drop, raw = tmp_path / "drop", str(tmp_path / "raw")
    drop.mkdir()
    lines = [{"state": s, "offset": 0, "records": [LISTING_ROW]} for s in ("Oregon", "Utah")]
    (drop / "a.json").write_text("\n".join(map(json.dumps, lines)))
    land_new_pages(stream_pages(spark, str(drop)), raw, DATE, str(tmp_path / "cp"), BATCH, NOW)
    given = page_frame(spark, page("Oregon", 0, 3), page("Ohio", 0, 2))
    landed = api.land_api_pages(given, raw, DATE, "b2", NOW)
    assert (landed["states_processed"], landed["records_count"]) == (1, 2)
    assert api.read_api_listings(spark, landed["path"]).count() == 4


def test_envelope_files_of_one_line_or_many(spark, tmp_path):
    envelope = {"batch_id": BATCH, "state": "Oregon", "record_count": 2,
                "records": [LISTING_ROW, {"id": "only"}]}
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "Oregon.json").write_text(json.dumps(envelope))
    (tmp_path / "many").mkdir()
    (tmp_path / "many" / "Oregon.json").write_text(json.dumps(envelope, indent=2))
    for folder, multi in (("one", False), ("many", True)):
        rows = api.read_api_listings(spark, str(tmp_path / folder), multi).collect()
        assert rows[0].daysOnMarket == 21 and rows[1].price is None


def test_market_is_optional(spark, tmp_path):
    none = api.read_market(spark, str(tmp_path / "absent"))
    assert none.count() == 0 and none.schema == MARKET
    entry = {"medianPrice": 1, "totalListings": 3, "averagePrice": 9}
    (tmp_path / "m.json").write_text(
        json.dumps({"id": "x", "zipCode": "97401", "saleData": {"history": {"2025-01": entry}}})
    )
    row = api.read_market(spark, str(tmp_path / "m.json")).first()
    assert row.saleData.history["2025-01"].totalListings == 3
    assert row.saleData.history["2025-01"].date is None


def test_staged_round_trip(spark, tmp_path):
    path = paths.staged(str(tmp_path), "kaggle", DATE, "fact_listings")
    assert read_staged(spark, path, STAGED_BULK_FACT).count() == 0
    frame = spark.createDataFrame([(1, NOW), (2, NOW)], "Location_ID int, ingested_at string")
    for _ in range(2):
        counts = write_staged({"fact_listings": frame}, str(tmp_path), "kaggle", DATE)
    assert counts == {"fact_listings": 2}
    back = read_staged(spark, path, STAGED_BULK_FACT)
    assert back.schema == STAGED_BULK_FACT and back.count() == 2


def test_reconcile_pages(spark):
    landed = spark.createDataFrame(
        [("full", 0, 500, 700), ("full", 500, 200, 700),
         ("gap", 0, 500, 2100), ("gap", 1500, 500, 2100), ("gap", 2000, 100, 2100),
         ("twice", 0, 100, 100), ("twice", 0, 100, 100),
         ("cut", 0, 500, 900), ("late", 500, 10, 510), ("blind", 0, 20, None)],
        "state string, offset long, record_count long, total_count long",
    )
    rows = {r.state: r for r in reconcile_pages(landed).collect()}
    assert (rows["full"].pages, rows["full"].records, rows["full"].complete) == (2, 700, True)
    assert (rows["gap"].missing_pages, rows["gap"].gaps, rows["gap"].complete) == (2, 1, False)
    assert (rows["twice"].pages, rows["twice"].complete) == (1, True)
    assert (rows["cut"].missing_pages, rows["cut"].ended_short, rows["cut"].complete) == (
        0, False, False,
    )
    assert (rows["late"].missing_pages, rows["late"].gaps) == (1, 1)
    assert rows["blind"].complete and rows["blind"].expected_total is None


def test_stream_lands_each_file_once(spark, tmp_path):
    drop, raw, checkpoint = tmp_path / "drop", str(tmp_path / "raw"), str(tmp_path / "cp")

    def run():
        stream = stream_bulk_csv(spark, str(drop), max_files=1)
        land_new_files(stream, raw, DATE, checkpoint, BATCH, NOW)
        return bulk_source.read_raw_bulk(spark, paths.raw_bulk(raw, DATE)).count()

    write_csv(drop, "a.csv", STATES)
    assert [run(), run()] == [5, 5]
    write_csv(drop, "b.csv", ["Utah", "Oregon", "Utah"])
    assert run() == 8
    landed = bulk_source.read_raw_bulk(spark, paths.raw_bulk(raw, DATE))
    assert landed.where(F.col("state") == "Oregon").count() == 2


def test_stream_lands_each_page_once(spark, tmp_path):
    drop, raw, checkpoint = tmp_path / "drop", str(tmp_path / "raw"), str(tmp_path / "cp")
    drop.mkdir()

    def put(name, *states):
        lines = [{"state": s, "offset": 0, "records": [LISTING_ROW]} for s in states]
        (drop / name).write_text("\n".join(map(json.dumps, lines)))

    def run():
        land_new_pages(stream_pages(spark, str(drop), 1), raw, DATE, checkpoint, BATCH, NOW)
        return api.read_envelopes(spark, paths.raw_api_listings(raw, DATE)).collect()

    put("a.json", "Oregon", "Utah")
    assert [len(run()), len(run())] == [2, 2]
    put("b.json", "Ohio")
    landed = run()
    assert sorted(r.state for r in landed) == ["Ohio", "Oregon", "Utah"]
    assert {r.record_count for r in landed} == {1}


def test_staged_single_file_with_foreign_types(spark, tmp_path):
    """A staged file as another writer leaves it: one file, unsigned ids, dates as text."""
    table = pyarrow.table(
        {
            "location_id": pyarrow.array([1, None], pyarrow.uint32()),
            "property_type_id": pyarrow.array([2, 6], pyarrow.int64()),
            "RENTCAST_ID": ["a", "b"],
            "price": pyarrow.array([462_500, None], pyarrow.int64()),
            "listed_date": ["2023-11-20T00:00:00.000Z", None],
            "ingested_at": ["2025-03-09T06:30:00.123456+00:00"] * 2,
        }
    )
    path = paths.staged(str(tmp_path), "rentcast", DATE, "fact_listings")
    (tmp_path / "rentcast" / DATE).mkdir(parents=True)
    pyarrow.parquet.write_table(table, path)
    row = read_staged(spark, path, STAGED_API_FACT).where("rentcast_id = 'a'").first()
    assert (row.location_id, row.price, row.listed_date) == (1, 462_500.0, date(2023, 11, 20))
    assert row.ingested_at.microsecond == 123456 and row.address is None


def test_a_broken_landing_counts_for_nothing(spark, tmp_path):
    """A drop without _SUCCESS is neither landed nor read, and goes with the next landing."""
    raw = str(tmp_path)
    given = page_frame(spark, page("Utah", 0, 3), page("Utah", 3, 2), page("Ohio", 0, 4))
    first = api.land_api_pages(given.limit(1), raw, DATE, BATCH, NOW)
    drop = next((tmp_path / first["path"].removeprefix(raw).lstrip("/")).glob("drop=*"))
    (drop / "_SUCCESS").unlink()
    stream = drop.parent / "drop=stream-x-0" / "state_part=Iowa"
    stream.mkdir(parents=True)
    (stream / "part.json").write_text((next(drop.glob("state_part=*/*.json"))).read_text())
    assert api.read_api_listings(spark, first["path"]).count() == 0
    again = api.land_api_pages(given, raw, DATE, BATCH, NOW)
    assert (again["states_processed"], again["records_count"]) == (2, 9)
    assert not drop.exists() and stream.exists()
    assert api.read_api_listings(spark, first["path"]).count() == 9


def test_a_broken_bulk_drop_is_not_read(spark, tmp_path):
    csv, raw = write_csv(tmp_path / "csv", "a.csv", STATES), str(tmp_path / "raw")
    path = bulk_source.land_bulk(spark, csv, raw, DATE, BATCH, NOW)["path"]
    (tmp_path / "raw").joinpath(path.removeprefix(raw).lstrip("/"), "drop=whole", "_SUCCESS").unlink()
    assert bulk_source.read_raw_bulk(spark, path).count() == 0
    assert bulk_source.land_bulk(spark, csv, raw, DATE, BATCH, NOW)["status"] == "success"
    assert bulk_source.read_raw_bulk(spark, path).count() == len(STATES)


def test_gathered_pages_land_compressed_and_unmoved(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(api, "by_state", lambda _: pytest.fail("gathered pages were moved"))
    rows = spark.range(2000).selectExpr(
        "cast(id AS string) AS id", "element_at(array('Oregon', 'Utah'), cast(id % 2 + 1 AS int)) AS state", "1.5d * id AS price"
    )
    listed = api.shape_listing(rows).withColumn("_state", F.col("state"))
    paged = pages(listed, ["_state"], ["id"], 100).select(
        F.col("_state").alias("state"), "offset", F.lit(None).cast("bigint").alias("total_count"), "records"
    )
    landed = api.land_api_pages(paged, str(tmp_path), DATE, BATCH, NOW, gathered=True, compression="gzip")
    assert landed["records_count"] == 2000
    files = [f for f in (tmp_path / "rentcast").rglob("part-*") if f.is_file()]
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert sorted(r.record_count for r in api.read_envelopes(spark, landed["path"]).collect()) == [100] * 20
    back = api.read_api_listings(spark, landed["path"])
    assert sorted((int(r.id), r.state, r.price) for r in back.collect()) == [
        (i, ("Oregon", "Utah")[i % 2], 1.5 * i) for i in range(2000)
    ]
