import json

import pytest
from pyspark.sql import functions as F

from parcelstar.constants import API_SOURCE, BULK_SOURCE
from parcelstar.operators.quality import assert_quality, quality_checks
from parcelstar.plans import load as load_plan
from parcelstar.plans import pipeline
from parcelstar.plans.analytics import Star, price_gap
from parcelstar.plans.load import load
from parcelstar.plans.transform import stage_bulk, transform_api, transform_bulk
from parcelstar.schemas import FACT_LISTINGS, FACT_MARKET_STATS, literal_frame
from parcelstar.sources import paths
from parcelstar.sources.bulk import land_bulk
from parcelstar.sources.staged import write_staged
from parcelstar.sources.warehouse import Warehouse
from tests.conftest import LISTING_ROW, NOW, bulk, listings, market, market_entry, plan
from tests.test_sources import write_csv

DATE = "2024-06-01"


def stage(spark, root, tag="1", date=DATE):
    """Two places known to both feeds, under different staged ids, and one per feed."""
    b = bulk(spark, {"city": "Boerne"}, {}, {}, {"city": "Dallas", "zip_code": 75201.0})
    a = listings(
        spark, {"id": "1"}, {"id": "2", "price": None},
        {"id": "3", "city": "Waco", "zipCode": "76701"}, {"id": "4", "city": None},
    )
    m = market(spark, {"97401": {"2025-01": market_entry(), "2025-02": market_entry()},
                       "00000": {"2025-01": market_entry()}})
    write_staged(transform_bulk(b, f"bulk-{tag}", NOW), root, BULK_SOURCE, date)
    write_staged(transform_api(a, m, f"api-{tag}", NOW), root, API_SOURCE, date)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("load")
    staging, root = str(folder / "staging"), str(folder / "warehouse")
    stage(spark, staging)
    first = load(spark, staging, root, DATE)
    again = load(spark, staging, root, DATE)
    stage(spark, staging, "2", "2024-06-08")
    third = load(spark, staging, root, "2024-06-08")
    return Warehouse(spark, root), [first, again, third]


def test_rows_loaded(loaded):
    _, runs = loaded
    first = {"dim_location": 4, "fact_listings_kaggle": 4, "fact_listings_rentcast": 3,
             "fact_market_stats": 2}
    assert runs[0]["rows_loaded"] == first
    assert set(runs[1]["rows_loaded"].values()) == {0}
    assert runs[2]["rows_loaded"] == first | {"dim_location": 0}


def test_facts_point_at_the_right_place(loaded):
    warehouse, _ = loaded
    fact = warehouse.table("fact_listings").join(warehouse.table("dim_location"), "location_id")
    places = fact.groupBy("source", "city").count().collect()
    assert sorted(map(tuple, places)) == [
        ("kaggle", "boerne", 2), ("kaggle", "dallas", 2), ("kaggle", "eugene", 4),
        ("rentcast", "eugene", 4), ("rentcast", "waco", 2),
    ]


def test_generated_ids_are_unique(loaded):
    warehouse, _ = loaded
    for table, key in (("fact_listings", "listing_id"), ("fact_market_stats", "stat_id"),
                       ("pipeline_metadata", "load_id"), ("data_quality_log", "check_id"),
                       ("dim_location", "location_id")):
        ids = [r[0] for r in warehouse.table(table).select(key).collect()]
        assert len(ids) == len(set(ids)) and None not in ids


def test_audit(loaded):
    warehouse, runs = loaded
    audit = warehouse.table("pipeline_metadata")
    rows = audit.where(audit.batch_id == runs[0]["batch_id"]).collect()
    assert {(r.source, r.table_name, r.row_count, r.status, r.fact_batch_id, r.dropped_rows)
            for r in rows} == {
        ("all", "dim_location", 4, "SUCCESS", None, None),
        ("kaggle", "fact_listings", 4, "SUCCESS", "bulk-1", 0),
        ("rentcast", "fact_listings", 3, "SUCCESS", "api-1", 1),
        ("rentcast", "fact_market_stats", 2, "SUCCESS", "api-1", 1),
    }
    assert all(r.load_started_at <= r.load_ended_at for r in rows)
    assert warehouse.table("pipeline_metadata").count() == 12


def test_quality_log_and_gate(loaded):
    warehouse, runs = loaded
    checks = {c["name"]: c for c in runs[0]["quality_checks_result"]}
    assert checks["null_price_fact_listings"] == {
        "name": "null_price_fact_listings", "value": 1, "passed": False,
    }
    assert sum(c["passed"] for c in checks.values()) == 3 and len(checks) == 4
    # The checks cover the whole tables, so the second batch adds to the count.
    assert {c["name"]: c["value"] for c in runs[2]["quality_checks_result"]}[
        "null_price_fact_listings"] == 2
    assert warehouse.table("data_quality_log").count() == 12
    with pytest.raises(ValueError, match="null_price_fact_listings"):
        pipeline.gate(runs[0])


def test_queries_over_a_loaded_warehouse(loaded):
    star = Star.of(loaded[0])
    gap = price_gap(star).collect()
    assert [(r.zip_code, r.state, r.avg_kaggle_price, r.price_gap) for r in gap] == [
        ("97401", "oregon", 412_500.0, 50_000.0)
    ]
    pruned = plan(star.fact_listings.where("source = 'kaggle'"))
    assert "PartitionFilters: [isnotnull(source" in pruned


def test_unscoped_load_repeats_facts(spark, tmp_path):
    stage(spark, str(tmp_path / "s"))
    summary = load(spark, str(tmp_path / "s"), str(tmp_path / "w"), DATE, scope_by_source=False)
    # Bulk ids 1..3 and API ids 1..2 meet in one list, so every shared id matches twice.
    assert summary["rows_loaded"]["fact_listings_kaggle"] == 6
    assert summary["rows_loaded"]["fact_listings_rentcast"] == 6


def test_an_unfinished_batch_is_loaded_whole(spark, tmp_path):
    """A batch folder without a SUCCESS row is what a failed load left behind."""
    staging, root = str(tmp_path / "s"), str(tmp_path / "w")
    stage(spark, staging)
    warehouse = Warehouse(spark, root)
    leftover = spark.createDataFrame(
        [(1, "kaggle", "bulk-1"), (1, "kaggle", "bulk-0")], "listing_id long, source string, batch_id string"
    )
    warehouse.append("fact_listings", leftover)
    (tmp_path / "w" / "fact_listings" / "source=rentcast" / "batch_id=api-1").mkdir(parents=True)
    assert load(spark, staging, root, DATE)["rows_loaded"]["fact_listings_kaggle"] == 4
    counts = {r.batch_id: r["count"] for r in warehouse.table("fact_listings").groupBy("batch_id").count().collect()}
    assert counts == {"bulk-1": 4, "api-1": 3, "bulk-0": 1}  # another batch's folder stays
    assert set(load(spark, staging, root, DATE)["rows_loaded"].values()) == {0}


def test_rows_the_bridge_lacks_are_counted(spark, tmp_path):
    staging, root = str(tmp_path / "s"), str(tmp_path / "w")
    stage(spark, staging)
    path = paths.staged(staging, BULK_SOURCE, DATE, "fact_listings")
    rows = spark.read.parquet(path)
    strange = rows.limit(1).withColumn("location_id", F.lit(99).cast(rows.schema["location_id"].dataType))
    missing = strange.withColumn("location_id", F.lit(None).cast(rows.schema["location_id"].dataType))
    both = spark.createDataFrame(rows.union(strange).union(missing).collect(), rows.schema)
    both.write.mode("overwrite").parquet(path)
    load(spark, staging, root, DATE)
    audit = Warehouse(spark, root).table("pipeline_metadata")
    row = audit.where("table_name = 'fact_listings' AND source = 'kaggle'").first()
    assert (row.row_count, row.dropped_rows) == (4, 2)
    ids = [r.listing_id for r in Warehouse(spark, root).table("fact_listings").collect()]
    assert len(set(ids)) == 7 and min(ids) > 0  # unique; there are gaps between tasks


def test_failure_is_recorded_and_ids_go_on(spark, tmp_path, monkeypatch):
    staging, root = str(tmp_path / "s"), str(tmp_path / "w")
    stage(spark, staging)
    with monkeypatch.context() as patch:
        patch.setattr(load_plan, "append_metadata", failing_once(load_plan.append_metadata))
        with pytest.raises(RuntimeError, match="lost"):
            load(spark, staging, root, DATE)
    warehouse = Warehouse(spark, root)
    failed = warehouse.table("pipeline_metadata").collect()
    assert [(r.source, r.table_name, r.row_count, r.status) for r in failed] == [
        ("all", "pipeline", 0, "FAILED")
    ]
    # The facts are there without an audit row; their ids must not be given again.
    stage(spark, staging, "2", "2024-06-08")
    load(spark, staging, root, "2024-06-08")
    ids = [r[0] for r in warehouse.table("fact_listings").select("listing_id").collect()]
    assert len(ids) == len(set(ids)) == 14


def failing_once(function):
    calls = []

    def wrapper(*args, **kwargs):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return function(*args, **kwargs)

    return wrapper


def test_nothing_staged(spark, tmp_path):
    summary = load(spark, str(tmp_path / "s"), str(tmp_path / "w"))
    assert set(summary["rows_loaded"].values()) == {0}
    assert all(c["passed"] for c in summary["quality_checks_result"])


def test_quality_checks_find_every_defect(spark):
    dim = spark.createDataFrame(
        [(1, "a", "oregon", "1"), (2, "a", "oregon", "1"), (3, None, "oregon", "2"),
         (4, "b", "tx", "3")],
        "location_id long, city string, state string, zip_code string",
    )
    types = spark.createDataFrame([(1, "studio")], "property_type_id long, property_type string")
    row = dict.fromkeys(FACT_LISTINGS.names)
    rows = [
        row | {"location_id": 1, "property_type_id": 1, "price": 5.0, "batch_id": "x"},
        row | {"location_id": 9, "property_type_id": 1, "batch_id": "x"},
        row | {"location_id": None, "property_type_id": 7, "price": 5.0, "address": "y" * 201,
               "batch_id": "z"},
    ]
    fact = literal_frame(spark, [tuple(r.values()) for r in rows], FACT_LISTINGS)
    stats = literal_frame(
        spark, [tuple({n: {"location_id": 8}.get(n) for n in FACT_MARKET_STATS.names}.values())],
        FACT_MARKET_STATS,
    )
    checks = quality_checks(fact, stats, dim, types, extended=True)
    assert {r.name: r.value for r in checks.collect()} == {
        "null_price_fact_listings": 1,
        "orphan_fk_location_fact_listings": 2,
        "orphan_fk_property_type_fact_listings": 1,
        "text_too_long_fact_listings": 1,
        "orphan_fk_location_fact_market_stats": 1,
        "null_location_fields_dim_location": 1,
        "state_code_dim_location": 1,
        "duplicate_natural_key_dim_location": 1,
    }
    with pytest.raises(ValueError, match="8 quality check"):
        assert_quality(checks)
    scoped = quality_checks(fact, stats, dim, batch_id="z")
    assert {r.name: r.value for r in scoped.collect()}["orphan_fk_location_fact_listings"] == 1


def test_pipeline_end_to_end(spark, tmp_path):
    csv = write_csv(tmp_path / "in", "a.csv", ["Oregon", "Utah"])
    pages = tmp_path / "pages.json"
    page = {"state": "Oregon", "offset": 0, "total_count": 1, "records": [LISTING_ROW]}
    pages.write_text(json.dumps(page))
    zones = [str(tmp_path / z) for z in ("raw", "staging", "warehouse")]
    first = pipeline.run_pipeline(spark, csv, str(pages), *zones, DATE)
    assert first["rows_loaded"] == {
        "dim_location": 3, "fact_listings_kaggle": 2, "fact_listings_rentcast": 1,
        "fact_market_stats": 0,
    }
    again = pipeline.run_pipeline(spark, csv, str(pages), *zones, DATE)
    assert set(again["rows_loaded"].values()) == {0}


def test_steps_default_to_today(spark, tmp_path):
    csv = write_csv(tmp_path / "in", "a.csv", ["Oregon"])
    raw, staging, root = (str(tmp_path / z) for z in ("raw", "staging", "warehouse"))
    landed = land_bulk(spark, csv, raw)
    staged = stage_bulk(spark, raw, staging)
    assert staged["fact_listings_rows"] == staged["dim_location_rows"] == 1
    assert load(spark, staging, root)["execution_date"] == landed["execution_date"]
    assert Warehouse(spark, root).table("fact_listings").first().batch_id == staged["batch_id"]


def whole(warehouse, extended=True):
    tables = [warehouse.table(n) for n in ("fact_listings", "fact_market_stats", "dim_location", "dim_property_type")]
    return sorted(map(tuple, quality_checks(*tables, extended=extended).collect()))


def test_partial_checks_add_up_to_the_whole_table(spark, loaded, tmp_path):
    warehouse, _ = loaded
    assert sorted(map(tuple, load_plan.checked_quality(warehouse, extended=True).collect())) == whole(warehouse)
    # Facts no load has finished, with orphans, some of which a later location takes in.
    other = Warehouse(spark, str(tmp_path / "w"))
    stage(spark, str(tmp_path / "s"))
    load(spark, str(tmp_path / "s"), other.root, DATE)
    facts = other.table("fact_listings")
    for number, batch in ((2, "lost"), (5, "later"), (None, "none")):
        strange = facts.limit(2).withColumn("location_id", F.lit(number).cast("long") * 3).withColumn("batch_id", F.lit(batch))
        other.append("fact_listings", strange.withColumn("price", F.lit(None).cast("double")))
    assert sorted(map(tuple, load_plan.checked_quality(other, True).collect())) == whole(other)
    load_plan.append_metadata(other, "x", load_plan.utc_now(), [
        {"source": "all", "table_name": "fact_listings", "row_count": 2, "fact_batch_id": b} for b in ("lost", "later", "none")
    ])
    assert sorted(map(tuple, load_plan.checked_quality(other, True).collect())) == whole(other)
    more = spark.createDataFrame([(i, f"c{i}", "tx" if i == 15 else "texas", None if i == 14 else "1") for i in range(5, 16)],
                                 "location_id long, city string, state string, zip_code string")
    other.append("dim_location", more)
    before = whole(other)
    assert sorted(map(tuple, load_plan.checked_quality(other, True).collect())) == before
    assert sorted(map(tuple, load_plan.checked_quality(other, True).collect())) == before


def test_a_load_reads_only_its_own_batch_for_the_checks(spark, loaded, monkeypatch):
    warehouse, _ = loaded
    seen = []
    real = load_plan.partial_checks

    def watched(name, fact, *rest):
        seen.append((name, sorted(r[0] for r in fact.select("batch_id").distinct().collect()), plan(fact)))
        return real(name, fact, *rest)

    monkeypatch.setattr(load_plan, "partial_checks", watched)
    load_plan.checked_quality(warehouse)
    assert seen == []  # all batches are covered
    load_plan.append_metadata(warehouse, "y", load_plan.utc_now(), [
        {"source": "all", "table_name": "fact_listings", "row_count": 1, "fact_batch_id": "fresh"}
    ])
    fresh = warehouse.table("fact_listings").limit(1).withColumn("batch_id", F.lit("fresh")).collect()
    warehouse.append("fact_listings", spark.createDataFrame(fresh, warehouse.table("fact_listings").schema))
    load_plan.checked_quality(warehouse)
    assert [(n, b) for n, b, _ in seen] == [("fact_listings", ["fresh"])]
    assert "PartitionFilters: [" in seen[0][2] and "fresh" in seen[0][2]


def test_ids_are_unique_over_a_retry(spark, tmp_path):
    """A load that breaks off after its first fact, and the one that makes up for it."""
    staging, root = str(tmp_path / "s"), str(tmp_path / "w")
    stage(spark, staging)
    path = paths.staged(staging, API_SOURCE, DATE, "fact_market_stats")
    good = spark.read.parquet(path).collect(), spark.read.parquet(path).schema
    spark.createDataFrame(*good).withColumn("snapshot_date", F.lit("no date")).write.mode("overwrite").parquet(path)
    with pytest.raises(Exception):
        load(spark, staging, root, DATE)
    spark.createDataFrame(*good).write.mode("overwrite").parquet(path)
    load(spark, staging, root, DATE)
    stage(spark, staging, "2", "2024-06-08")
    load(spark, staging, root, "2024-06-08")
    ids = [r[0] for r in Warehouse(spark, root).table("fact_listings").select("listing_id").collect()]
    assert len(ids) == len(set(ids)) == 14 and None not in ids and min(ids) > 0
