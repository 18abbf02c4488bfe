import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm import test_decontamination, test_jaccard_join, test_packing, test_quality_rules

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")


def text(value):
    return repr(value)


@pytest.mark.parametrize(
    "name",
    [
        "op1_decontamination", "op2_quality_rules", "op5_chat_format", "op11_line_dedup",
        "op12_merkle_manifest", "op13_ranked_search",
    ],
)
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    result = con.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    df = entry_points.queries()[name](spark, str(DATA))
    assert sorted(names) == sorted(df.columns)
    theirs = sorted(tuple(text(row[names.index(c)]) for c in sorted(names)) for row in result.fetchall())
    assert sorted(tuple(text(r[c]) for c in sorted(names)) for r in df.collect()) == theirs


def test_every_operator_has_a_query():
    for n in range(1, 14):
        assert len([q for q in entry_points.queries() if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in entry_points.queries()


def test_pipeline_equals_brute_force(spark):
    documents = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    rows = [(r.doc_id, r.text) for r in documents]
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r for r in rows if test_quality_rules.brute(r[1])[-1]]
    stays = {c for _, _, c in test_jaccard_join.brute(rows)}
    rows = [r for r in rows if r[0] in stays]
    bad = {r[0] for r in test_decontamination.brute(rows, items) if r[5]}
    rows = [r for r in rows if r[0] not in bad]
    out = corpus_pipeline.run(spark, str(DATA)).collect()
    sequences, tokens, _ = test_packing.check(rows, out)
    assert len(documents) > len(rows) > 100 and sequences <= -(-tokens // 4096) + 1


def test_stages_take_empty_tables_and_keep_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("node", F.lit(1)).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(DATA))
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(DATA)).count() == 0
    assert zlib.crc32(b"") == 0
