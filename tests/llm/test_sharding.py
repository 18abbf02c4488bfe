import zlib
from collections import defaultdict

from parcelstar.llm.sharding import op8_sharding, write_sharded
from tests.llm.conftest import prose


def test_shards_are_near_equal_and_slots_gapless(docs):
    rows = [(i, prose(20 + i % 300, i)) for i in range(3000)]
    rows += [(4000 + i, "a copy " * 20) for i in range(150)]
    rows += [(1, None), (2, ""), (None, "no id"), (3, rows[3][1])]
    out = op8_sharding(docs(rows)).collect()
    size = lambda t: len((t or "").encode()) + 1
    expected = sorted(((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in out), key=repr) == expected
    loads, slots, places = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in out:
        assert r.law == "bytes" and r.grown_shard is None
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
        places[r.text_crc32].add(r.shard)
    assert sorted(loads) == list(range(16))
    assert max(loads.values()) < 1.02 * min(loads.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(p) == 1 for p in places.values())


def test_a_text_larger_than_a_shard_is_split(docs):
    rows = [(i, "the same text again and again") for i in range(3000)] + [(9000 + i, prose(30, i)) for i in range(50)]
    loads = defaultdict(int)
    for r in op8_sharding(docs(rows)).collect():
        loads[r.shard] += r.size
    assert len(loads) == 16 and max(loads.values()) < 1.2 * min(loads.values())


def test_few_and_no_rows(docs):
    assert op8_sharding(docs([(1, None)])).first().slot == 0
    kinds = dict(op8_sharding(docs([(1, None)])).dtypes)
    assert [kinds[c] for c in ("size", "text_crc32", "shard", "slot", "grown_shard")] == ["bigint", "bigint", "int", "bigint", "int"]
    assert op8_sharding(docs([])).count() == 0


def test_whole_documents_are_written(spark, docs, tmp_path):
    table = docs([(i % 90, prose(20, i)) for i in range(100)] + [(None, None)])
    write_sharded(table, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select("doc_id", "text", "key").exceptAll(table.select("doc_id", "text", "key")).count() == 0
    assert back.count() == 101
