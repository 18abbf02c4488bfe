import hashlib
import re

import pytest

from parcelstar.llm.decontamination import contamination, decontaminate, op1_decontamination
from tests.llm.conftest import prose

ITEM = [
    (1, prose(30, 1)),
    (2, prose(13, 2)),
    (3, "Only five words, right here"),
    (4, None),
    (5, " ... "),
    (None, prose(20, 6)),
    (7, prose(30, 1)),
    (8, "a a a a a a a a a a a a a a a"),
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items):
    windows = []
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        if n:
            windows += [(item, w[i : i + n]) for i in range(len(w) - n + 1)]
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for item, g in windows:
            for i in range(len(w) - len(g) + 1):
                if w[i : i + len(g)] == g:
                    hit.update(range(i, i + len(g)))
                    found.add(item)
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        n_items = len({i for i in found if i is not None})
        bad = len(hit) > 0 and 20 * len(hit) >= len(w)
        sha = hashlib.sha256(ids.encode()).hexdigest()
        out.append((doc, len(w), len(hit), n_items, sha, bad))
    return sorted(out, key=repr)


ROWS = [
    (1, None),
    (2, ""),
    (3, "!!! ... ---"),
    (4, ITEM[0][1]),
    (5, prose(100, 9) + " " + ITEM[0][1].upper() + " " + prose(400, 10)),
    (6, prose(300, 11) + "\n" + ITEM[1][1].replace(" ", "--") + "\n" + prose(300, 12)),
    (7, prose(50, 13) + " only FIVE words right\there " + prose(20, 14)),
    (8, " ".join(ITEM[1][1].split()[:12])),
    (9, ITEM[5][1]),
    (9, ITEM[5][1]),
    (9, prose(40, 15)),
    (None, ITEM[1][1]),
    (11, "a " * 40 + "b"),
    (12, "É" + ITEM[0][1]),
    (13, prose(30_000, 16) + " " + ITEM[0][1]),
    (14, " ".join(ITEM[0][1].split()[3:16]) + " x " + " ".join(ITEM[0][1].split()[10:24])),
]


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_brute_force(spark, docs):
    items = spark.createDataFrame(ITEM, "item_id long, text string")
    assert collected(op1_decontamination(docs(ROWS), items)) == brute(ROWS, ITEM)


def test_a_benchmark_too_large_to_broadcast(spark, docs):
    items = spark.createDataFrame(ITEM, "item_id long, text string")
    found = contamination(docs(ROWS), items, broadcast_rows=0)
    expected = {(r[0], r[1], r[2], r[3]) for r in brute(ROWS, ITEM)}
    assert {(r.doc_id, r.n_words, r.n_hit, r.n_items) for r in found.collect()} == expected


def test_items_of_all_short_lengths_in_one_pass(spark, docs):
    words = prose(200, 30).split()
    items = [(100 + n, " ".join(words[3 * n : 4 * n])) for n in range(1, 13)] + [(99, "!?"), (98, None)]
    rows = [(i, " ".join(words[i : i + 4 * i])) for i in range(1, 60)] + [(200, "x"), (201, None), (202, " ".join(words))]
    table = spark.createDataFrame(items, "item_id long, text string")
    for some in (None, 0):
        found = contamination(docs(rows), table, **({} if some is None else {"broadcast_rows": some}))
        expected = {(r[0], r[1], r[2], r[3]) for r in brute(rows, items)}
        assert {(r.doc_id, r.n_words, r.n_hit, r.n_items) for r in found.collect()} == expected


def test_short_items_take_one_scan_of_the_documents(spark, tmp_path):
    rows = [(i, prose(30, i)) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents"))
    words = prose(200, 30).split()
    items = [(n, " ".join(words[n : 2 * n])) for n in range(1, 16)]
    found = contamination(spark.read.parquet(str(tmp_path / "documents")), spark.createDataFrame(items, "item_id long, text string"))
    physical = found._jdf.queryExecution().optimizedPlan().toString()
    # One for the fingerprints of long items, one for all lengths of short ones.
    assert sum("text#" in line for line in physical.split("\n") if "Relation [" in line) <= 2


@pytest.mark.parametrize("rows, items", [([], ITEM), (ROWS, []), ([], [])])
def test_empty_tables(spark, docs, rows, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert collected(op1_decontamination(docs(rows), benchmark)) == brute(rows, items)


def test_contaminated_documents_go_and_columns_stay(spark, docs):
    items = spark.createDataFrame(ITEM, "item_id long, text string")
    table = docs(ROWS)
    kept = decontaminate(table, items)
    bad = {(r[0], r[1]) for r, b in zip(ROWS, [brute([r], ITEM)[0][5] for r in ROWS], strict=True) if b}
    assert kept.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        (r for r in ROWS if r not in bad), key=repr
    )
