import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from parcelstar.llm.merkle_manifest import (
    BLOCK,
    append_log,
    fold,
    height_of,
    manifest_proofs,
    op12_merkle_manifest,
    parent,
    positions,
    record_digest,
)
from tests.llm.conftest import CLASHING, prose

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    parts = []
    for i, value in enumerate(row):
        if i == 4 and lower and value is not None:
            value = value.translate(LOWER)
        parts.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return h(*parts)


def climb(nodes):
    """For each node the levels above it, (left, right) each, and the root."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    level = list(nodes)
    while len(level) > 1:
        for i, place in enumerate(places):
            first = place // 16 * 16
            paths[i].append(("".join(level[first:place]), "".join(level[place + 1 : first + 16])))
        level = [h(*level[i : i + 16]) for i in range(0, len(level), 16)]
        places = [p // 16 for p in places]
    return paths, level[0]


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        own = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[source] = (own, *climb([leaf(r) for r in own]))
    upper, root = climb([trees[s][2] for s in order])
    out = []
    for source, above in zip(order, upper, strict=True):
        own, paths, subroot = trees[source]
        for row, path in zip(own, paths, strict=True):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            cur = leaf(row, lower=tampered)
            for left, right in path + above:
                cur = h(left, cur, right)
            proof = h(*(left + right for left, right in path + above))
            out.append((row[0], leaf(row), subroot, root, proof, cur, cur == root))
    return out


def same(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in CLASHING})
    found = [tuple(r) for r in op12_merkle_manifest(table).collect()]
    assert sorted(found, key=repr) == sorted(brute(rows), key=repr)
    return found


def test_equals_brute_force(spark):
    rows = [(i, f"src{i % 7}", "en", i, "Some Text " + prose(5, i)) for i in range(400)]
    rows += [(1000 + i, None, None, None, None) for i in range(17)]
    rows += [(2000 + i, "", "", 0, "") for i in range(33)]
    rows += [(3000, "ä", "de", -1, "ÄÖ Z"), (3001, "z", "en", 3, "lower"), (3002, "Z", "en", 1, "UP"), (-7, "é", "fr", 2, "X" * 200_000)]
    rows += [(5, "src1", "en", 5, "the id again"), (5, "src1", "en", 5, "the id again")]
    rows += [(None, "src2", "en", 1, "No Id"), (None, "src2", "en", 1, "No Id"), (None, None, None, None, "A")]
    found = same(spark, rows)
    assert {r[-1] for r in found} == {True, False}


def test_one_hot_source_over_several_blocks(spark):
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(2 * BLOCK + 1)] + [(-i, f"s{i}", "en", 1, "T") for i in range(1, 40)]
    same(spark, rows)


@pytest.mark.parametrize("n", [1, 2, 16, 17])
def test_small_tables(spark, n):
    same(spark, [(i, "one", "en", i, "T") for i in range(n)])


def test_empty_table(spark):
    assert op12_merkle_manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_any_presented_record_can_be_checked(spark):
    table = spark.createDataFrame([(i, "s", "en", i, f"t{i}") for i in range(40)], SCHEMA)
    changed = record_digest(
        F.col("doc_id"), F.col("source"), F.col("lang"), F.when(F.col("doc_id") == 3, 99).otherwise(F.col("n_chars")), F.col("text")
    )
    out = {r.doc_id: r.verified for r in manifest_proofs(table, changed).collect()}
    assert [i for i, ok in out.items() if not ok] == [3]
    assert manifest_proofs(table).where("verified").count() == 40


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 4095, 4096])
def test_positions_follow_completion(n):
    for alone in (True, False):
        height = height_of(n, alone)
        leaves = [i.to_bytes(32, "big") for i in range(n)]
        log = append_log(leaves, height)
        at = positions(n, height)
        assert sorted(p for level in at for p in level) == list(range(len(log) // 32))
        nodes = leaves
        for level in range(height + 1):
            assert [log[p * 32 : p * 32 + 32] for p in at[level]] == nodes
            nodes = [parent(b"".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        assert len(at[-1]) == 1 and log[-32:] == log[at[-1][0] * 32 :][:32]


def test_fold_of_nothing_is_the_leaf():
    assert fold(b"x" * 32, []) == b"x" * 32
