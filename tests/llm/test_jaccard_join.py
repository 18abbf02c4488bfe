import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelstar.llm import jaccard_join
from parcelstar.llm.components import components
from parcelstar.llm.jaccard_join import bitmap, keep_one_of_each, may_link, near_duplicates, prefix_keys
from tests.llm.conftest import prose


def sets_of(rows, k=5):
    out = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        n = min(k, len(w))
        out.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset())
    return out


def brute(rows):
    sets = sets_of(rows)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    having = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in having[g])
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for g in s:
            having[g].append(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=repr)


def near(text, changes, seed):
    w, rng = text.split(), random.Random(seed)
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"new{rng.random()}"
    return " ".join(w)


def corpus():
    rows = [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE "), (1005, "two words"), (1006, "one one")]
    base = prose(200, 1)
    rows += [(i, near(base, i % 9, i)) for i in range(60)]
    passage = prose(60, 2)
    rows += [(100 + i, passage + " " + prose(10 + 3 * i, 50 + i)) for i in range(60)]
    parts = [prose(40, 200 + i) for i in range(6)]
    rows += [(200 + i, " ".join(random.Random(i).sample(parts, 4))) for i in range(60)]
    rows += [(300 + i, prose(30, 300)) for i in range(20)]
    long = prose(20_000, 400)
    rows += [(400, long), (401, near(long, 100, 1)), (402, near(long, 1500, 2))]
    rows += [(5, near(base, 1, 77)), (5, near(base, 1, 77)), (5, prose(50, 78)), (None, near(base, 2, 79)), (None, prose(50, 80))]
    return rows


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("few, frequent", [(32, 64), (2, 0.5), (3, 8), (1000, 3)])
def test_equals_brute_force(docs, monkeypatch, few, frequent):
    """Also with all keys in large buckets, and with most tokens frequent."""
    monkeypatch.setattr(jaccard_join, "FEW", few)
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    rows = corpus()
    assert got(near_duplicates(docs(rows))) == brute(rows)


def test_empty_tables(docs):
    assert near_duplicates(docs([])).count() == 0
    assert got(near_duplicates(docs([(1, None), (2, "")]))) == [(1, 0, 1), (2, 0, 2)]


def test_one_document_of_each_component_stays(docs):
    rows = [r for r in corpus() if r[0] is not None and r[0] != 5]
    table = docs(rows)
    kept = keep_one_of_each(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute(rows)})


def test_texts_are_judged_by_id_and_text(docs):
    a, b, c = prose(40, 1), prose(40, 2), prose(40, 3)
    rows = [(1, a), (5, b), (5, a), (None, c), (None, c), (None, a), (7, b.upper()), (8, ""), (8, ""), (9, None)]
    rows += [(2, prose(30, 4)), (2, prose(30, 4)), (None, prose(30, 5)), (None, prose(30, 6))]
    kept = sorted(((r.doc_id, r.text) for r in keep_one_of_each(docs(rows)).collect()), key=repr)
    stay = [(1, a), (5, b), (None, c), (8, ""), (8, ""), (9, None), (2, prose(30, 4)), (None, prose(30, 5)), (None, prose(30, 6))]
    assert kept == sorted(stay, key=repr)


def test_a_text_with_a_shared_id_and_no_copies_stays(docs):
    rows = [(1, prose(40, 1)), (1, prose(40, 2)), (1, prose(40, 3)), (2, prose(40, 3))]
    assert keep_one_of_each(docs(rows)).count() == 3


def meets(x, y, of_x, of_y):
    """Do the sets share a key in the prefixes that their sizes need?"""
    overlap = -(-80 * (len(x) + len(y)) // 180)
    kx = of_x[0][of_x[1] <= len(x) - overlap + 1]
    ky = of_y[0][of_y[1] <= len(y) - overlap + 1]
    return len(np.intersect1d(kx, ky)) > 0


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(1)
    for trial in range(400):
        n = int(rng.integers(1, 120))
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        y = x.copy()
        for _ in range(int(rng.integers(0, 1 + n // 8))):
            y[rng.integers(0, len(y))] = rng.integers(0, 1 << 63, dtype=np.uint64)
        y = np.unique(y[: int(rng.integers(max(1, 8 * len(y) // 10), len(y) + 1))])
        both = len(np.intersect1d(x, y))
        if 100 * both < 80 * (len(x) + len(y) - both):
            continue
        share = rng.random()
        often = lambda s, share=share: (s >> np.uint64(40)) % np.uint64(1000) < np.uint64(int(1000 * share))
        assert meets(x, y, prefix_keys(x, often(x)), prefix_keys(y, often(y))), trial
        assert may_link(len(x), len(y), bitmap(x), bitmap(y))


def test_bitmaps_of_unlike_length():
    rng = np.random.default_rng(2)
    x = np.unique(rng.integers(0, 1 << 63, 540, dtype=np.uint64))
    assert len(bitmap(x)) == 128 and len(bitmap(x[:500])) == 64
    assert may_link(len(x), 500, bitmap(x), bitmap(x[:500]))
    assert not may_link(540, 500, bitmap(x), bitmap(rng.integers(0, 1 << 63, 500, dtype=np.uint64)))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 40)] + [(139, 300), (500, 500)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), 300: 100}
    assert components(df.where(F.lit(False))).count() == 0
