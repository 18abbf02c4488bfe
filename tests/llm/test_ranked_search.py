import math
import random
import re
from collections import Counter

import pytest

from parcelstar.llm.ranked_search import mine_plan, op13_ranked_search, ranked_search

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORDS = [f"w{i}" for i in range(60)] + ["Été", "漢字", "x_y", "don't", "THE", "the", "The"]


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, best=10):
    counted = [(doc, Counter(terms(text))) for doc, text in rows]
    counted = [(doc, c) for doc, c in counted if c]
    n, words = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scores = []
        for doc, c in counted:
            m = 10 + 90 * sum(c.values()) * n // words
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in own
                if c[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (score, none, doc) in enumerate(sorted(scores)[:best], 1):
            out.append((item, rank, None if none else doc, -score))
    return sorted(out, key=repr)


def items_of(spark, items):
    more = ", rank string, term string" if len(items[0]) == 4 else ""
    return spark.createDataFrame(items, f"item_id long, text string{more}")


def cases():
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choices(WORDS, weights=range(len(WORDS), 0, -1), k=n))
    rows = [(i, text(rng.randint(1, 60))) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # equal scores
    rows += [(7, rows[7][1]), (None, rows[7][1]), (2000, None), (2001, ""), (2002, "?! ..."), (1 << 60, text(20)), ((1 << 60) + 1, text(20))]
    rows += [(3000, text(30_000)), (3001, "w3 " * 5000)]
    shared = text(12)
    items = [(i, f"{shared} {text(rng.randint(1, 15))}") for i in range(40)]
    items += [(50, None), (51, ""), (52, "nowhere unheard"), (53, "w5"), (54, "the THE"), (None, "w1 w2"), (None, "w9"), (55, rows[7][1])]
    items += [(3, "w55 w56"), (3, items[3][1]), (56, text(3000))]
    return rows, items


def test_equals_brute_force(spark, docs):
    rows, items = cases()
    found = op13_ranked_search(docs(rows), items_of(spark, items)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows, items)


@pytest.mark.parametrize("best", [1, 25])
def test_blocks_of_items_change_nothing(spark, docs, best):
    rows, items = cases()
    found = ranked_search(docs(rows), items_of(spark, items), best, block_bytes=600).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows, items, best)


def test_empty_tables(spark, docs):
    rows, items = cases()
    assert op13_ranked_search(docs([]), items_of(spark, items)).count() == 0
    assert op13_ranked_search(docs([(1, None)]), items_of(spark, items)).count() == 0
    none = op13_ranked_search(docs(rows), items_of(spark, items).limit(0))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]


def test_columns_with_clashing_names(spark, docs):
    rows, items = cases()
    clashing = items_of(spark, [(i, t, "x", "y") for i, t in items])
    assert sorted(map(tuple, op13_ranked_search(docs(rows), clashing).collect()), key=repr) == brute(rows, items)


def test_the_plan_adds_every_term_once_and_shares():
    rng = random.Random(1)
    items = [sorted(rng.sample(range(20), 8) + rng.sample(range(20, 400), 12)) for _ in range(150)]
    items += [[], [5], list(range(400)), items[0]]
    plan = mine_plan(items, 400)
    assert [sorted(t for n in nodes for t in plan.terms_of(n)) for nodes in plan.items] == items
    adds = len(plan.pairs) + sum(len(nodes) for nodes in plan.items)
    assert adds < 0.8 * sum(map(len, items))
