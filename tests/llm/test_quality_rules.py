import re
from collections import Counter

from pyspark.sql import functions as F

from parcelstar.llm.quality_rules import BASE, PROSE, Rule, keep_quality, op2_quality_rules, ordered
from tests.llm.conftest import prose

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    t = text or ""
    w = re.findall(WORD, t)
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    repeated = {
        j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)
    }
    n, chars = len(w), sum(map(len, w))
    symbols, dups = len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines))
    failed = n < 20 or 100 * len(repeated) > 30 * n
    letters = chars - len(re.findall(r"[\x21-\x40\x5B-\x60\x7B-\x7F\x00-\x08\x0E-\x1F]", t))
    kept = not (
        failed
        or 10 * symbols > n
        or not 2 * n <= chars <= 12 * n
        or len(re.findall("[A-Z]", t)) > len(re.findall("[a-z]", t))
        or 10 * (chars - letters) > 6 * chars
        or 10 * dups > 4 * len(lines)
        or 5 * sum(a == b for a, b in zip(w, w[1:], strict=False)) > n
    )
    return n, chars, symbols, dups, len(repeated), failed, kept


ROWS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, prose(19)),
    (5, prose(20)),
    (6, prose(100, 2)),
    (7, " ".join(x + "***" for x in prose(60, 3).split())),
    (8, prose(60, 4).upper()),
    (9, (prose(10, 5) + "\n") * 8),
    (10, prose(50, 6) + "\n" + prose(8, 7) + "\n" + prose(40, 8) + "\n" + prose(8, 7)),
    (11, " ".join(x for x in prose(12, 9).split() for _ in range(3))),
    (12, "é ñandú 🙂 über " * 30),
    (13, " ".join(str(i) for i in range(100))),
    (14, " ".join("x" * 40 for _ in range(30))),
    (14, prose(100, 2)),
    (None, prose(100, 2)),
    (16, prose(20_000, 10)),
    (17, prose(3_000, 11) + " " + prose(3_000, 11)),
    (18, "\x1ca b " * 15 + prose(80, 12)),
]


def test_equals_brute_force(docs):
    out = op2_quality_rules(docs(ROWS))
    expected = sorted(((i, *brute(t)) for i, t in ROWS), key=repr)
    assert sorted(map(tuple, out.collect()), key=repr) == expected


def test_the_order_of_rules_does_not_change_what_is_kept(docs):
    table = docs(ROWS)
    expected = sorted(((i, t) for i, t in ROWS if brute(t)[-1]), key=repr)
    for rules in (BASE + PROSE, (BASE + PROSE)[::-1]):
        kept = keep_quality(table, rules)
        assert kept.columns == table.columns
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == expected


def test_rules_that_reject_much_for_little_come_first(docs):
    rules = [
        Rule("never", lambda t, w: F.size(w) < 0),
        Rule("always", lambda t, w: F.size(w) >= 0),
    ]
    assert [r.name for r in ordered(docs(ROWS), rules)] == ["always", "never"]


def test_empty_table(docs):
    assert op2_quality_rules(docs([])).count() == 0
    assert keep_quality(docs([])).count() == 0
