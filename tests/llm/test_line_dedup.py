from collections import defaultdict
from hashlib import sha256

import numpy as np

from parcelstar.llm.line_dedup import (
    AGAIN,
    Filters,
    dedup_lines,
    in_again,
    line_report,
    long_lines,
    op11_line_dedup,
    segments_for,
)
from tests.llm.conftest import prose

SPACE = " \t\n\v\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(SPACE).translate(LOWER)


def brute(rows, least=40, enough=5):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least and doc is not None:
                holders[key(line)].add(doc)
    keeps = {k: max(ids) for k, ids in holders.items() if len(ids) >= enough}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeps or keeps[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def same(found, expected):
    assert sorted(found, key=repr) == sorted(expected, key=repr)


LONG = "This Line is long enough to count as one that repeats."


def cases():
    rows = [(i, f"{prose(15, i)}\n{LONG}\n{prose(3, i)}") for i in range(20)]
    rows += [(i, f" \t{LONG.upper()}\r\n{prose(12, i)}\n{LONG}") for i in range(20, 30)]
    four = "found in four documents only, so that all of them keep it"
    rows += [(40 + i, four) for i in range(4)]
    rows += [(50 + i, f"{'É' * 40}\n{'é' * 40}\n{'ü' * 39}") for i in range(5)]  # no ASCII
    rows += [(60 + i, "x" * 40 + "\n" + "y" * 39) for i in range(6)]
    rows += [(70, "\n".join([LONG] * 50)), (71, "\n" * 5), (72, ""), (73, None), (74, " " + LONG)]
    rows += [(1, f"another text of document one\n{LONG}"), (1, f"another text of document one\n{LONG}")]
    rows += [(None, LONG), (None, LONG), (None, f"{LONG}\nno id")]
    rows += [(80, "\n".join(prose(12, i % 40) for i in range(3000))), (81, "z" * 300_000)]
    rows += [(90 + i, "z" * 300_000) for i in range(6)]
    return rows


def test_equals_brute_force(docs):
    rows = cases()
    found = line_report(docs(rows)).collect()
    same([tuple(r) for r in found], brute(rows))
    digests = [(d, n, m, sha256(t.encode()).hexdigest()) for d, n, m, t in brute(rows)]
    same([tuple(r) for r in op11_line_dedup(docs(rows)).collect()], digests)


def test_other_limits(docs):
    rows = [(i, "\n".join(f"line {(i * j) % 7}" for j in range(i))) for i in range(30)]
    same([tuple(r) for r in line_report(docs(rows), 3, 2).collect()], brute(rows, 3, 2))


def test_documents_keep_their_columns(docs):
    rows = [(i, LONG) for i in range(6)] + [(7, None)]
    table = docs(rows)
    out = dedup_lines(table)
    assert out.columns == table.columns
    same([(r.doc_id, r.text, r.key) for r in out.collect()], [(i, "", "key") for i in range(5)] + [(5, LONG, "key"), (7, None, "key")])


def test_no_rows_and_no_long_lines(docs):
    assert op11_line_dedup(docs([])).count() == 0
    same([tuple(r) for r in line_report(docs([(1, "short"), (2, None)])).collect()], [(1, 1, 0, "short"), (2, 1, 0, "")])


def test_lines_of_bytes():
    places, keys = long_lines(("short\n" + "a" * 40 + "\n" + "é" * 39 + "\n" + "A" * 40 + " ").encode())
    assert places == [1, 3] and keys[:16] == keys[16:]


def test_second_filter_misses_no_repeat_and_few_others():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 1 << 63, 200_000, dtype=np.uint64) << np.uint64(1)  # one segment: even
    filters = Filters()
    filters.add(values[:100_000], values[:10])
    filters.add(values[90_000:], values[:0])
    packed = np.packbits(filters.again, bitorder="little")
    assert len(packed) == 1 << (AGAIN - 3)
    again = in_again(packed, values, 1)
    assert again[:10].all() and again[90_000:100_000].all()
    assert again[10:90_000].mean() < 0.001 and again[100_000:].mean() < 0.001
    assert [segments_for(n) for n in (0, 1, 1 << 18, (1 << 18) + 1, 1 << 40)] == [1, 1, 1, 2, 1024]
