import random
import time

import numpy as np
import pytest

from parcelstar.llm.license_scan import (
    BAND,
    COVERAGE,
    Index,
    Match,
    align,
    best,
    license_words,
    op9_license_scan,
    winnowed,
)
from parcelstar.llm.license_texts import TEMPLATES
from tests.llm.conftest import prose

INDEX = Index(TEMPLATES)


def test_every_template_is_found_whole_in_any_layout():
    for name, text in TEMPLATES.items():
        shown = prose(40, 1) + "\n# " + text.upper().replace("\n", "\n# ").replace(" ", "  ") + "\n" + prose(40, 2)
        matches = [m for m in INDEX.scan(shown.encode()) if m.template == name]
        assert [m.coverage for m in matches] == [1.0], name
        assert matches[0].last - matches[0].first + 1 == matches[0].matched


def test_texts_without_licenses_give_nothing():
    assert INDEX.scan(None) == INDEX.scan(b"") == INDEX.scan(prose(5000, 3).encode()) == []
    assert INDEX.scan(b"the software is free to use and to copy in any version of the license") == []


def test_edited_copies_and_their_spans():
    rng = random.Random(1)
    words = TEMPLATES["MIT"].split()
    for _ in range(20):
        copy = list(words)
        for _ in range(8):
            copy[rng.randrange(len(copy))] = "other"
        for _ in range(5):
            del copy[rng.randrange(len(copy))]
            copy.insert(rng.randrange(len(copy)), "extra")
        found = INDEX.scan((" ".join(["pad"] * 30 + copy + ["pad"] * 30)).encode())
        assert [m.template for m in found] == ["MIT"]
        assert 0.85 <= found[0].coverage < 1 and 28 <= found[0].first and found[0].last <= 32 + len(copy)


def test_repeated_notices_are_found_each():
    text = "\n".join([prose(9, i) + " Released under the MIT License." for i in range(50)])
    assert [m.template for m in INDEX.scan(text.encode())] == ["MIT notice"] * 50


@pytest.mark.parametrize(
    "text, name",
    [
        ("This work is licensed under the GNU General Public License, version 2", "GPL-2.0 notice"),
        ("This work is licensed under the GNU General Public License v3", "GPL-3.0 notice"),
        ("This work is licensed under the GNU General Public License.", "GPL notice"),
        ("This work is licensed under the GNU General Public License, version 7.", "GPL notice"),
        ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0 notice"),
        ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1 notice"),
        ("Licensed under the Apache License, Version 1.1", "Apache-1.1 notice"),
        ("Licensed under Apache License 2.0", "Apache-2.0 notice"),
        ("Licensed under the CC BY-NC-SA 3.0 license", "CC-BY-NC-SA-3.0 notice"),
        ("Licensed under CC BY 2.5", "CC-BY-2.5 notice"),
        ("Released under MIT License", "MIT notice"),
        ("Released under the BSD License.", "BSD notice"),
        ("Released under the Sleepycat License.", None),
        (TEMPLATES["GPL-3.0 header"].replace("version 3", "version 2"), "GPL-2.0 header"),
        (TEMPLATES["GPL-3.0 header"].replace("General", "Lesser General"), "LGPL-3.0 header"),
    ],
)
def test_sibling_licenses_are_told_apart(text, name):
    found = INDEX.scan(f"{prose(30, 1)}\n{text}\n{prose(30, 2)}".encode())
    assert [m.template for m in found] == [name] * bool(name)


def test_whole_texts_give_their_own_name_alone():
    for name in ("Unlicense", *(n for n in TEMPLATES if n.endswith(" text"))):
        assert [m.template for m in INDEX.scan(TEMPLATES[name].encode())] == [name], name


def test_the_whole_affero_license_is_not_the_general_one():
    names = [("GNU Affero General", "GNU X"), ("GNU GENERAL", "GNU AFFERO GENERAL"), ("GNU G", "GNU Affero G"), ("GNU X", "GNU General")]
    text = TEMPLATES["GPL-3.0 text"]  # nearly all of its words are the same
    for old, new in names:
        text = text.replace(old, new)
    found = {m.template for m in INDEX.scan(text.encode())}
    assert "AGPL-3.0 header" in found and "GPL-3.0 text" not in found


def test_every_gram_of_a_short_template_is_met():
    index = Index({"own": "one two three four five six"}, {})
    for i in range(40):
        assert len(index.scan(f"{prose(i, i)} one two three other five six {prose(40, i)}".encode())) == 1


def whole_alignment(template, words):
    """Smith-Waterman over the full table: the best score."""
    table = np.zeros((len(template) + 1, len(words) + 1), int)
    for i, a in enumerate(template, 1):
        for j, b in enumerate(words, 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (2 if a == b else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
    return table.max()


def test_a_wide_band_aligns_as_the_full_table():
    rng = np.random.default_rng(3)
    for _ in range(60):
        template, words = rng.integers(1, 5, rng.integers(1, 15)), rng.integers(1, 5, rng.integers(1, 25))
        found = align(template, words, 0, 40)
        score = whole_alignment(template, words)
        assert (found is None) == (score == 0)
        if found:
            matched, first, last = found
            assert 0 <= first <= last < len(words) and 2 * matched >= score >= matched - (last - first + 1)


def test_winnowing_keeps_one_of_every_window():
    rng = np.random.default_rng(4)
    for _ in range(50):
        hashes = rng.integers(0, 6, rng.integers(1, 30)).astype(np.uint64)
        kept = set(winnowed(hashes, 3).tolist())
        assert all(kept & {i, i + 1, i + 2} for i in range(len(hashes) - 2)) and kept


def test_too_many_templates_are_refused(monkeypatch):
    monkeypatch.setattr("parcelstar.llm.license_scan.MOST_WORDS", 10)
    with pytest.raises(ValueError, match="at a time"):
        Index(TEMPLATES)


def test_query(docs):
    notice = "Licensed under CC BY-NC 4.0."
    rows = [(1, None), (2, ""), (3, notice), (3, notice), (None, notice), (5, prose(30_000, 5) + " " + notice)]
    got = sorted((repr(r.doc_id), r.n_matches, r.licenses) for r in op9_license_scan(docs(rows)).collect())
    name = "CC-BY-NC-4.0 notice"
    assert got == sorted((repr(i), int(bool(t)), name if t else "") for i, t in rows)
    assert op9_license_scan(docs([])).count() == 0


def brute(index, text):
    """Every template aligned with the text on every diagonal."""
    words = np.array([index.ids.get(w, 0) for w in license_words(text)], dtype=np.int64)
    matches = []
    for number, template in enumerate(index.templates):
        band, needed = BAND + len(template) // 10, COVERAGE * len(template)
        for diagonal in range(-len(template), len(words) + 1):
            aligned = align(template, words, diagonal, band)
            if aligned and aligned[0] >= needed and index._has_runs(words, number, *aligned[1:]):
                matches.append(Match(index.names[number], aligned[0], aligned[0] / len(template), *aligned[1:]))
    groups = {name: len(own) for name, own in zip(index.names, index.runs, strict=True)}
    return {(m.template, m.matched, m.first, m.last) for m in best(set(matches), groups)}


def test_equals_a_full_alignment_of_all_templates():
    short = sorted(TEMPLATES, key=lambda n: len(license_words(TEMPLATES[n].encode())))
    chosen = {n: TEMPLATES[n] for n in short if 8 <= len(license_words(TEMPLATES[n].encode())) <= 60}
    index, rng = Index(chosen), random.Random(3)
    names = sorted(chosen)
    found = 0
    for _ in range(12):
        parts = []
        for _ in range(rng.randint(1, 3)):
            own = chosen[rng.choice(names)].split()
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(len(own))] = "changed"
            parts += [" ".join(rng.choices(["the", "code", "of", "any", "file"], k=rng.randint(5, 25))), " ".join(own)]
        text = " ".join(parts).encode()
        got = {(m.template, m.matched, m.first, m.last) for m in index.scan(text)}
        full = brute(index, text)
        # The scan needs a run of words in common to look at a place; the rest is the same.
        assert got <= full and len(full - got) <= 1
        found += len(got)
    assert found >= 12


def test_many_notices_take_little_time():
    name = next(n for n in sorted(TEMPLATES) if "Apache-2.0" in n and len(TEMPLATES[n]) < 2000)
    index = Index(TEMPLATES)
    began = time.time()
    assert len(index.scan((TEMPLATES[name] + "\n").encode() * 5000)) == 5000
    fragments = " ".join(" ".join(TEMPLATES[n].split()[5:11]) + " zz" for n in sorted(TEMPLATES) * 70)
    index.scan(fragments.encode())
    assert time.time() - began < 40
