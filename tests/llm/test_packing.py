import random
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelstar.llm.packing import CAPACITY, NAME, Encoder, op7_best_fit_packing, plan, tokenizer_path
from tests.llm.conftest import prose

PARTS = [
    "a", "b", " ", "\n", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "'s", "'", "1", "é", "ß", "Σ", "漢",
    "🙂", "꟎", "​", "\xa0", "aaaa", "the", "!", "\x1c", "\x85", "́", "A", ".", ",", "*", "-", "=", "H",
    "̱", "̸", "²", "½", "İ", "'S", "_", "\\",
]


def library(texts):
    own = Tokenizer.from_file(tokenizer_path(NAME))
    return [np.array(e.ids, dtype="<u4").tobytes() for e in own.encode_batch(texts, add_special_tokens=False)]


def test_ids_equal_the_library():
    random.seed(1)
    texts = ["".join(random.choices(PARTS, k=random.randint(0, 30))) for _ in range(8000)]
    own = Encoder(tokenizer_path(NAME))
    assert own.encode([t.encode() for t in texts]) == library(texts)
    own = Encoder(tokenizer_path(NAME), 5)
    assert [own.encode([t.encode()])[0] for t in texts[:300]] == library(texts[:300])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_every_piece_is_packed_once(lengths):
    patterns = plan(dict(Counter(lengths)), 30)
    used = Counter()
    for pattern, times in patterns:
        assert times > 0 and sum(pattern) <= 30
        for length in pattern:
            used[length] += times
    assert used == Counter(lengths)
    # Best fit never leaves two sequences half empty.
    assert sum(t for p, t in patterns for _ in [0] if 2 * sum(p) <= 30) <= 1


def test_exact_complements_are_used():
    patterns = plan({20: 3, 10: 1, 7: 1, 3: 1, 5: 1, 4: 1, 1: 1}, 30)
    assert sorted(sum(p) for p, t in patterns for _ in range(t)) == [30, 30, 30]


def check(rows, out):
    ids = dict.fromkeys([])
    texts = [t or "" for _, t in rows]
    whole = Counter((i, e + b"\1\0\0\0") for (i, _), e in zip(rows, library(texts), strict=True))
    pieces = Counter()
    for (doc, data), n in whole.items():
        for piece, at in enumerate(range(0, len(data), 4 * CAPACITY)):
            part = data[at : at + 4 * CAPACITY]
            pieces[doc, piece, at // 4, len(part) // 4, zlib.crc32(part)] += n
    assert Counter(tuple(r)[:5] for r in out) == pieces
    by = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by.get(r.sequence_id, 0)
        by[r.sequence_id] = r.offset + r.length
    assert all(n <= CAPACITY for n in by.values())
    return len(by), sum(r.length for r in out), ids


def test_query(docs):
    rows = [(1, None), (2, ""), (3, "Hello world"), (3, "Hello world"), (None, prose(500)), (5, prose(20_000, 3))]
    rows += [(10 + i, prose(20 + 7 * (i % 40), i)) for i in range(300)]
    out = op7_best_fit_packing(docs(rows)).collect()
    sequences, tokens, _ = check(rows, out)
    assert sequences == -(-tokens // CAPACITY)
    assert op7_best_fit_packing(docs([])).count() == 0
