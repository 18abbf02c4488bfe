import math
import zlib
from collections import Counter

import numpy as np
import pytest

from parcelstar.llm import language_model
from parcelstar.llm.elias_fano import EliasFano, encode
from parcelstar.llm.language_model import op10_lm_scoring
from tests.llm.conftest import prose


@pytest.mark.parametrize(
    "n, universe", [(0, 10), (1, 1), (5, 1000), (3000, 3000), (5000, 1 << 40), (5000, 100), (20_000, 1 << 62)]
)
def test_sequences_are_read_and_searched(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n, dtype=np.uint64))
    words = encode(values, universe)
    own = EliasFano(np.concatenate([words, np.arange(9, dtype=np.uint64)]))
    assert own.length == len(words)
    assert (own.get(np.arange(n)) == values).all()
    wanted = np.concatenate([rng.integers(0, universe, 500, dtype=np.uint64), values])
    place, found = own.successor(wanted)
    assert (place == np.searchsorted(values, wanted)).all() and (found == np.isin(wanted, values)).all()
    if n > 1000 and universe > n:
        assert 64 * len(words) < n * (3.2 + math.log2(universe / n)) + 2000


def brute(rows):
    texts = [(t or "").encode().lower().split() + [b"\n"] for _, t in rows]
    train = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2 for i, _ in rows]
    count, pairs = Counter(), Counter()
    for words, used in zip(texts, train, strict=True):
        if used:
            count.update(words)
            pairs.update(zip([b"\n", *words[:-1]], words, strict=True))
    after = Counter(u for u, _ in pairs)
    n, v = sum(count.values()), len(count)
    p = lambda w: (count[w] + 1) / (n + v + 1)
    out = []
    for (doc, _), words, used in zip(rows, texts, train, strict=True):
        score = 0
        for u, w in zip([b"\n", *words[:-1]], words, strict=True):
            seen = count[u]
            rest = 0.75 * after[u] / seen if seen else 1
            score += math.log10((max(pairs[u, w] - 0.75, 0) / seen if seen else 0) + rest * p(w))
        known = sum(count[w] > 0 for w in words)
        out.append((doc, not used, len(words), known, n, sum(math.log10(p(w)) for w in words), score))
    return out


ROWS = (
    [(i, prose(5 + i % 60, i)) for i in range(200)]
    + [(300, None), (301, ""), (302, "ONE one One"), (302, "ONE one One"), (None, "no id here")]
    + [(303, "very common pair " * 3000), (304, prose(30_000, 9)), (305, "unseen" if zlib.crc32(b"305") % 7 == 2 else "")]
)


@pytest.mark.parametrize("words, tokens", [(1 << 19, 1 << 22), (100, 2000), (7, 300), (0.25, 1 << 22)])
def test_scores_equal_brute_force(docs, monkeypatch, words, tokens):
    """With shards of usual size, so small that a word's pairs lie in several, and more shards
    of words than the pieces in which tasks hand on their counts."""
    monkeypatch.setattr(language_model, "WORDS_PER_SHARD", words)
    monkeypatch.setattr(language_model, "TOKENS_PER_SHARD", tokens)
    got = sorted(map(tuple, op10_lm_scoring(docs(ROWS)).collect()), key=repr)
    expected = sorted(brute(ROWS), key=repr)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[5] == pytest.approx(e[5], rel=1e-9) and g[6] == pytest.approx(e[6], abs=1e-6 + 1e-4 * e[2])


def test_held_out_texts_are_likelier_than_under_the_base(docs):
    rows = [(i, "the cat sat on the mat and the dog sat on the log " * (1 + i % 3)) for i in range(100)]
    held = [r for r in op10_lm_scoring(docs(rows)).collect() if r.held_out]
    assert held and sum(r.score for r in held) > 0.5 * sum(r.base_score for r in held)


def test_without_training_documents(docs):
    held_out = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    got = op10_lm_scoring(docs([(i, "a b") for i in held_out])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0, 0)] * 3
    assert op10_lm_scoring(docs([])).count() == 0
