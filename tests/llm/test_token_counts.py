import random
import time

from tokenizers import Tokenizer

from parcelstar.llm.token_counts import NAME, Counter, op6_token_counts, tokenizer_path

PARTS = [
    "a", "b", " ", "  ", "\n", "\t", "<|endoftext|>", "<|", "'s", "'", "1", "23", "é", "ß", "漢字", "🙂", "՘",
    "꟎", "​", "\xa0", " ", "aaaa", " the", "!", "...", "\x1c", "\x85", "\r\n", "́", "A", "\0",
]


def library(texts):
    own = Tokenizer.from_file(tokenizer_path(NAME))
    return [len(e.ids) for e in own.encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library():
    random.seed(1)
    texts = ["".join(random.choices(PARTS, k=random.randint(0, 40))) for _ in range(5000)]
    texts += ["a" * 5000, "ab" * 3000, " " * 999, "", "<|endoftext|>" * 3, "word " * 50_000]
    assert Counter(tokenizer_path(NAME)).count(texts) == library(texts)


def test_a_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr("parcelstar.llm.token_counts.CACHE", 3)
    monkeypatch.setattr("parcelstar.llm.token_counts.BLOCK", 10)
    texts = ["one two three", "two three four five", "one", "five six"] * 3
    assert Counter(tokenizer_path(NAME)).count(texts) == library(texts)


def test_query(docs):
    rows = [(1, None), (2, ""), (3, "Hello world"), (3, "Hello world"), (None, "é" * 600), (5, "x " * 200_000)]
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in op6_token_counts(docs(rows)).collect()}
    counts = library([t or "" for _, t in rows])
    assert got == {(i, len((t or "").encode()), n, n > 512) for (i, t), n in zip(rows, counts, strict=True)}
    assert op6_token_counts(docs(rows)).count() == len(rows)
    assert op6_token_counts(docs([])).count() == 0


def test_long_pre_tokens_equal_the_library():
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = ["".join(rng.choices(letters, k=n)) for n in (255, 256, 257, 3000)]
    texts += ["".join(rng.choices("ab", k=4000)), "a" * 7001, "ab" * 2500, "".join(rng.choices("etaoin", k=5000))]
    texts += ["".join(rng.choices("éß漢字🙂", k=900)), "=-" * 400 + "\n" + "x" * 300 + " " + "yx" * 200]
    assert Counter(tokenizer_path(NAME)).count(texts) == library(texts)


def test_a_very_long_pre_token_takes_little_time():
    text = "".join(random.Random(6).choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    began = time.time()
    assert Counter(tokenizer_path(NAME)).count([text])[0] > 500_000
    assert time.time() - began < 20
