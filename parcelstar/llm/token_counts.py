"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays.

Pre-tokens of a batch lie side by side in one array of symbols. In each round every
pre-token's lowest-ranked pair is found and all its occurrences are merged at once, in all
pre-tokens together; pre-tokens without a known pair are done, and the symbols that are
left are counted. A symbol's pairs rank after the merge that makes it, so merging all
occurrences of the lowest pair at once gives the same as one by one.

Long pre-tokens would need very many rounds over all their symbols. These are merged rank by
rank in all of them together, and only the neighbours of merged places are looked at again.

Texts are cut at white space first: a piece with its leading space tokenizes alike wherever
it stands, so counts of pieces met before come from a bounded cache.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

NAME = "byte_bpe_50k.json"
LIMIT = 512
#: Pieces kept per Python worker; beyond, the cache starts anew.
CACHE = 400_000
#: Characters of text handled at a time.
BLOCK = 1 << 21
NEVER = np.iinfo(np.int64).max
#: Bytes from which a pre-token is merged rank by rank.
LONG = 256

#: White space as the tokenizer's pattern sees it. Fixed values.
WHITE = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Letters and numbers up to here have been the same in all Unicode versions in use.
SETTLED = "\u0500"


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Merges:
    """The merge table of a byte-level BPE file, in arrays for whole-batch lookup."""

    def __init__(self, model: dict) -> None:
        vocab = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        self.of_byte = np.array([vocab[c] for c in byte_symbols()], dtype=np.int64)
        codes = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.ranks, self.made = codes[order], order, made[order]

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols that survive in each pre-token; none for an empty one."""
        long = np.fromiter((len(t) >= LONG for t in tokens), dtype=bool, count=len(tokens))
        if not long.any():
            return self._by_rounds(tokens)
        counts = np.zeros(len(tokens), dtype=np.int64)
        counts[long] = self._by_ranks([t for t, own in zip(tokens, long, strict=True) if own])
        counts[~long] = self._by_rounds([t for t, own in zip(tokens, long, strict=True) if not own])
        return counts

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs of symbols, NEVER for unknown ones, and what they make."""
        code = left * self.size + right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.ranks[at], NEVER), self.made[at]

    def _by_ranks(self, tokens: list[bytes]) -> np.ndarray:
        """Lowest rank first over all tokens, places linked to those before and after them."""
        lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        symbols = self.of_byte[np.frombuffer(b"".join(tokens), dtype=np.uint8)]
        n = len(symbols)
        ends = np.cumsum(lengths)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1], before[ends - lengths] = n, -1
        alive = np.ones(n, dtype=bool)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def note(places: np.ndarray) -> None:
            """Remember the places where a known pair begins, by rank."""
            rank, _ = self._pair_ranks(symbols[places], symbols[after[places]])
            order = np.argsort(rank, kind="stable")
            rank, places = rank[order], places[order]
            values, starts = np.unique(rank, return_index=True)
            for value, own in zip(values.tolist(), np.split(places, starts[1:]), strict=True):
                if value != NEVER:
                    if value not in waiting:
                        waiting[value] = []
                        heapq.heappush(ranks, value)
                    waiting[value].append(own)

        note(np.flatnonzero(after < n))
        while ranks:
            lowest = heapq.heappop(ranks)
            places = np.unique(np.concatenate(waiting.pop(lowest)))
            places = places[alive[places] & (after[places] < n)]
            rank, made = self._pair_ranks(symbols[places], symbols[after[places]])
            places, made = places[rank == lowest], made[rank == lowest]
            if not len(places):
                continue
            # Of overlapping occurrences (a pair of equal symbols) every second one merges.
            index = np.arange(len(places))
            first = np.append(True, after[places[:-1]] != places[1:])
            run = np.maximum.accumulate(np.where(first, index, 0))
            chosen = (index - run) % 2 == 0
            places, made = places[chosen], made[chosen]
            gone = after[places]
            beyond = after[gone]
            symbols[places], alive[gone], after[places] = made, False, beyond
            inner = beyond < n
            before[beyond[inner]] = places[inner]
            left = before[places]
            note(np.unique(np.concatenate([left[left >= 0], places[after[places] < n]])))
        owner = np.repeat(np.arange(len(tokens)), lengths)
        return np.bincount(owner[alive], minlength=len(tokens))

    def _by_rounds(self, tokens: list[bytes]) -> np.ndarray:
        lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        counts = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(tokens), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), lengths)
        while len(symbols) > 1:
            code = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            known = (self.codes[at] == code) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(known, self.ranks[at], NEVER), NEVER)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.minimum.reduceat(rank, starts)
            spread = np.repeat(least, np.diff(np.append(starts, len(owner))))
            merged = (rank == spread) & (rank != NEVER)
            # Of overlapping occurrences (a pair of equal symbols) every second one merges.
            index = np.arange(len(merged))
            first = merged & ~np.append(False, merged[:-1])
            run = np.maximum.accumulate(np.where(first, index, 0))
            places = np.flatnonzero(merged & ((index - run) % 2 == 0))
            symbols[places] = self.made[at[places]]
            np.subtract.at(counts, owner[places], 1)
            keep = spread != NEVER
            keep[places + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return counts


class Counter:
    """Token counts of texts; special strings count as one token each, as by default."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.merges = Merges(content["model"])
        special = [t["content"] for t in content["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.cache: dict[str, int] = {}

    def _pre_tokens(self, piece: str) -> list[str]:
        if max(piece) < SETTLED:
            return self.pattern.findall(piece)
        return [piece[a:b] for _, (a, b) in self.library.pre_tokenize_str(piece)]

    def _learn(self, pieces: list[str]) -> None:
        """Count pieces that are not in the cache."""
        split = [self._pre_tokens(p) for p in pieces]
        flat = [t for tokens in split for t in tokens]
        distinct = list(dict.fromkeys(flat))
        encoded = [t.encode("utf-8", "surrogatepass") for t in distinct]
        count = dict(zip(distinct, self.merges.count(encoded).tolist(), strict=True))
        for piece, tokens in zip(pieces, split, strict=True):
            self.cache[piece] = sum(map(count.__getitem__, tokens))

    def _block(self, texts: list[str]) -> list[int]:
        specials = [0] * len(texts)
        if self.special:
            for i, text in enumerate(texts):
                if "<|" in text:
                    specials[i] = len(self.special.findall(text))
        cut = [
            [p for part in self.special.split(t) for p in PIECES.findall(part)]
            if n
            else PIECES.findall(t)
            for t, n in zip(texts, specials, strict=True)
        ]
        if len(self.cache) > CACHE:
            self.cache.clear()
        new = set().union(*cut).difference(self.cache)
        if new:
            self._learn(list(new))
        known = self.cache.__getitem__
        return [n + sum(map(known, pieces)) for n, pieces in zip(specials, cut, strict=True)]

    def count(self, texts: list[str]) -> list[int]:
        counts: list[int] = []
        block, size = [], 0
        for text in texts:
            block.append(text)
            size += len(text)
            if size >= BLOCK:
                counts += self._block(block)
                block, size = [], 0
        return counts + (self._block(block) if block else [])


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def tokenizer_path(name: str) -> str:
    """A file of the public tokenizers by name, any other by its path."""
    return name if "/" in name else public_tokenizers.path(name)


def token_count(tokenizer: str = NAME):
    """A column function: tokens of a text column; nulls count as empty texts."""

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = counter(tokenizer_path(tokenizer))
        for texts in batches:
            yield pd.Series(own.count(["" if t is None else t for t in texts]), dtype="int64")

    return tokens


def op6_token_counts(
    documents: DataFrame, tokenizer: str = NAME, limit: int = LIMIT
) -> DataFrame:
    """A row per document row with its bytes and tokens.

    Null and empty texts have none of either. Repeated rows and rows without id are
    counted one by one.
    """
    return documents.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(tokenizer)(F.col("text")).alias("n_tokens"),
    ).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
