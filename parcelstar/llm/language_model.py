"""Language-model scoring with an Elias-Fano trie of words and word pairs.

Level one holds the words, as sorted 64-bit hashes; a word's id is its place among them.
Level two holds, for each word, the words seen after it: monotone pointers lead from a word
to its successors, whose ids, relative to their context, form a monotone sequence too. A pair
is found by a successor search within its context. Sequences and pointers are Elias-Fano
coded, quantised smoothed probabilities take two bytes each. The levels are cut into shards of bounded
size, each built by one task and written to the shared folder, and memory-mapped by the
tasks that score: a machine holds the pages it looks at.

p(w | u) = max(c(u, w) - D, 0) / c(u) + D * successors(u) / c(u) * p(w) with add-one p(w);
after a word that was never seen, p(w). The end of a text is a word, and stands before the
first word of a text.
"""

from __future__ import annotations

import math
import tempfile
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstar.llm.elias_fano import EliasFano, encode
from parcelstar.session import scratch_path, write_through

END = b"\n"  # no word holds white space
DISCOUNT = 0.75
FOLDS, HELD_OUT = 7, 2
#: Words and tokens of one shard.
WORDS_PER_SHARD, TOKENS_PER_SHARD = 1 << 19, 1 << 20
#: First bits of a word's hash that tell the pieces in which tasks hand on their counts.
PIECE_BITS = 10
#: Words kept per Python worker; beyond, its cache starts anew.
CACHE = 400_000
#: Bytes of text scored, and pairs counted, at a time.
BLOCK, PAIRS = 1 << 22, 1 << 22
#: Steps of a quantised log probability, two bytes.
STEPS = 1 << 16


class Model(NamedTuple):
    """What a task must know to open the shards; a few numbers per shard."""

    path: str
    hash_bits: int  # a word's shard is the first bits of its hash
    word_bases: list[int]  # id of the first word of each shard
    n_words: int
    n_tokens: int
    end_id: int
    n_bounds: int  # entries of the files that tell how pairs are dealt into shards
    n_split: int


# --- files -------------------------------------------------------------------------------


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1)) if "://" in path else (
        fs.LocalFileSystem(),
        path,
    )


def _write(path: str, words: np.ndarray) -> None:
    """A whole file or none: a repeated task replaces it by the same."""
    store, name = _opened(path)
    draft = f"{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        out.write(memoryview(np.ascontiguousarray(words)).cast("B"))
    store.move(draft, name)


@lru_cache(maxsize=4096)
def _mapped(path: str) -> np.ndarray:
    """The words of a file, memory-mapped; one from afar gets a local copy without a name."""
    store, name = _opened(path)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(name, dtype=np.uint64, mode="r").view(np.ndarray)
    with tempfile.NamedTemporaryFile() as local:
        with store.open_input_stream(name) as source:
            while block := source.read(1 << 24):
                local.write(block)
        local.flush()
        return np.memmap(local.name, dtype=np.uint64, mode="r").view(np.ndarray)


# --- lists that grow with the corpus: files, mapped like the levels ------------------------


def _listed(model: Model, name: str, n: int) -> np.ndarray:
    return _mapped(f"{model.path}/{name}") if n else np.zeros(0, np.uint64)


def _bounds(model: Model) -> np.ndarray:
    """First pair code of each shard of pairs, from the second on."""
    return _listed(model, "bounds", model.n_bounds)


def _split(model: Model) -> np.ndarray:
    """Sorted ids of the words whose pairs lie in several shards."""
    return _listed(model, "split", model.n_split).view(np.int64)


def _split_successors(model: Model, ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many different words follow the split ones of `ids`; `others` for the rest."""
    several = _split(model)
    if not len(several):
        return others
    totals = _listed(model, "split-successors", model.n_split).view(np.int64)
    place = np.minimum(np.searchsorted(several, ids), len(several) - 1)
    return np.where(several[place] == ids, totals[place], others)


# --- level one: words --------------------------------------------------------------------


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


class Words:
    """A shard of words: sorted hashes and running totals of their counts."""

    def __init__(self, path: str) -> None:
        words = _mapped(path)
        self.hashes = EliasFano(words)
        self.totals = EliasFano(words[self.hashes.length :])

    @staticmethod
    def write(path: str, hashes: np.ndarray, counts: np.ndarray, universe: int) -> None:
        totals = np.concatenate([[0], np.cumsum(counts)])
        _write(path, np.concatenate([encode(hashes, universe), encode(totals, int(totals[-1]) + 1)]))

    def counts(self, i: np.ndarray) -> np.ndarray:
        return (self.totals.get(i + 1) - self.totals.get(i)).astype(np.int64)


@lru_cache(maxsize=4096)
def _words(path: str) -> Words:
    return Words(path)


def _word_path(model_path: str, shard: int) -> str:
    return f"{model_path}/words-{shard:06d}"


def find_words(model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids (-1 if unknown) and counts of words by hash."""
    ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
    rest = 64 - model.hash_bits
    shards = (hashes >> np.uint64(rest)).astype(np.int64) if model.hash_bits else np.zeros(len(hashes), np.int64)
    for shard in np.unique(shards).tolist():
        if model.word_bases[shard] == model.word_bases[shard + 1]:
            continue
        own = np.flatnonzero(shards == shard)
        level = _words(_word_path(model.path, shard))
        place, found = level.hashes.successor(hashes[own] & np.uint64((1 << rest) - 1))
        own, place = own[found], place[found]
        ids[own] = model.word_bases[shard] + place
        counts[own] = level.counts(place)
    return ids, counts


def counts_of_ids(model: Model, ids: np.ndarray) -> np.ndarray:
    counts = np.zeros(len(ids), np.int64)
    shards = np.searchsorted(model.word_bases, ids, side="right") - 1
    for shard in np.unique(shards).tolist():
        own = np.flatnonzero(shards == shard)
        level = _words(_word_path(model.path, shard))
        counts[own] = level.counts(ids[own] - model.word_bases[shard])
    return counts


# --- level two: pairs --------------------------------------------------------------------


class Pairs:
    """A shard of pairs: pointers of its contexts, their successors, and probabilities."""

    def __init__(self, path: str) -> None:
        words = _mapped(path)
        self.n, self.first, self.contexts = (int(x) for x in words[:3])
        self.low, self.step = words[3:5].view(np.float64).tolist()
        at = 5
        self.pointers = EliasFano(words[at:])
        at += self.pointers.length
        self.successors = EliasFano(words[at:])
        self.codes = words[at + self.successors.length :].view(np.uint16)

    @staticmethod
    def write(path: str, model: Model, codes: np.ndarray, log_p: np.ndarray) -> None:
        """`codes` (context id * words + word id) are sorted and distinct."""
        contexts = (codes // np.uint64(model.n_words)).astype(np.int64)
        first, span = int(contexts[0]), int(contexts[-1] - contexts[0]) + 1
        pointers = np.searchsorted(contexts, np.arange(first, first + span + 1))
        scale, quantised = _quantised(log_p)
        relative = codes - np.uint64(first * model.n_words)
        padded = np.concatenate([quantised, np.zeros(-len(quantised) % 4, np.uint16)])
        _write(
            path,
            np.concatenate(
                [
                    np.array([len(codes), first, span], np.uint64),
                    scale.view(np.uint64),
                    encode(pointers, len(codes) + 1),
                    encode(relative, span * model.n_words),
                    padded.view(np.uint64),
                ]
            ),
        )

    def n_successors(self, contexts: np.ndarray) -> np.ndarray:
        place = contexts - self.first
        inside = (place >= 0) & (place < self.contexts)
        place = np.where(inside, place, 0)
        n = self.pointers.get(place + 1).astype(np.int64) - self.pointers.get(place).astype(np.int64)
        return np.where(inside, n, 0)

    def find(self, relative: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probabilities of pairs by context-relative code, and which were found."""
        place, found = self.successors.successor(relative)
        return self.low + self.step * self.codes[np.where(found, place, 0)], found


def _quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest value and step of STEPS even steps up to the highest, and each value's step."""
    low = float(values.min())
    step = max(float(values.max()) - low, 1e-9) / (STEPS - 1)
    return np.array([low, step]), np.rint((values - low) / step).astype(np.uint16)


@lru_cache(maxsize=4096)
def _pairs(path: str) -> Pairs:
    return Pairs(path)


def _pair_path(model_path: str, shard: int) -> str:
    return f"{model_path}/pairs-{shard:06d}"


def _pair_shards(model: Model, codes: np.ndarray) -> np.ndarray:
    return np.searchsorted(_bounds(model), codes, side="right")


def _several(model: Model, shards: np.ndarray) -> np.ndarray:
    """Whether shards of pairs hold a part of a split word; such a word begins a shard."""
    first = _split(model).view(np.uint64) * np.uint64(model.n_words)
    if not len(first):
        return np.zeros(len(shards), bool)
    begins = _pair_shards(model, first)
    ends = _pair_shards(model, first + np.uint64(model.n_words - 1))
    place = np.searchsorted(begins, shards, side="right") - 1
    return (place >= 0) & (shards <= ends[np.maximum(place, 0)])


def pair_codes(model: Model, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first.astype(np.uint64) * np.uint64(model.n_words) + second.astype(np.uint64)


def find_pairs(model: Model, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 p of pairs of known words by sorted codes, and which were seen."""
    log_p, seen = np.zeros(len(codes)), np.zeros(len(codes), bool)
    shards = _pair_shards(model, codes)
    edges = np.flatnonzero(np.diff(shards)) + 1
    for lower, upper in zip([0, *edges.tolist()], [*edges.tolist(), len(codes)], strict=True):
        level = _pairs_or_none(model, int(shards[lower])) if upper > lower else None
        if level is None:
            continue
        start = level.first * model.n_words
        a, b = np.searchsorted(
            codes[lower:upper],
            np.array([start, start + level.contexts * model.n_words], dtype=np.uint64),
        ) + lower
        log_p[a:b], seen[a:b] = level.find(codes[a:b] - np.uint64(start))
    return log_p, seen


@lru_cache(maxsize=4096)
def _exists(path: str) -> bool:
    store, name = _opened(path)
    return store.get_file_info(name).type == fs.FileType.File


def _pairs_or_none(model: Model, shard: int) -> Pairs | None:
    path = _pair_path(model.path, shard)
    return _pairs(path) if _exists(path) else None


def successors(model: Model, ids: np.ndarray) -> np.ndarray:
    """How many different words were seen after each known word."""
    n = np.zeros(len(ids), np.int64)
    shards = _pair_shards(model, ids.astype(np.uint64) * np.uint64(model.n_words))
    for shard in np.unique(shards).tolist():
        own = np.flatnonzero(shards == shard)
        # A context may begin in the shard after the one its first code falls into.
        level = _pairs_or_none(model, shard)
        if level is not None:
            n[own] = level.n_successors(ids[own])
    return _split_successors(model, ids, n)


# --- passes over the texts ---------------------------------------------------------------


def in_training(doc_id) -> bool:
    """By the id as text; a row without id counts as an empty one."""
    text = "" if doc_id is None else str(doc_id)
    return zlib.crc32(text.encode()) % FOLDS != HELD_OUT


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of documents, about BLOCK bytes of text at a time."""
    for batch in batches:
        ids, words, size = [], [], 0
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for doc_id, text in zip(
                part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True
            ):
                ids.append(doc_id)
                words.append((text or b"").lower().split())
                size += len(text or b"")
                if size >= BLOCK:
                    yield ids, words
                    ids, words, size = [], [], 0
        if ids:
            yield ids, words


def _narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.uint8 if counts.max() < 256 else np.uint64)


def _widened(counts: bytes, n: int) -> np.ndarray:
    """The counts of `n` entries, whose width follows from the length."""
    kind = np.uint8 if len(counts) == n else np.uint64
    return np.frombuffer(counts, dtype=kind).astype(np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the totals of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[starts], np.add.reduceat(counts, starts)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flushed() -> pa.RecordBatch:
        n = len(counts)
        hashes = np.fromiter(map(word_hash, counts), dtype=np.uint64, count=n)
        numbers = np.fromiter(counts.values(), dtype=np.int64, count=n)
        counts.clear()
        order = np.argsort(hashes)
        hashes, numbers = hashes[order], numbers[order]
        pieces = (hashes >> np.uint64(64 - PIECE_BITS)).astype(np.int32)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(pieces)) + 1, [n]]).tolist()
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(pieces[cuts[:-1]]),
                pa.array([b - a for a, b in spans], type=pa.int64()),
                pa.array([hashes[a:b].tobytes() for a, b in spans], type=pa.binary()),
                pa.array([_narrow(numbers[a:b]).tobytes() for a, b in spans], type=pa.binary()),
            ],
            names=["piece", "entries", "hashes", "counts"],
        )

    for ids, words in _blocks(batches):
        texts = [own for i, own in zip(ids, words, strict=True) if in_training(i)]
        if texts:
            counts.update(chain.from_iterable(texts))
            counts[END] += len(texts)
        if len(counts) > CACHE:
            yield flushed()
    if counts:
        yield flushed()


class Places(dict):
    """Place of each word met, a new one the next place; new ones are listed in order."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        return place


class Lexicon:
    """Words met by a worker, with id, count and what scoring needs, in arrays."""

    def __init__(self, model: Model, scoring: bool) -> None:
        self.model, self.scoring = model, scoring
        self.clear()

    def clear(self) -> None:
        self.index = Places()
        self.ids = np.zeros(0, np.int64)
        self.log_p = np.zeros(0)
        self.log_rest = np.zeros(0)
        self.places([[]])

    def places(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Places of all words in the arrays, an end after each text; and text lengths."""
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
        for words in texts:
            words.append(END)
        places = np.fromiter(
            map(self.index.__getitem__, chain.from_iterable(texts)),
            dtype=np.int64,
            count=int(lengths.sum()),
        )
        if self.index.new:
            self._learn(self.index.new)
            self.index.new = []
        return places, lengths

    def _learn(self, words: list[bytes]) -> None:
        hashes = np.fromiter(map(word_hash, words), dtype=np.uint64, count=len(words))
        ids, counts = find_words(self.model, hashes)
        self.ids = np.concatenate([self.ids, ids])
        if not self.scoring:
            return
        total = self.model.n_tokens + self.model.n_words + 1
        self.log_p = np.concatenate([self.log_p, np.log10((counts + 1) / total)])
        rest = np.ones(len(words))
        known = np.flatnonzero(ids >= 0)
        rest[known] = DISCOUNT * successors(self.model, ids[known]) / counts[known]
        self.log_rest = np.concatenate([self.log_rest, np.log10(np.maximum(rest, 1e-300))])


@lru_cache(maxsize=2)
def _lexicon(path: str, scoring: bool) -> Lexicon | None:
    return Lexicon(_models[path], scoring)


_models: dict[str, Model] = {}


def lexicon(model: Model, scoring: bool) -> Lexicon:
    _models[model.path] = model
    return _lexicon(model.path, scoring)


def _previous(places: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """For each word the one before it; an end before the first word of a text."""
    before = np.empty_like(places)
    before[1:] = places[:-1]
    before[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = end
    return before


def _counting(model: Model):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted pair codes and their counts, a row per shard each time enough are met."""
        own = lexicon(model, scoring=False)
        held: list[np.ndarray] = []
        size = 0
        for ids, words in _blocks(batches):
            texts = [w for i, w in zip(ids, words, strict=True) if in_training(i)]
            if not texts:
                continue
            if len(own.index) > CACHE:
                own.clear()
            places, lengths = own.places(texts)
            second = own.ids[places]
            first = own.ids[_previous(places, lengths, own.index[END])]
            held.append(pair_codes(model, first, second))
            size += len(second)
            if size >= PAIRS:
                yield _rows_of_pairs(model, np.concatenate(held))
                held, size = [], 0
        if size:
            yield _rows_of_pairs(model, np.concatenate(held))

    return count


def _rows_of_pairs(model: Model, codes: np.ndarray) -> pa.RecordBatch:
    codes, counts = np.unique(codes, return_counts=True)
    shards = _pair_shards(model, codes)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(shards)) + 1, [len(codes)]])
    several = _several(model, shards[cuts[:-1]]).tolist()
    rows = []
    for a, b, part in zip(cuts[:-1].tolist(), cuts[1:].tolist(), several, strict=True):
        steps = np.diff(codes[a:b])
        narrow = not len(steps) or int(steps.max()) < 1 << 32
        n = counts[a:b]
        rows.append(
            (
                int(shards[a]),
                int(codes[a]),
                steps.astype(np.uint32 if narrow else np.uint64).tobytes(),
                _narrow(n).tobytes(),
                part,
            )
        )
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)],
        names=["shard", "first", "steps", "counts", "several"],
    )


def _codes_of_row(first: int, steps: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The codes and counts of a row; the width of an entry follows from the lengths."""
    n = len(counts) if len(steps) in (4 * (len(counts) - 1), 8 * (len(counts) - 1)) else len(counts) // 8
    width = np.uint32 if len(steps) == 4 * (n - 1) else np.uint64
    codes = np.empty(n, np.uint64)
    codes[0] = first
    codes[1:] = np.frombuffer(steps, dtype=width)
    return np.cumsum(codes, dtype=np.uint64), _widened(counts, n)


def _building(model: Model):
    def build(frame: pd.DataFrame) -> pd.DataFrame:
        """Write one shard of pairs; tells how many successors its outer contexts have."""
        parts = [
            _codes_of_row(*row)
            for row in zip(frame["first"], frame["steps"], frame["counts"], strict=True)
        ]
        codes, counts = _summed(*(np.concatenate(side) for side in zip(*parts, strict=True)))
        first = (codes // np.uint64(model.n_words)).astype(np.int64)
        second = (codes % np.uint64(model.n_words)).astype(np.int64)
        contexts, at = np.unique(first, return_inverse=True)
        here = np.bincount(at)
        of_context = counts_of_ids(model, contexts)
        distinct, place = np.unique(second, return_inverse=True)
        of_word = counts_of_ids(model, distinct)[place]
        n_after = _split_successors(model, contexts, here)
        p = (of_word + 1) / (model.n_tokens + model.n_words + 1)
        total = of_context[at]
        log_p = np.log10(np.maximum(counts - DISCOUNT, 0) / total + DISCOUNT * n_after[at] / total * p)
        shard = int(frame["shard"].iloc[0])
        Pairs.write(_pair_path(model.path, shard), model, codes, log_p)
        return pd.DataFrame({"shard": [shard], "n": [len(codes)]})

    return build


def _outer(model: Model):
    def outer(frame: pd.DataFrame) -> pd.DataFrame:
        """How many successors contexts that are split over shards have in one of them."""
        codes = np.unique(
            np.concatenate(
                [
                    _codes_of_row(*row)[0]
                    for row in zip(frame["first"], frame["steps"], frame["counts"], strict=True)
                ]
            )
        )
        first = (codes // np.uint64(model.n_words)).astype(np.int64)
        contexts, n = np.unique(first, return_counts=True)
        own = np.isin(contexts, _split(model))
        return pd.DataFrame({"context": contexts[own], "n": n[own]})

    return outer


def _cutting(bits: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of word counts cut by more bits of the hash than they came with."""
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                hashes = np.frombuffer(row["hashes"], dtype=np.uint64)
                width = len(row["counts"]) // len(hashes)
                shards = (hashes >> np.uint64(64 - bits)).astype(np.int64)
                cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(hashes)]
                rows += [
                    (int(shards[a]), b - a, row["hashes"][8 * a : 8 * b], row["counts"][width * a : width * b])
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True)
                ]
            if rows:
                columns = zip(*rows, strict=True)
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)],
                    names=["shard", "entries", "hashes", "counts"],
                )

    return cut


# --- training and scoring ----------------------------------------------------------------


def _source(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.col("text").cast("binary").alias("text"))


def _train_words(documents: DataFrame, path: str) -> tuple[Model, list[tuple[int, int]]]:
    """Level one; also the heavy words (id, count), which fill shards of pairs alone."""
    pieces = write_through(
        _source(documents).mapInArrow(
            _word_counts, "piece int, entries long, hashes binary, counts binary"
        ),
        "words",
    )
    entries = pieces.agg(F.sum("entries")).collect()[0][0] or 0
    # A word comes as an entry from several tasks; a shard is built from a bounded number.
    bits = math.ceil(math.log2(max(1, entries / (4 * WORDS_PER_SHARD))))
    rest = 64 - bits
    if bits > PIECE_BITS:
        parts = pieces.mapInArrow(
            _cutting(bits), "shard int, entries long, hashes binary, counts binary"
        )
    else:
        parts = pieces.withColumn("shard", F.shiftright("piece", PIECE_BITS - bits))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        hashes = np.concatenate([np.frombuffer(h, dtype=np.uint64) for h in frame["hashes"]])
        counts = np.concatenate(
            [_widened(c, n) for c, n in zip(frame["counts"], frame["entries"], strict=True)]
        )
        hashes, counts = _summed(hashes, counts)
        number = int(frame["shard"].iloc[0])
        own = hashes & np.uint64((1 << rest) - 1)
        Words.write(_word_path(path, number), own, counts, 1 << rest)
        heavy = counts > TOKENS_PER_SHARD / 2
        return pd.DataFrame(
            {
                "shard": [number],
                "n": [len(hashes)],
                "total": [int(counts.sum())],
                "heavy": [hashes[heavy].view(np.int64)],
            }
        )

    shards = (
        parts.groupBy("shard")
        .applyInPandas(build, "shard int, n long, total long, heavy array<long>")
        .collect()  # a row per shard, with less than two heavy words for each shard of pairs
    )
    sizes = {r["shard"]: r["n"] for r in shards}
    bases = [0]
    for s in range(1 << bits):
        bases.append(bases[-1] + sizes.get(s, 0))
    model = Model(path, bits, bases, bases[-1], sum(r["total"] for r in shards), -1, 0, 0)
    if not model.n_words:
        return model, []
    heavy = np.array([h for r in shards for h in r["heavy"]], dtype=np.int64).view(np.uint64)
    ids, of_ids = find_words(model, heavy)
    end = find_words(model, np.array([word_hash(END)], dtype=np.uint64))[0]
    return model._replace(end_id=int(end[0])), list(zip(ids.tolist(), of_ids.tolist(), strict=True))


def _pair_bounds(model: Model, heavy: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Where shards of pairs begin, and the words whose pairs lie in several.

    Ids follow hashes, so equal ranges of ids hold about equally many tokens but for heavy
    words. Those get ranges of their own, cut by the second word where they are large.
    """
    n = model.n_words
    shards = max(1, math.ceil(model.n_tokens / TOKENS_PER_SHARD))
    starts = [np.arange(1, shards, dtype=np.uint64) * np.uint64(n) // np.uint64(shards) * np.uint64(n)]
    split = []
    for word, count in heavy:
        pieces = math.ceil(count / TOKENS_PER_SHARD)
        within = np.arange(pieces, dtype=np.uint64) * np.uint64(n) // np.uint64(pieces)
        starts.append(np.append(within, np.uint64(n)) + np.uint64(word * n))
        if pieces > 1:
            split.append(word)
    every = np.unique(np.concatenate(starts))
    return every[(every > 0) & (every < n * n)], np.array(sorted(split), dtype=np.uint64)


def train(documents: DataFrame) -> Model:
    """The trie over the documents in training, as shards below the shared folder.

    Every word and pair of them is counted and kept, so the model grows with the corpus.
    """
    path = scratch_path(documents.sparkSession, "ngrams")
    store, name = _opened(path)
    store.create_dir(name)
    model, heavy = _train_words(documents, path)
    if not model.n_words:
        return model
    bounds, split = _pair_bounds(model, heavy)
    for name, numbers in (("bounds", bounds), ("split", split)):
        if len(numbers):
            _write(f"{path}/{name}", numbers)
    model = model._replace(n_bounds=len(bounds), n_split=len(split))
    pairs = write_through(
        _source(documents).mapInArrow(
            _counting(model),
            "shard int, first long, steps binary, counts binary, several boolean",
        ),
        "pairs",
    )
    if len(split):
        rows = pairs.where("several").groupBy("shard").applyInPandas(_outer(model), "context long, n long")
        totals = dict(rows.groupBy("context").agg(F.sum("n")).collect())  # a row per split word
        _write(f"{path}/split-successors", np.array([totals[i] for i in split.tolist()], dtype=np.uint64))
    pairs.groupBy("shard").applyInPandas(_building(model), "shard int, n long").agg(
        F.sum("n")
    ).collect()
    return model


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """A row per document row with its log10 probability under the model and the base."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lexicon(model, scoring=True)
        for ids, words in _blocks(batches):
            if len(own.index) > CACHE:
                own.clear()
            places, lengths = own.places(words)
            before = _previous(places, lengths, own.index[END])
            base = own.log_p[places]
            log_p = own.log_rest[before] + base
            known = own.ids[places] >= 0
            both = np.flatnonzero(known & (own.ids[before] >= 0))
            # Each pair is looked up once, in order: neighbours lie on the same pages.
            codes = pair_codes(model, own.ids[before[both]], own.ids[places[both]])
            codes, back = np.unique(codes, return_inverse=True)
            found, seen = find_pairs(model, codes)
            found, seen = found[back], seen[back]
            log_p[both[seen]] = found[seen]
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, type=pa.int64()),
                    pa.array([not in_training(i) for i in ids]),
                    pa.array(lengths),
                    pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                    pa.array(np.full(len(ids), model.n_tokens)),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(np.add.reduceat(log_p, starts)),
                ],
                names=[part.split()[0] for part in SCORES.split(", ")],
            )

    return _source(documents).mapInArrow(scored, SCORES)


def op10_lm_scoring(documents: DataFrame) -> DataFrame:
    """Scores of all documents by a model of those in training.

    Null and empty texts are the end alone. Rows without id are in training. Repeated rows
    count and are scored one by one. Without any document in training, every word is
    unknown and has the probability of an empty model, 1.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(documents, train(documents))
