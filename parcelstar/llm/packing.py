"""Best-fit packing of token sequences by exact-complement hashing.

Documents become pieces of at most `capacity` tokens. The plan needs only the number of
pieces of each length, so it is made once on the driver over at most `capacity` numbers,
however many pieces there are. From the longest length down, a piece's gap is looked up
among the lengths themselves, the sums of two and the sums of three; a combination that
fills the gap exactly is used as often as all its lengths are available. What has no exact
complement is packed best-fit, longest first. The plan says which pieces, by their place
among the pieces of their length, go to which sequence and offset.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelstar.llm.token_counts import byte_symbols, tokenizer_path
from parcelstar.operators.ordering import group_positions
from parcelstar.session import write_through

CAPACITY = 4096
NAME = "word_bpe_49k.json"
END_ID = 1
#: Pieces kept per Python worker in each of two generations, about 200 bytes each.
CACHE = 500_000
#: ASCII marks that are never part of a word: no apostrophe, which may begin an ending, and
#: no angle brackets, which may begin a special string.
MARKS = b".,;:!?()[]{}\"*$%&#|-_/\\+=~^@"
#: The last of the Latin letters that no mark can join with and all Unicode versions know.
LATIN = "\u024f"
#: Bytes of text handled at a time.
BLOCK = 1 << 21


class Complements:
    """Lengths with availability counts, looked up by exact sums of one, two and three.

    Counts only fall, so a sum's search goes on from where it last stopped.
    """

    def __init__(self, counts: np.ndarray) -> None:
        self.counts = counts
        n = len(counts)
        self.pair_at = np.arange(n)  # the larger length a pair of this sum may still have
        self.triple_at = np.arange(n)
        self.pair_left = np.ones(n, dtype=bool)

    def _holds(self, lengths: tuple[int, ...]) -> bool:
        return all(self.counts[x] >= lengths.count(x) for x in set(lengths))

    def single(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if self.counts[gap] > 0 else None

    def pair(self, total: int) -> tuple[int, ...] | None:
        if not self.pair_left[total]:
            return None
        top = min(int(self.pair_at[total]), total - 1)
        large = np.arange(top, (total - 1) // 2, -1)
        fits = (self.counts[large] > 0) & (self.counts[total - large] > 0)
        for a in large[fits]:
            if self._holds((int(a), total - int(a))):
                self.pair_at[total] = a
                return int(a), total - int(a)
        self.pair_left[total] = False
        return None

    def triple(self, total: int) -> tuple[int, ...] | None:
        top = min(int(self.triple_at[total]), total - 2)
        large = np.arange(top, 0, -1)
        large = large[(self.counts[large] > 0) & self.pair_left[total - large]]
        for c in map(int, large):
            pair = self.pair(total - c)
            if pair and self._holds((c, *pair)):
                self.triple_at[total] = c
                return c, *pair
        self.triple_at[total] = 0
        return None

    def filling(self, gap: int) -> tuple[int, ...] | None:
        return self.single(gap) or self.pair(gap) or self.triple(gap)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of one sequence) with the number of sequences of each."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns = [((capacity,), int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    index = Complements(left)
    for length in range(capacity - 1, 0, -1):
        while left[length] > 0:
            left[length] -= 1  # the piece whose gap is filled
            found = index.filling(capacity - length)
            left[length] += 1
            if not found:
                break
            whole = (length, *found)
            times = min(int(left[x]) // whole.count(x) for x in set(whole))
            for x in whole:
                left[x] -= times
            patterns.append((whole, times))
    return patterns + _best_fit(left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each to the fullest open sequence that still has room.

    Sequences of one pattern are kept together with their number, by free room.
    """
    rooms: list[int] = []
    opened: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(pattern: tuple[int, ...], room: int, times: int) -> None:
        if room not in opened:
            insort(rooms, room)
            opened[room] = []
        opened[room].append((pattern, times))

    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = min(capacity // length, n)
                put((length,) * each, capacity - each * length, n // each)
                n %= each
                continue
            room = rooms[at]
            pattern, times = opened[room].pop()
            if not opened[room]:
                del opened[room], rooms[at]
            each = min(room // length, n)
            used = min(times, n // each)
            if used < times:
                put(pattern, room, times - used)
            put(pattern + (length,) * each, room - each * length, used)
            n -= used * each
    return [p for room in sorted(opened) for p in opened[room]]


class Encoder(dict):
    """Ids of a piece between white space, as little-endian uint32 bytes.

    The tokenizer drops white space and cuts between letters and punctuation, so a text's
    ids are those of its pieces, and a piece's those of the marks before its word, of the
    word, and of the marks behind. Such words and marks are single pre-tokens and go to the
    library's merge model; pieces of any other form go through the whole tokenizer.

    As a dictionary it is a bounded cache of two generations: a piece met again moves from
    the older to the younger one.
    """

    def __init__(self, path: str, size: int = CACHE) -> None:
        super().__init__()
        self.size = size
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.older: dict[bytes, bytes] = {}
        self.marks: dict[bytes, bytes] = {b"": b""}

    def __missing__(self, piece: bytes) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = self._encoded(piece)
        self[piece] = found
        return found

    def _merged(self, symbols: str) -> bytes:
        return _packed([t.id for t in self.model.tokenize(symbols)])

    def _of_marks(self, marks: bytes) -> bytes:
        if marks not in self.marks:
            if len(self.marks) > 10_000:
                self.marks = {b"": b""}
            self.marks[marks] = self._merged(marks.decode())
        return self.marks[marks]

    def _encoded(self, piece: bytes) -> bytes:
        word = piece.strip(MARKS)
        symbols = _symbols(word)
        if not symbols:
            text = piece.decode("utf-8", "replace")
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(word) == len(piece):
            return self._merged(symbols)
        at = piece.index(word)
        before, after = self._of_marks(piece[:at]), self._of_marks(piece[at + len(word) :])
        return before + self._merged(symbols) + after

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self) > self.size:
            self.older = dict(self)
            self.clear()
        known = self.__getitem__
        return [b"".join(map(known, t.split())) for t in texts]


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


#: Character of the byte-level alphabet for each byte of a Latin letter in UTF-8.
_BYTE_SYMBOLS = {b: c for b, c in enumerate(byte_symbols()) if ord(c) != b}


def _symbols(word: bytes) -> str:
    """A word of Latin letters as the tokenizer's symbols; empty for any other."""
    if word.isascii():
        return word.lower().decode() if word.isalpha() else ""
    text = word.decode("utf-8", "replace")
    if not text.isalpha() or max(text) > LATIN or "\u0130" in text:  # one that gains a mark
        return ""
    return text.lower().encode().decode("latin-1").translate(_BYTE_SYMBOLS)


@lru_cache(maxsize=1)
def encoder(path: str, size: int = CACHE) -> Encoder:
    return Encoder(path, size)


PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(
    documents: DataFrame,
    tokenizer: str = NAME,
    capacity: int = CAPACITY,
    end: int = END_ID,
    cache: int = CACHE,
) -> DataFrame:
    """Pieces of every document: its ids and the end id, cut after each `capacity` ids.

    `cache` bounds the pieces of text whose ids a worker keeps; it trades memory for time.
    """
    tail = np.array([end], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path(tokenizer), cache)
        width = 4 * capacity

        def rows(ids: list, texts: list[bytes]) -> pa.RecordBatch:
            out: list[tuple] = []
            for doc_id, encoded in zip(ids, own.encode(texts), strict=True):
                whole = encoded + tail
                for piece, at in enumerate(range(0, len(whole), width)):
                    part = whole[at : at + width]
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

        for batch in batches:
            ids, texts = [], []
            size = 0
            for doc_id, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                ids.append(doc_id)
                texts.append(text or b"")
                size += len(texts[-1])
                if size >= BLOCK:
                    yield rows(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield rows(ids, texts)

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    ).mapInArrow(cut, PIECE_SCHEMA)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` with the sequence and the offset each goes to.

    The plan gives each length intervals of places: the pieces from `first` on take the
    sequences from `sequence` on, at one offset.
    """
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    steps: dict[int, int] = {}
    intervals = []
    sequence = 0
    for pattern, times in plan(counts, capacity):
        offset = 0
        for length in pattern:
            first = steps.get(length, 0)
            intervals.append((length, first, sequence, offset))
            steps[length] = first + times
            offset += length
        sequence += times
    table = np.array(sorted(intervals), dtype=np.int64).reshape(-1, 4)
    firsts = table[:, 0].astype(np.float64) * 2.0**40 + table[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def slot(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for length, rank in batches:
            wanted = length.to_numpy() * 2.0**40 + rank.to_numpy()
            row = table[np.searchsorted(firsts, wanted, side="right") - 1]
            yield pd.DataFrame(
                {"sequence_id": row[:, 2] + rank.to_numpy() - row[:, 1], "offset": row[:, 3]}
            )

    ranked = group_positions(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "rank")
    return ranked.withColumn("_slot", slot("length", "rank")).select(
        *pieces.columns, "_slot.sequence_id", "_slot.offset"
    )


def op7_best_fit_packing(documents: DataFrame, cache: int = CACHE) -> DataFrame:
    """A row per piece of every document row.

    Null and empty texts are one piece, the end id alone. Rows without id and repeated rows
    are packed one by one. An empty table has no pieces.
    """
    return place(write_through(pieces_of(documents, cache=cache), "pieces"))
