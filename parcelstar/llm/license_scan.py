"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

Templates keep the least k-gram hash of each window of WINDOW k-grams in an inverted index
from hash to template and place. A document is winnowed alike, so a run of K + WINDOW - 1
words in common gives a hit. Hits of one template near one diagonal are aligned with the
text around them, word by word within a band of that diagonal, which reports the words that
match, the share of the template they cover, and where they lie.

Templates of like wording, as of two versions, name word runs that tell them apart, of which
a match must have all. Each place of such a run is a candidate, so these templates need no
fingerprints, and short ones are found by whatever words they share besides. Of matches that
lie on the same words the best is reported.

The index holds the templates alone, a set fixed by the caller; its size is checked before
it is sent to the tasks. Each document is scanned where it is read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstar.llm.license_texts import REQUIRED, SIDE, TEMPLATES
from parcelstar.llm.shingles import mixed

K, WINDOW = 3, 3
#: Least share of a template's words that a reported alignment matches.
COVERAGE = 0.75
#: Templates up to this many words are indexed by every k-gram.
SHORT_WORDS = 16
#: Words that may be missing or extra: this many and a tenth of the template.
BAND = 4
#: Score of a match, a mismatch and a skipped word.
MATCH, MISMATCH, SKIP = 2, -1, -1
#: Words of a stretch that matches are looked up by.
STRETCH = 64
#: Words of all templates up to which the index is sent to every task, about 100 MB.
MOST_WORDS = 2_000_000

#: ASCII letters and digits in lower case, bytes beyond ASCII as they are, others a space.
_WORD_BYTES = bytes(
    (b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


class Match(NamedTuple):
    template: str
    matched: int  # words of the template that match
    coverage: float
    first: int  # span of words in the document
    last: int


def license_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


def _grams(ids: np.ndarray, k: int) -> np.ndarray:
    state = np.zeros(max(0, len(ids) - k + 1), np.uint64)
    for i in range(k):
        state = mixed(state, ids[i : i + len(state)].astype(np.uint64))
    return state


def winnowed(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places that are the least of a window, with ties; of all if there are fewer."""
    if len(hashes) <= window:
        return np.flatnonzero(hashes == hashes.min()) if len(hashes) else np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, window)
    chosen = windows == windows.min(axis=1)[:, None]
    at, offset = np.nonzero(chosen)
    return np.unique(at + offset)


class Index:
    """Templates as word ids, and the inverted index of their fingerprints."""

    def __init__(
        self, templates: dict[str, str], required: dict[str, list[list[str]]] | None = None
    ) -> None:
        required = REQUIRED if required is None else required
        words = {name: license_words(text.encode()) for name, text in templates.items()}
        total = sum(map(len, words.values()))
        if total > MOST_WORDS:
            raise ValueError(f"templates of {total} words; scan for {MOST_WORDS} at a time")
        self.names = [name for name in sorted(words) if len(words[name]) >= K]
        runs = {
            name: [[run.encode().split() for run in group] for group in required.get(name, [])]
            for name in self.names
        }
        vocabulary = sorted(
            {w for own in words.values() for w in own}
            | {w for own in runs.values() for group in own for run in group for w in run}
        )
        self.ids = {w: i + 1 for i, w in enumerate(vocabulary)}  # 0 for all other words
        self.templates = [
            np.array([self.ids[w] for w in words[name]], dtype=np.int64) for name in self.names
        ]
        #: By template: groups of runs, each as text of word ids.
        self.runs = [
            [[_shown(self.ids[w] for w in run) for run in group] for group in runs[name]]
            for name in self.names
        ]
        self._index_runs([runs[name] for name in self.names])
        entries: list[tuple[int, int, int]] = []
        short: list[tuple[int, int, int]] = []
        for number, template in enumerate(self.templates):
            if self.runs[number]:
                continue
            grams = _grams(template, K)
            if len(template) <= SHORT_WORDS:
                short += [(int(g), number, p) for p, g in enumerate(grams)]
            else:
                entries += [(int(grams[p]), number, int(p)) for p in winnowed(grams, WINDOW)]
        self.winnowed = _sorted(entries)
        self.short = _sorted(short)

    def _index_runs(self, runs: list[list[list[list[bytes]]]]) -> None:
        """Runs of each first group by their rarest word, with their places in the template."""
        count = np.bincount(np.concatenate([*self.templates, [0]]), minlength=len(self.ids) + 1)
        self.anchors: dict[int, list[tuple[int, int, list[int], list[int]]]] = defaultdict(list)
        for number, groups in enumerate(runs):
            places: list[int] = []
            for run in groups[0] if groups else []:
                own = [self.ids[w] for w in run]
                template = self.templates[number].tolist()
                here = [
                    p for p in range(len(template)) if template[p : p + len(own)] == own
                ]
                places = places or here
                offset = min(range(len(own)), key=lambda i: count[own[i]] or len(self.ids))
                self.anchors[own[offset]].append((number, offset, own, here or places or [0]))
        self.is_anchor = np.zeros(len(self.ids) + 1, bool)
        self.is_anchor[list(self.anchors)] = True

    def hits(self, words: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """By template: (place in the document, place in the template), sorted."""
        found: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for at in np.flatnonzero(self.is_anchor[words]).tolist():
            for number, offset, run, places in self.anchors[int(words[at])]:
                first = at - offset
                if first >= 0 and words[first : first + len(run)].tolist() == run:
                    found[number].update((first, place) for place in places)
        if len(words) >= K:
            grams = _grams(words, K)
            every = np.arange(len(grams))
            for (hashes, entries), own in (
                (self.winnowed, winnowed(grams, WINDOW)),
                (self.short, every),
            ):
                if not len(hashes):
                    continue
                start = np.searchsorted(hashes, grams[own], side="left")
                stop = np.searchsorted(hashes, grams[own], side="right")
                for i in np.flatnonzero(stop > start).tolist():
                    for number, place in entries[start[i] : stop[i]]:
                        found[number].add((int(own[i]), place))
        return {number: sorted(places) for number, places in found.items()}

    def scan(self, text: bytes | None, coverage: float = COVERAGE) -> list[Match]:
        """The best matches of all templates, by their place in the document."""
        known = self.ids.get
        words = np.array([known(w, 0) for w in license_words(text)], dtype=np.int64)
        found = self.hits(words)
        if not found:
            return []
        places = _Places(words)
        matches = []
        for number, hits in found.items():
            matches += self._of_template(words, places, number, hits, coverage)
        groups = {name: len(own) for name, own in zip(self.names, self.runs, strict=True)}
        return sorted(best(matches, groups), key=lambda m: (m.first, m.last, m.template))

    def _of_template(
        self,
        words: np.ndarray,
        places: _Places,
        number: int,
        hits: list[tuple[int, int]],
        least: float,
    ) -> Iterator[Match]:
        template = self.templates[number]
        band, needed = BAND + len(template) // 10, least * len(template)
        failed: set[int] = set()  # diagonals
        ruled_out = places.ruled_out(template, band, needed)
        found: list[tuple[int, int]] = []  # spans that begin after the hits looked at
        until = -1  # end of the spans that began
        for at, place in hits:  # by place in the document
            while found and found[0][0] <= at:
                until = max(until, heapq.heappop(found)[1])
            diagonal = at - place
            if at <= until or diagonal in failed:
                continue
            if not ruled_out(diagonal) and places.most(template, diagonal, band) >= needed:
                aligned = align(template, words, diagonal, band)
                if aligned and aligned[0] >= needed and self._has_runs(words, number, *aligned[1:]):
                    matched, first, last = aligned
                    heapq.heappush(found, (first, last))
                    yield Match(self.names[number], matched, matched / len(template), first, last)
                    continue
            failed.add(diagonal)

    def _has_runs(self, words: np.ndarray, number: int, first: int, last: int) -> bool:
        if not self.runs[number]:
            return True
        shown = _shown(words[max(0, first - SIDE) : last + 1 + SIDE].tolist())
        return all(any(run in shown for run in group) for group in self.runs[number])


class _Places:
    """Where a document has each word."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.step = len(words) + 1
        self.keys = np.sort(words * self.step + np.arange(len(words)))

    def ruled_out(self, template: np.ndarray, band: int, needed: float) -> Callable[[int], bool]:
        """Tells diagonals that surely have too few matches, each stretch looked at once.

        A diagonal fails if the words around it include too few of the template's, and with it
        all diagonals within the band if it fails with twice the band.
        """
        own = np.zeros(max(int(self.words.max(initial=0)), int(template.max())) + 1, dtype=bool)
        own[template] = True
        before = np.concatenate([[0], np.cumsum(own[self.words])])
        bad: dict[int, bool] = {}

        def check(diagonal: int) -> bool:
            low = max(0, diagonal - band)
            high = min(len(self.words), diagonal + len(template) + band)
            if high <= low or before[high] - before[low] < needed:
                return True
            stretch = diagonal // band  # its middle is within the band of all its diagonals
            if stretch not in bad:
                middle = stretch * band + band // 2
                bad[stretch] = self.most(template, middle, 2 * band) < needed
            return bad[stretch]

        return check

    def most(self, template: np.ndarray, diagonal: int, band: int) -> int:
        """No alignment within the band matches more words of the template."""
        at = np.arange(len(template)) + diagonal
        low = np.clip(at - band, 0, self.step - 1)
        high = np.clip(at + band + 1, 0, self.step - 1)
        base = template * self.step
        start = np.searchsorted(self.keys, base + low)
        return int((np.searchsorted(self.keys, base + high) > start).sum())


def _shown(ids: Iterable[int]) -> str:
    return " " + " ".join(map(str, ids)) + " "


def _sorted(entries: list[tuple[int, int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    entries.sort()
    return np.array([e[0] for e in entries], dtype=np.uint64), [(e[1], e[2]) for e in entries]


def best(matches: list[Match], groups: dict[str, int]) -> list[Match]:
    """Matches without those that lie by more than half on a better one, or it on them.

    Better has more words that match, then more groups of runs that tell it from others, then
    fewer words that do not match.
    """

    def rank(m: Match) -> tuple[int, int, float, int, str]:
        return -m.matched, -groups[m.template], -m.coverage, m.first, m.template

    kept: list[Match] = []
    near: dict[int, list[Match]] = defaultdict(list)  # kept ones by the stretches they lie on
    for m in sorted(matches, key=rank):
        stretches = range(m.first // STRETCH, m.last // STRETCH + 1)
        for other in (o for stretch in stretches for o in near[stretch]):
            shared = min(m.last, other.last) - max(m.first, other.first) + 1
            if 2 * shared > min(m.last - m.first, other.last - other.first) + 1:
                break
        else:
            kept.append(m)
            for stretch in stretches:
                near[stretch].append(m)
    return kept


def align(
    template: np.ndarray, words: np.ndarray, diagonal: int, band: int
) -> tuple[int, int, int] | None:
    """Best local alignment within `band` of a diagonal: matches, first and last word.

    Cell (i, b) ends at template word i and document word i + diagonal + b - band.
    """
    n, width = len(template), 2 * band + 1
    if 0 <= diagonal <= len(words) - n and np.array_equal(words[diagonal : diagonal + n], template):
        return n, diagonal, diagonal + n - 1  # nothing scores more
    steps = np.arange(width)
    score = np.zeros((n + 1, width + 2), np.int32)
    for i in range(n):
        j = i + diagonal - band + steps
        inside = (j >= 0) & (j < len(words))
        same = inside & (words[np.clip(j, 0, len(words) - 1)] == template[i])
        row = np.maximum(
            score[i, 1 : width + 1] + np.where(same, MATCH, MISMATCH), score[i, 2:] + SKIP
        )
        row = np.where(inside, np.maximum(row, 0), 0)
        # Skipping document words: the best cell to the left, less a step for each.
        row = np.maximum(row, np.maximum.accumulate(row - SKIP * steps) + SKIP * steps)
        score[i + 1, 1 : width + 1] = np.where(inside, row, 0)
    flat = int(np.argmax(score))
    i, b = divmod(flat, width + 2)
    if score[i, b] <= 0:
        return None
    matched, last = 0, i - 1 + diagonal + (b - 1) - band
    first = last
    while i > 0 and score[i, b] > 0:
        j = i - 1 + diagonal + (b - 1) - band
        same = 0 <= j < len(words) and words[j] == template[i - 1]
        if score[i, b] == score[i - 1, b] + (MATCH if same else MISMATCH):
            if same:
                matched, first = matched + 1, j
            i -= 1
        elif b + 1 < width + 2 and score[i, b] == score[i - 1, b + 1] + SKIP:
            i, b = i - 1, b + 1
        else:
            b -= 1
    return matched, first, last


MATCHES = "array<struct<template:string,matched:int,coverage:double,first_word:int,last_word:int>>"


def scan(documents: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """A row per document row: doc_id and its matches in the order of their place.

    Null and empty texts have no words and no matches. A template of fewer than K words is
    never met. Repeated rows and rows without id are scanned one by one.
    """
    index = Index(TEMPLATES if templates is None else templates)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct(
                [
                    ("template", pa.string()),
                    ("matched", pa.int32()),
                    ("coverage", pa.float64()),
                    ("first_word", pa.int32()),
                    ("last_word", pa.int32()),
                ]
            )
        )
        names = ["template", "matched", "coverage", "first_word", "last_word"]
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = part.column(1).to_pylist()
                found = [[dict(zip(names, m, strict=True)) for m in index.scan(t)] for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, type=kind)], names=["doc_id", "matches"]
                )

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    ).mapInArrow(scanned, f"doc_id long, matches {MATCHES}")


def op9_license_scan(documents: DataFrame) -> DataFrame:
    """A row per document row with the templates it holds and where."""
    return scan(documents).select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(
            F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["template"]))), ","
        ).alias("licenses"),
        "matches",
    )
