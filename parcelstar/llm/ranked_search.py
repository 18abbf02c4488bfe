"""Ranked lexical search: many queries at once, with shared partial accumulators.

An item's score for a document is a sum over the item's terms. Items share terms, so a plan is
mined first: terms that occur in just the same items become one set, and then, again and
again, the two sets that most items share become a new one. The plan is a directed graph
whose nodes are sums of two others and whose ends are the items. For every batch of documents
each node's accumulator, a number per document, is worked out once and added up along the
graph; the least item score that can still enter the best ones picks the few documents to
keep. A task hands on its best documents of each item, so what is shuffled does not grow with
the documents a task reads.

Items come in blocks of bounded text, hashed by id, and each block scans the documents: what
the driver and the tasks hold is a block's terms and plan.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelstar.llm.expressions import UPPER, ascii_lower, words_between
from parcelstar.session import write_through

BEST = 10
#: Bytes of item terms in a block, on average.
BLOCK_BYTES = 1 << 20
#: Items that share two sets before these become one; sets of an item looked at for that.
SHARED, PAIRED = 3, 48
#: Sums that a task holds at a time.
ACCUMULATORS = 1 << 21
#: Characters between terms, and what maps bytes to terms between spaces.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
SCALE, SATURATION, LENGTH_PART = 1_000_000_000, 1000, 90


# ---- the plan


@dataclass
class Plan:
    """Nodes as pairs of earlier nodes or terms, and what each item adds up.

    Node i < n_terms is term i; node n_terms + j is the sum of `pairs[j]`.
    """

    n_terms: int
    pairs: list[tuple[int, int]]
    items: list[list[int]]

    def terms_of(self, node: int) -> list[int]:
        if node < self.n_terms:
            return [node]
        left, right = self.pairs[node - self.n_terms]
        return self.terms_of(left) + self.terms_of(right)


def mine_plan(items: list[list[int]], n_terms: int) -> Plan:
    """A plan for items given as lists of distinct term numbers.

    Sharing only saves work; whatever it finds, every item adds up its own terms once each.
    """
    pairs: list[tuple[int, int]] = []

    def node(left: int, right: int) -> int:
        pairs.append((left, right))
        return n_terms + len(pairs) - 1

    def balanced(nodes: list[int]) -> int:
        while len(nodes) > 1:
            nodes = [
                node(*nodes[i : i + 2]) if i + 1 < len(nodes) else nodes[i]
                for i in range(0, len(nodes), 2)
            ]
        return nodes[0]

    # Terms of just the same items.
    owners = defaultdict(list)
    for number, terms in enumerate(items):
        for term in terms:
            owners[term].append(number)
    alike = defaultdict(list)
    for term, numbers in owners.items():
        alike[tuple(numbers)].append(term)
    holds: list[set[int]] = [set() for _ in items]
    shared_by: dict[int, set[int]] = {}
    for numbers, terms in alike.items():
        if len(numbers) == 1:
            holds[numbers[0]].update(terms)
            continue
        own = balanced(terms)
        shared_by[own] = set(numbers)
        for number in numbers:
            holds[number].add(own)

    # The two nodes that most items share, again and again.
    counts: Counter[tuple[int, int]] = Counter()
    for nodes in holds:
        often = sorted((n for n in nodes if n in shared_by), key=lambda n: (-len(shared_by[n]), n))
        often = sorted(often[:PAIRED])
        counts.update((a, b) for i, a in enumerate(often) for b in often[i + 1 :])
    by_count = defaultdict(set)
    for pair, count in counts.items():
        if count >= SHARED:
            by_count[count].add(pair)
    for count in range(max(by_count, default=0), SHARED - 1, -1):
        # Counts only fall as nodes are used up; a pair is looked at again at its lower count.
        for left, right in sorted(by_count.pop(count, ())):
            both = shared_by[left] & shared_by[right]
            if len(both) < count:
                if len(both) >= SHARED:
                    by_count[len(both)].add((left, right))
                continue
            merged = node(left, right)
            shared_by[merged] = both
            for number in both:
                holds[number] -= {left, right}
                holds[number].add(merged)
            shared_by[left] = shared_by[left] - both
            shared_by[right] = shared_by[right] - both
            partners: Counter[int] = Counter()
            for number in both:
                partners.update(n for n in holds[number] if n != merged and n in shared_by)
            for other, times in partners.most_common(PAIRED):
                if SHARED <= times:
                    # Not more than `count`: at that count it comes up in the next turn.
                    by_count[min(times, count - 1)].add((min(other, merged), max(other, merged)))
    return Plan(n_terms, pairs, [sorted(nodes) for nodes in holds])


# ---- documents


def _matched(documents: DataFrame, terms: dict[str, int]) -> DataFrame:
    """Written table: doc_id, n (terms of the document), and the block's terms in it with counts."""
    shared = documents.sparkSession.sparkContext.broadcast({t.encode(): i for t, i in terms.items()})

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, numbers, counts = [], [], []
            for text in batch.column("text").to_pylist():
                words = text.translate(_BYTES).split()
                own = [(known[w], c) for w, c in Counter(words).items() if w in known]
                pairs = np.array(own, dtype=np.int64).reshape(-1, 2)
                sizes.append(len(words))
                numbers.append(pairs[:, 0].astype(np.int32).tobytes())
                counts.append(pairs[:, 1].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, type=pa.int64()),
                    pa.array(numbers, type=pa.binary()),
                    pa.array(counts, type=pa.binary()),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    texts = documents.where(F.octet_length("text") > 0).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )
    matched = texts.mapInArrow(match, "doc_id long, n long, terms binary, counts binary")
    return write_through(matched.where(F.col("n") > 0), "search-matched")


def _holders(matched: DataFrame, n_terms: int) -> np.ndarray:
    """The documents that hold each term of the block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            numbers = np.frombuffer(b"".join(batch.column("terms").to_pylist()), dtype=np.int32)
            total += np.bincount(numbers, minlength=n_terms)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(total[met])], names=["term", "documents"]
        )

    out = np.zeros(n_terms, dtype=np.int64)
    counted = matched.select("terms").mapInArrow(count, "term int, documents long")
    for row in counted.groupBy("term").agg(F.sum("documents").alias("documents")).collect():
        out[row["term"]] = row["documents"]  # a row per term of the block
    return out


def weight(holders: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


class Evaluation:
    """The best documents of each item, batch after batch."""

    def __init__(self, plan: Plan, weights: np.ndarray, documents: int, words: int, best: int) -> None:
        self.plan, self.weights, self.best = plan, weights, best
        self.documents, self.words = documents, words
        none = np.zeros(0, dtype=np.int64)
        self.kept = [(none, none) for _ in plan.items]  # scores and rows of `ids`
        self.ids: list[int | None] = []

    def _postings(self, batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each term the rows of the batch that hold it, and what it adds there."""
        listed = batch.column("terms").to_pylist()
        numbers = np.frombuffer(b"".join(listed), dtype=np.int32)
        counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), dtype=np.int64)
        rows = np.repeat(np.arange(len(listed)), [len(v) // 4 for v in listed])
        sizes = batch.column("n").to_numpy()
        norm = SATURATION // 10 - LENGTH_PART + LENGTH_PART * sizes * self.documents // self.words
        added = self.weights[numbers] * (SCALE * counts // (SATURATION * counts + 8 * norm[rows]))
        order = np.argsort(numbers, kind="stable")
        cuts = np.searchsorted(numbers[order], np.arange(1, self.plan.n_terms))
        return list(zip(np.split(rows[order], cuts), np.split(added[order], cuts), strict=True))

    def add(self, batch: pa.RecordBatch) -> None:
        # The accumulators of all nodes are held at once.
        rows = max(32, min(4096, ACCUMULATORS // (len(self.plan.pairs) + 1)))
        for start in range(0, batch.num_rows, rows):
            self._add(batch.slice(start, rows))

    def _add(self, batch: pa.RecordBatch) -> None:
        n = batch.num_rows
        first = len(self.ids)
        self.ids += batch.column("doc_id").to_pylist()
        postings = self._postings(batch)
        sums: list[np.ndarray] = []

        def add_to(total: np.ndarray, node: int) -> None:
            if node >= self.plan.n_terms:
                total += sums[node - self.plan.n_terms]
            else:
                rows, values = postings[node]
                total[rows] += values  # a row holds a term once

        for pair in self.plan.pairs:
            total = np.zeros(n, dtype=np.int64)
            for node in pair:
                add_to(total, node)
            sums.append(total)
        for number, nodes in enumerate(self.plan.items):
            total = np.zeros(n, dtype=np.int64)
            for node in nodes:
                add_to(total, node)
            self._keep(number, total, first)
        self._forget()

    def _keep(self, number: int, total: np.ndarray, first: int) -> None:
        scores, rows = self.kept[number]
        least = max(1, int(scores[-1]) if len(scores) == self.best else 1)
        met = np.flatnonzero(total >= least)
        if len(met) > 4 * self.best:  # those below the best are out, equals stay
            limit = np.partition(total[met], -self.best)[-self.best]
            met = met[total[met] >= limit]
        if len(met):
            scores = np.concatenate([scores, total[met]])
            rows = np.concatenate([rows, met + first])
            ids = [self.ids[r] for r in rows]
            none = [i is None for i in ids]
            order = np.lexsort(([i or 0 for i in ids], none, -scores))[: self.best]
            self.kept[number] = (scores[order], rows[order])

    def _forget(self) -> None:
        """Keep the ids of the best documents only."""
        used = np.unique(np.concatenate([rows for _, rows in self.kept])) if self.kept else []
        self.ids = [self.ids[r] for r in used]
        self.kept = [(scores, np.searchsorted(used, rows)) for scores, rows in self.kept]

    def result(self) -> pa.RecordBatch:
        numbers = [i for i, (scores, _) in enumerate(self.kept) for _ in scores]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(numbers, type=pa.int32()),
                pa.array([self.ids[r] for _, rows in self.kept for r in rows], type=pa.int64()),
                pa.array([int(s) for scores, _ in self.kept for s in scores], type=pa.int64()),
            ],
            names=["item", "doc_id", "score"],
        )


def _block_results(documents: DataFrame, items: list[list[str]], best: int) -> DataFrame:
    """item (its number), doc_id, score: the best documents of each task, and so of all."""
    terms = {t: i for i, t in enumerate(sorted({t for own in items for t in own}))}
    plan = mine_plan([sorted(terms[t] for t in own) for own in items], len(terms))
    matched = _matched(documents, terms)
    total = matched.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("words")).first()
    holders = _holders(matched, len(terms))
    n, words = total["documents"], total["words"] or 1
    weights = np.array([weight(int(h), n) for h in holders], dtype=np.int64)
    shared = documents.sparkSession.sparkContext.broadcast((plan, weights))  # of a block

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, values = shared.value
        evaluation = Evaluation(own, values, n, words, best)
        for batch in batches:
            evaluation.add(batch)
        yield evaluation.result()

    return matched.mapInArrow(search, "item int, doc_id long, score long")


def item_terms(items: DataFrame) -> DataFrame:
    """The distinct terms of each item: item_id, term. Rows that share an id are one item."""
    lowered = ascii_lower(F.col("text"))
    return items.select("item_id", F.explode(words_between(lowered, SEPARATORS)).alias("term")).distinct()


def ranked_search(
    documents: DataFrame, items: DataFrame, best: int = BEST, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The `best` documents of each item: item_id, rank (from 1), doc_id, score.

    Terms are runs of ASCII letters, digits and all characters beyond ASCII, A-Z in lower
    case. The score of a document is the sum over the item's distinct terms of a whole-number
    BM25 part, with statistics over all documents. Equal scores rank by ascending doc_id, rows
    without id last. Only scores above 0 count, so an item may have fewer documents or none.

    Null and empty texts have no terms: such documents count for nothing, such items have no
    rows. Rows of items that share an id are one item, and those without id are one, too. Each
    document row is ranked by itself, also rows that repeat. Empty tables give no rows.
    """
    spark = documents.sparkSession
    terms = write_through(item_terms(items), "search-items")
    total = terms.agg(F.sum(F.octet_length("term") + 1)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = []
    for number in range(blocks):
        mine = defaultdict(list)
        for row in terms.where(block == number).collect():  # a block
            mine[row["item_id"]].append(row["term"])
        if not mine:
            continue
        names = spark.createDataFrame(
            list(enumerate(mine)), f"item int, item_id {items.schema['item_id'].dataType.simpleString()}"
        )
        results = _block_results(documents, list(mine.values()), best)
        found.append(results.join(F.broadcast(names), "item"))  # a row per item of the block
    if not found:
        return items.select(
            "item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
            F.lit(0).cast("long").alias("score"),
        ).where(F.lit(False))
    # One order for all tasks' best: each has at most `best` of an item.
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        reduce(DataFrame.unionByName, found)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= best)
        .select("item_id", "rank", "doc_id", "score")
    )


def op13_ranked_search(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return ranked_search(documents, benchmark)


#: The same rows by joining terms.
ORACLE = rf"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM words WHERE len(w) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d),
tf AS (
  SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
  FROM (SELECT r, doc_id, n, unnest(w) AS term FROM d) GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
part AS (
  SELECT item_id, r, doc_id,
    CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
      * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))) AS score
  FROM i JOIN df USING (term) JOIN tf USING (term) CROSS JOIN s),
total AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(score) AS BIGINT) AS score
  FROM part GROUP BY item_id, r HAVING sum(score) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score, row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM total)
WHERE rank <= 10
"""
