"""N-gram Jaccard join with token-combination prefixes.

A token is a word shingle. Two sets that share four fifths of their union must share tokens
within their prefixes, the first tokens in an order common to all. The order puts rare
tokens first, so that passages which many documents share come last. Rare tokens of a
prefix are indexed one by one. Frequent ones are dealt into small groups, and pairs of one
group are indexed: a group of c tokens only counts c - 1 towards the prefix, which is
extended accordingly. A key keeps its level, how long the prefix must be to hold it: what two
sets must share follows from both sizes, so a key above the prefix that this pair needs does
not count. Documents that meet under a key are compared: first by parity bitmaps that bound
the difference from below, then exactly on their texts.

Keys with few documents compare them all. Under a key with many, each document is compared
with some hubs, the documents that meet others under the most such keys: in a group of copies
these are the ones closest to all. Only where the links found so far leave such a key in
several components are the documents outside the largest of these compared with the others.
So copies are joined without all their pairs, and no link that joins anything is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelstar.llm.components import components
from parcelstar.llm.membership import split_by_membership
from parcelstar.llm.shingles import mixed, shingles
from parcelstar.session import write_through

WORDS = 5
#: Link when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Counters of the frequency sketch, over all documents, and in one of its rows.
SKETCH, ROW = 1 << 22, 1 << 16
#: A token is frequent if its counter is this far above what is expected of rare tokens.
FREQUENT = 64
#: Documents under one key up to which all are compared at once.
FEW = 32
#: Documents of a larger key that all others are compared with first.
HUBS = 3
#: Words of a folded bitmap.
FOLDED = 8
#: Rows of the sketch that are added up in one task.
FAN_IN = 64
_PAIRED, _SINGLE = np.uint64(1), np.uint64(2)


def _least_overlap(n: np.ndarray | int):
    """Tokens that a set of n shares with any set it links to."""
    return (PERCENT * n + 99) // 100


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the tokens that fall on each bit; the number of bits follows the size.

    Bits in which two bitmaps differ are at most as many as tokens in which the sets do.
    """
    bits = 512
    while bits < len(tokens):
        bits *= 2
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes) -> list[int]:
    """A bitmap folded to 512 bits, as eight numbers; the bound holds for these too."""
    words = np.frombuffer(bits, dtype=np.int64).reshape(-1, FOLDED)
    return np.bitwise_xor.reduce(words, axis=0).tolist()


def may_link(n: int, m: int, left: bytes, right: bytes) -> bool:
    """False only for sets that cannot link."""
    small, large = min(n, m), max(n, m)
    if 100 * small < PERCENT * large:
        return False
    a, b = int.from_bytes(left, "little"), int.from_bytes(right, "little")
    wide, short = (a, b) if len(left) > len(right) else (b, a)
    size, target = 8 * max(len(left), len(right)), 8 * min(len(left), len(right))
    while size > target:  # fold the longer one
        size //= 2
        wide = (wide >> size) ^ (wide & ((1 << size) - 1))
    overlap = -(-PERCENT * (n + m) // (100 + PERCENT))
    return (wide ^ short).bit_count() <= n + m - 2 * overlap


def _bands(n: int) -> list[int]:
    """Size classes, doubling; a set near the next class counts as both."""
    band = n.bit_length() - 1
    return [band, band + 1] if 100 * n >= PERCENT * (2 << band) else [band]


def _grouped_keys(tokens: np.ndarray, have: int, need: int, band: int) -> tuple[list, list, bool]:
    """Pairs within groups, from a level of `have` up to `need`: keys, levels, and whether
    the level is reached."""
    groups = np.uint64(max(1, (1 << band) // 4))
    group = (tokens >> np.uint64(20)) % groups
    order = np.lexsort((tokens, group))
    tokens, group = tokens[order], group[order]
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    ends = np.append(starts[1:], len(tokens))
    keys, levels = [], []
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        if have >= need:
            break
        end = min(end, start + need - have + 1)
        first, second = np.triu_indices(end - start, 1)
        own = tokens[start:end]
        pair = mixed(mixed(own[first], own[second]), np.full(len(first), band, np.uint64))
        keys.append(pair ^ _PAIRED)
        levels.append(have + second)
        have += end - start - 1
    return keys, levels, have >= need


def prefix_keys(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index keys of a set and their levels; `frequent` marks its tokens."""
    n = len(tokens)
    need = n - _least_overlap(n) + 1
    rare, often = tokens[~frequent], tokens[frequent]
    if len(rare) >= need:
        return rare[:need], np.arange(1, need + 1)
    keys, levels = [rare], [np.arange(1, len(rare) + 1)]
    enough = True
    for band in _bands(n):
        pairs, at, reached = _grouped_keys(often, len(rare), need, band)
        keys += pairs
        levels += at
        enough &= reached
    if not enough:  # too small to count in groups: the plain prefix as well
        plain = often[: need - len(rare)]
        keys.append(mixed(plain, np.full(len(plain), _SINGLE)))
        levels.append(np.arange(len(rare) + 1, len(rare) + len(plain) + 1))
    every, at = np.concatenate(keys), np.concatenate(levels)
    order = np.lexsort((at, every))
    every, at = every[order], at[order]
    first = np.append(True, every[1:] != every[:-1])[: len(every)]
    return every[first], at[first]


# --- passes over the texts ---------------------------------------------------------------

PROFILE = (
    "doc_id long, text_key long, n long, node long, bits binary, folded array<long>, "
    "counter_row int, task int, counters binary"
)
_PROFILE_TYPES = [
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()),
    pa.int32(), pa.int32(), pa.binary(),
]
_PROFILE_NAMES = [
    "doc_id", "text_key", "n", "node", "bits", "folded", "counter_row", "task", "counters",
]


def _node(tokens: np.ndarray) -> int:
    """Equal sets are one node."""
    return int.from_bytes(blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple]:
    for at in range(0, batch.num_rows, 256):
        part = batch.slice(at, 256)
        yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)


def _profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and the counters of all their tokens at the end of the task."""
    from pyspark import TaskContext

    counters = np.zeros(SKETCH, dtype=np.uint32)
    for batch in batches:
        rows = []
        keys = batch.column(2).to_pylist()
        for (doc_id, text), key in zip(_texts(batch), keys, strict=True):
            tokens = shingles(text, WORDS)
            if len(tokens):
                np.add.at(counters, tokens & np.uint64(SKETCH - 1), 1)
            if len(tokens):
                bits = bitmap(tokens)
                own = (doc_id, key, len(tokens), _node(tokens), bits, folded(bits))
            else:
                own = (doc_id, key, 0, None, None, None)
            rows.append((*own, None, None, None))
        yield _batch(rows)
    task = TaskContext.get().partitionId()
    if counters.any():
        small = np.minimum(counters, 255).astype(np.uint8)
        yield _batch(
            [
                (None, None, None, None, None, None, r, task, small[r * ROW : (r + 1) * ROW].tobytes())
                for r in range(SKETCH // ROW)
            ]
        )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_PROFILE_TYPES)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=k) for c, k in zip(columns, _PROFILE_TYPES, strict=True)],
        names=_PROFILE_NAMES,
    )


def _added(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(ROW, dtype=np.uint32)
    for counters in frame["counters"]:
        own = np.frombuffer(counters, dtype=np.uint8 if len(counters) == ROW else np.uint32)
        total += own
    return pd.DataFrame(
        {
            "counter_row": frame["counter_row"].iloc[:1],
            "task": frame["task"].iloc[:1] // FAN_IN,
            "counters": [total.tobytes()],
        }
    )


def frequent_tokens(profile: DataFrame) -> np.ndarray:
    """For each counter whether its tokens are frequent, packed as bits (a fixed size).

    The counters of the tasks are added up in a tree of groups of at most FAN_IN rows.
    """
    rows = profile.where(F.col("counter_row").isNotNull()).select(
        "counter_row", "task", "counters"
    )
    last = rows.agg(F.max("task")).collect()[0][0]
    if last is None:
        return np.zeros(SKETCH // 8, dtype=np.uint8)
    while True:
        rows = rows.groupBy("counter_row", F.floor(F.col("task") / FAN_IN).alias("_to")).applyInPandas(
            _added, "counter_row int, task int, counters binary"
        )
        last //= FAN_IN
        if not last:
            break
    total = np.zeros(SKETCH, dtype=np.uint32)
    for r in rows.collect():  # SKETCH counters in all
        total[r["counter_row"] * ROW : (r["counter_row"] + 1) * ROW] = np.frombuffer(
            r["counters"], dtype=np.uint32
        )
    # Rare tokens fall on counters evenly: their mean is the floor, its square root the noise.
    floor = float(np.median(total))
    return np.packbits(total > floor + 8 * floor**0.5 + FREQUENT, bitorder="little")


INDEX = "key long, node long, level int"


def _index_rows(key: np.ndarray, node: np.ndarray, level: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(node), pa.array(level.astype(np.int32))],
        names=["key", "node", "level"],
    )


def _indexing(frequent: np.ndarray):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keys of each distinct set; a task gives the keys of equal sets once."""
        flags = np.unpackbits(frequent, bitorder="little").astype(bool)
        seen: set[int] = set()
        for batch in batches:
            keys, nodes, levels = [], [], []
            for _, text in _texts(batch):
                tokens = shingles(text, WORDS)
                if not len(tokens):
                    continue
                node = _node(tokens)
                if node in seen:
                    continue
                seen.add(node)
                own, at = prefix_keys(tokens, flags[tokens & np.uint64(SKETCH - 1)])
                keys.append(own)
                levels.append(at)
                nodes.append(np.full(len(own), node, dtype=np.int64))
            if keys:
                yield _index_rows(
                    np.concatenate(keys).view(np.int64),
                    np.concatenate(nodes),
                    np.concatenate(levels),
                )

    return index


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key and node, those of keys with two nodes or more, each once.

    Runs in constant memory, however many rows a key has: only the last row of a batch is
    kept, with whether it has been given out.
    """
    last: tuple[int, int, int] | None = None
    given = False
    for batch in batches:
        if not batch.num_rows:
            continue
        key, node, level = (batch.column(i).to_numpy() for i in range(3))
        if last is not None:
            key, node = np.append(last[0], key), np.append(last[1], node)
            level = np.append(last[2], level)
        new = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))
        key, node, level = key[new], node[new], level[new]
        same = key[1:] == key[:-1]
        keep = np.append(same, False) | np.append(False, same)
        ends_given = bool(keep[-1]) or (len(keep) == 1 and given)
        if given:
            keep[0] = False
        last, given = (int(key[-1]), int(node[-1]), int(level[-1])), ends_given
        if keep.any():
            yield _index_rows(key[keep], node[keep], level[keep])


# --- candidates and links ----------------------------------------------------------------


def _buckets(documents: DataFrame, nodes: DataFrame, frequent: np.ndarray) -> DataFrame:
    """key, node, n, level and the bucket's size.

    Keys with the same nodes are one bucket, with each node's least level.
    """
    index = documents.select("doc_id", "text").mapInArrow(_indexing(frequent), INDEX)
    shared = write_through(
        index.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_shared, INDEX),
        "jaccard-index",
    )
    held = ["size", "x", "y"]
    keys = shared.groupBy("key").agg(
        F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    )
    same = keys.join(keys.groupBy(*held).agg(F.min("key").alias("bucket")), held)
    return write_through(
        shared.join(same.select("key", "bucket", "size"), "key")
        .groupBy(F.col("bucket").alias("key"), "node")
        .agg(F.min("level").alias("level"), F.first("size").alias("size"))
        .join(nodes.select("node", "n", "folded"), "node"),
        "jaccard-buckets",
    )


def _least_shared() -> Column:
    """Tokens that a linking pair (nx, ny) must share at least."""
    return F.ceil(PERCENT * (F.col("nx") + F.col("ny")) / (100 + PERCENT))


def _near() -> Column:
    """Folded bitmaps (fx, fy) that differ in no more bits than a linking pair may."""
    apart = reduce(
        Column.__add__,
        [F.bit_count(F.get("fx", i).bitwiseXOR(F.get("fy", i))) for i in map(F.lit, range(FOLDED))],
    )
    return apart <= F.col("nx") + F.col("ny") - 2 * _least_shared()


def _counts() -> Column:
    """Whether a key lies in the prefixes that this pair of sizes needs, of both sets."""
    return (F.col("lx") <= F.col("nx") - _least_shared() + 1) & (
        F.col("ly") <= F.col("ny") - _least_shared() + 1
    )


def _side(rows: DataFrame, name: str, *more: str) -> DataFrame:
    """One side of a join of bucket rows."""
    return rows.select(
        "key",
        F.col("node").alias(name),
        F.col("n").alias(f"n{name}"),
        F.col("level").alias(f"l{name}"),
        F.col("folded").alias(f"f{name}"),
        *[F.col(m).alias(f"{m}_{name}") for m in more],
    )


def _ordered_pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


@F.pandas_udf(T.BooleanType())
def _may_link(n: pd.Series, m: pd.Series, left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(list(map(may_link, n.tolist(), m.tolist(), left, right)), dtype=bool)


def _filtered(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) that size and bitmap leave possible."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("la"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("lb"))
    return (
        pairs.distinct()
        .join(left, "a")
        .join(right, "b")
        .where(_may_link("na", "nb", "la", "lb"))
        .select("a", "b")
    )


@lru_cache(maxsize=4)
def _cached_shingles(text: bytes) -> np.ndarray:
    return shingles(text, WORDS)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for left, right in zip(
                part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True
            ):
                x, y = _cached_shingles(left), shingles(right, WORDS)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select([0, 1]).filter(pa.array(keep, type=pa.bool_()))


def _links(pairs: DataFrame, nodes: DataFrame, documents: DataFrame) -> DataFrame:
    """The pairs whose texts link; only the texts of candidates are moved."""
    wanted = (
        pairs.select(F.col("a").alias("node"))
        .union(pairs.select("b"))
        .distinct()
        .join(nodes.select("node", "example"), "node")
    )
    wanted = write_through(wanted, "jaccard-wanted")
    near, _ = split_by_membership(documents.select("doc_id", "text"), "doc_id", wanted, "example")
    texts = write_through(
        near.join(wanted, F.col("doc_id").eqNullSafe(F.col("example")))
        .select("node", "text"),
        "jaccard-texts",
    )
    # An id may stand for several texts: only a text of the node's own set is right.
    texts = texts.mapInArrow(_own_text, "node long, text binary").dropDuplicates(["node"])
    texts = write_through(texts, "jaccard-texts")
    joined = (
        pairs.join(texts.toDF("b", "right"), "b")
        .join(texts.toDF("a", "left"), "a")
        .select("a", "b", "left", "right")
    )
    return write_through(joined.mapInArrow(_verified, "a long, b long"), "jaccard-links")


def _own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [_node(shingles(text, WORDS)) == node for node, text in _texts(batch)]
        yield batch.filter(pa.array(keep, type=pa.bool_()))


def _first_pairs(buckets: DataFrame) -> DataFrame:
    """All pairs of small buckets, and each node of a large one with its hubs."""
    small = buckets.where(F.col("size") <= FEW)
    pairs = (
        _side(small, "x")
        .join(_side(small, "y"), "key")
        .where((F.col("x") < F.col("y")) & _counts() & _near())
    )
    large = buckets.where(F.col("size") > FEW)
    weighed = large.join(large.groupBy("node").agg(F.count("*").alias("weight")), "node")
    # The limit on the row number is applied in each task before the shuffle.
    order = Window.partitionBy("key").orderBy(F.desc("weight"), "node")
    hubs = weighed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= HUBS)
    stars = (
        _side(large, "x")
        .join(_side(hubs, "y"), "key")
        .where((F.col("x") != F.col("y")) & _near())
    )
    return _ordered_pairs(pairs).union(_ordered_pairs(stars))


def _remaining_pairs(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """In large buckets of several components: nodes outside the largest, with all others."""
    large = (
        buckets.where(F.col("size") > FEW)
        .join(found, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    counted = large.groupBy("key", "component").count()
    largest = counted.groupBy("key").agg(
        F.max_by("component", F.struct("count", "component")).alias("main"),
        F.count("*").alias("components"),
    )
    rows = large.join(largest.where("components > 1").select("key", "main"), "key")
    joined = (
        _side(rows.where("component != main"), "x", "component")
        .join(_side(rows, "y", "component"), "key")
        .where((F.col("component_x") != F.col("component_y")) & _counts() & _near())
    )
    return _ordered_pairs(joined).distinct()


def _components(documents: DataFrame) -> DataFrame:
    """A row per document row: doc_id, text_key, n_shingles and its component, if it has shingles."""
    text = F.col("text").cast("binary")
    source = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64("text").alias("text_key")
    )
    profile = write_through(source.mapInArrow(_profiled, PROFILE), "jaccard-profile")
    rows = profile.where(F.col("n").isNotNull()).select(
        "doc_id", "text_key", "n", "node", "bits", "folded"
    )
    nodes = write_through(
        rows.where(F.col("n") > 0)
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("example"),
            F.first("n").alias("n"),
            F.first("bits").alias("bits"),
            F.first("folded").alias("folded"),
        ),
        "jaccard-nodes",
    )
    buckets = _buckets(source, nodes, frequent_tokens(profile))
    first = write_through(_filtered(_first_pairs(buckets), nodes), "jaccard-pairs")
    links = _links(first, nodes, source)
    found = write_through(components(links), "jaccard-components")
    more = write_through(
        _filtered(_remaining_pairs(buckets, found).join(first, ["a", "b"], "left_anti"), nodes),
        "jaccard-pairs",
    )
    if not more.isEmpty():
        links = links.union(_links(more, nodes, source))
        found = write_through(components(links), "jaccard-components")
    return rows.select("doc_id", "text_key", "n", "node").join(found, "node", "left").select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "node").alias("_c"),
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """A row per document row: doc_id, n_shingles, component_id.

    Texts without words, empty and null ones have no shingles and link with nothing: their
    component is their own id. Equal sets are one node, whatever the number of their
    copies. component_id is the least id of the component's documents; rows without id
    take part, and are null only where no document of the component has an id. Repeated
    rows give repeated rows. An empty table has no rows.
    """
    of_rows = _components(documents)
    least = of_rows.where(F.col("_c").isNotNull()).groupBy("_c").agg(
        F.min("doc_id").alias("_least")
    )
    return of_rows.join(least, "_c", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("_c").isNull(), F.col("doc_id")).otherwise(F.col("_least")).alias("component_id"),
    )


def keep_one_of_each(documents: DataFrame) -> DataFrame:
    """The documents without near duplicates: one row of each component stays.

    That is the row with the least id, or one without id where no row has one. Rows are told
    apart by id and text: of rows that repeat an id with other texts each is judged by its own
    text, and of rows that repeat both, any one stays. Texts without words all stay.
    """
    rows = write_through(
        _components(documents).where(F.col("_c").isNotNull()).select("doc_id", "text_key", "_c"),
        "jaccard-rows",
    )
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    kept = rows.groupBy("_c").agg(F.min(own).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    # A mark for each text that goes, and for each that stays but comes twice.
    marks = (
        rows.join(kept.where(F.col("_rows") > 1), "_c")
        .groupBy("doc_id", "text_key")
        .agg(F.first(own != F.col("_first")).alias("_goes"), F.count(F.lit(1)).alias("_times"))
        .where(F.col("_goes") | (F.col("_times") > 1))
    )
    marks = write_through(
        marks.select(F.col("doc_id").alias("_of"), F.col("text_key").alias("_key_of"), "_goes"),
        "jaccard-marks",
    )
    maybe, others = split_by_membership(documents, "doc_id", marks, "_of")
    of = marks.select(F.col("_of").alias("_doc_of"), F.col("_key_of").alias("_text_of"), F.col("_goes").alias("_gone"))
    same = maybe["doc_id"].eqNullSafe(of["_doc_of"]) & (F.xxhash64(maybe["text"]) == of["_text_of"])
    if marks.where(~F.col("_goes")).isEmpty():  # no row repeats both: the texts move once
        return others.union(maybe.join(of, same, "left_anti"))
    columns = [maybe[c] for c in documents.columns]
    judged = maybe.join(of, same, "left")
    once = judged.where(of["_gone"].isNull()).select(*columns)
    twice = judged.where(~of["_gone"]).select(*columns).dropDuplicates(["doc_id", "text"])
    return others.union(once).union(twice)


def op4_ngram_jaccard_join(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents)
