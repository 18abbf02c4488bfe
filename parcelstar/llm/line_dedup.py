"""Line dedup: two Bloom filters pick suspected repeats, an exact count confirms them.

Every long line gets a key, 128 bits of the SHA-256 of its normalised text; the keys of all
documents are written once, 16 bytes a line. Half of each key goes to the task that owns its
segment of the filters. That task sets what it has seen in one Bloom filter and what it sees
again in a second, which is all that is kept. Lines whose key is not in the second filter are
surely in one document. Only the others are shuffled as rows: their documents are counted
exactly, and keys in enough documents keep their lines in the largest document id alone.
Texts move only for documents that lose a line.

The filters grow with the lines up to SEGMENTS segments, 64 MB of the second one, which is
broadcast. With still more lines the filter rules out fewer, and more keys are counted; the
result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from parcelstar.llm.membership import split_by_membership
from parcelstar.operators.joins import lookup_join
from parcelstar.session import write_through

MIN_CHARS, MIN_DOCUMENTS = 40, 5
#: Keys a segment is made for, and the most segments.
SEGMENT_KEYS, SEGMENTS = 1 << 18, 1024
#: Bits of a segment as powers of two: what was seen, what was seen again.
SEEN, AGAIN = 22, 19
PROBES = 4
#: Half of a key, which the filters use, and the other half.
KEY = np.dtype([("hi", "<i8"), ("lo", "<i8")])


def long_lines(text: bytes, least: int = MIN_CHARS) -> tuple[list[int], bytes]:
    """Places of the lines with a key of at least `least` code points, and their keys.

    Bytes are stripped and lowered by ASCII rules only.
    """
    places, keys = [], []
    for place, line in enumerate(text.split(b"\n")):
        stripped = line.strip()
        size = len(stripped)
        if size >= least and (size >= 4 * least or len(stripped.decode(errors="replace")) >= least):
            places.append(place)
            keys.append(sha256(stripped.lower()).digest()[: KEY.itemsize])
    return places, b"".join(keys)


def probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The places of each hash in a segment's filter, a row per probe."""
    start, step = (hashes >> np.uint64(10)) & np.uint64((1 << 27) - 1), (hashes >> np.uint64(37)) | np.uint64(1)
    turns = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((start + turns * step) & np.uint64((1 << bits) - 1)).astype(np.int64)


class Filters:
    """A segment's two filters: hashes seen, and hashes seen again."""

    def __init__(self) -> None:
        self.seen = np.zeros(1 << SEEN, dtype=bool)
        self.again = np.zeros(1 << AGAIN, dtype=bool)

    def add(self, once: np.ndarray, twice: np.ndarray) -> None:
        """Distinct hashes, and those of them that came up twice already."""
        places = probes(once, SEEN)
        repeated = np.concatenate([once[self.seen[places].all(axis=0)], twice])
        self.seen[places] = True
        self.again[probes(repeated, AGAIN)] = True


def in_again(packed: np.ndarray, hashes: np.ndarray, segments: int) -> np.ndarray:
    """Which hashes are in the second filter, all segments one after the other."""
    segment = (hashes & np.uint64(segments - 1)).astype(np.int64)
    places = probes(hashes, AGAIN) + (segment << AGAIN)
    return ((packed[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=0)


def _keys_of(documents: DataFrame, least: int) -> DataFrame:
    """Written table: doc_id, text_key and the places and keys of the long lines, if any."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                places, keys = long_lines(text, least)
                if places:
                    rows.append((i, np.array(places, dtype=np.int32).tobytes(), keys))
            at = pa.array([r[0] for r in rows], type=pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("text_key").take(at),
                    pa.array([r[1] for r in rows], type=pa.binary()),
                    pa.array([r[2] for r in rows], type=pa.binary()),
                ],
                names=["doc_id", "text_key", "places", "keys"],
            )

    texts = documents.where(F.octet_length("text") >= least).select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text")
    )
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_key long, places binary, keys binary"
    return write_through(texts.mapInArrow(cut, schema), "line-keys")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a batch, and the row of each."""
    values = batch.column("keys").to_pylist()
    rows = np.repeat(np.arange(len(values)), [len(v) // KEY.itemsize for v in values])
    return np.frombuffer(b"".join(values), dtype=KEY), rows


def _seen_again(lines: DataFrame, segments: int) -> np.ndarray:
    """The second filter over all documents, packed: at most SEGMENTS << AGAIN bits."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = _flat(batch)
            hashes = keys["hi"].astype(np.uint64)
            order = np.lexsort((rows, hashes))
            hashes, rows = hashes[order], rows[order]
            fresh = np.ones(len(hashes), dtype=bool)  # a line repeated in a document counts once
            fresh[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
            once, documents = np.unique(hashes[fresh], return_counts=True)
            own = once & np.uint64(segments - 1)
            order = np.argsort(own, kind="stable")
            once, documents, own = once[order], documents[order], own[order]
            numbers, starts = np.unique(own, return_index=True)
            parts = list(zip(np.split(once, starts[1:]), np.split(documents, starts[1:]), strict=True))
            parts = parts[: len(numbers)]  # of no keys, there is one empty part
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers.astype(np.int32)),
                    pa.array([h.tobytes() for h, _ in parts], type=pa.binary()),
                    pa.array([h[n > 1].tobytes() for h, n in parts], type=pa.binary()),
                ],
                names=["segment", "once", "twice"],
            )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            packed = np.packbits(filters.again, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([segment], type=pa.int32()), pa.array([packed], type=pa.binary())],
                names=["segment", "again"],
            )

        segment, filters = None, Filters()
        for batch in batches:
            for row in batch.to_pylist():
                if row["segment"] != segment:
                    if segment is not None:
                        yield done()
                    segment, filters = row["segment"], Filters()
                filters.add(*[np.frombuffer(row[c], dtype=np.uint64) for c in ("once", "twice")])
        if segment is not None:
            yield done()

    routed = lines.select("keys").mapInArrow(route, "segment int, once binary, twice binary")
    built = (
        routed.repartition("segment")
        .sortWithinPartitions("segment")
        .mapInArrow(build, "segment int, again binary")
    )
    size = 1 << (AGAIN - 3)
    packed = np.zeros(segments * size, dtype=np.uint8)
    for row in built.collect():  # at most SEGMENTS rows of 64 KB
        packed[row["segment"] * size : (row["segment"] + 1) * size] = np.frombuffer(
            row["again"], dtype=np.uint8
        )
    return packed


def _suspects(lines: DataFrame, packed: np.ndarray, segments: int) -> DataFrame:
    """A row per line that may be in two documents: hi, lo, doc_id, text_key, place."""
    shared = lines.sparkSession.sparkContext.broadcast(packed)  # at most 64 MB

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = _flat(batch)
            places = np.frombuffer(b"".join(batch.column("places").to_pylist()), dtype=np.int32)
            met = in_again(shared.value, keys["hi"].astype(np.uint64), segments)
            at = pa.array(rows[met])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ascontiguousarray(keys["hi"][met])),
                    pa.array(np.ascontiguousarray(keys["lo"][met])),
                    batch.column("doc_id").take(at),
                    batch.column("text_key").take(at),
                    pa.array(places[met]),
                ],
                names=["hi", "lo", "doc_id", "text_key", "place"],
            )

    kind = lines.schema["doc_id"].dataType.simpleString()
    schema = f"hi long, lo long, doc_id {kind}, text_key long, place int"
    return lines.mapInArrow(pick, schema)


def segments_for(lines: int) -> int:
    """Segments of the filters, a power of two, for so many lines."""
    needed = max(1, -(-lines // SEGMENT_KEYS))
    return min(SEGMENTS, 1 << (needed - 1).bit_length())


def dropped_lines(
    documents: DataFrame, least: int = MIN_CHARS, enough: int = MIN_DOCUMENTS
) -> DataFrame:
    """Written table: doc_id, text_key (hash of the text) and the places of its lost lines."""
    lines = _keys_of(documents, least)
    total = lines.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    segments = segments_for(total // KEY.itemsize)
    packed = _seen_again(lines, segments)
    suspects = write_through(_suspects(lines, packed, segments), "line-suspects")
    # Documents first, so that a line of very many documents is counted by many tasks.
    repeated = (
        suspects.select("hi", "lo", "doc_id")
        .distinct()
        .groupBy("hi", "lo")
        .agg(F.count("doc_id").alias("_documents"), F.max("doc_id").alias("_keeps"))
        .where(F.col("_documents") >= enough)
        .select("hi", "lo", "_keeps")
    )
    repeated = write_through(repeated, "lines-repeated")
    gone = lookup_join(suspects, repeated, ["hi", "lo"], "inner").where(
        ~F.col("doc_id").eqNullSafe(F.col("_keeps"))
    )
    return write_through(
        gone.groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("places")), "lines-dropped"
    )


@F.pandas_udf(StringType())
def _without(texts: pd.Series, places: pd.Series) -> pd.Series:
    kept = []
    for text, gone in zip(texts, places, strict=True):
        if gone is not None:
            gone = set(gone)
            text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
        kept.append(text)
    return pd.Series(kept, dtype=object)


def _unused(columns: list[str], name: str) -> str:
    taken = {c.lower() for c in columns}
    while name in taken:
        name = f"_{name}"
    return name


def _deduplicated(documents: DataFrame, least: int, enough: int, kept: str, dropped: str) -> DataFrame:
    """The documents with two more columns: the text that stays, and how many lines went."""
    drops = dropped_lines(documents, least, enough)
    maybe, whole = split_by_membership(documents, "doc_id", drops, "doc_id")
    gone = drops.select(
        F.col("doc_id").alias("_gone_doc"),
        F.col("text_key").alias("_gone_text"),
        F.col("places").alias("_gone_places"),
    )
    same = maybe["doc_id"].eqNullSafe(gone["_gone_doc"]) & (
        F.xxhash64(maybe["text"]) == gone["_gone_text"]
    )
    places = gone["_gone_places"]
    cut = maybe.join(gone, same, "left").select(
        *[maybe[c] for c in documents.columns],
        _without(maybe["text"], places).alias(kept),
        F.when(places.isNull(), 0).otherwise(F.size(places)).cast("long").alias(dropped),
    )
    return cut.union(
        whole.select(
            *[whole[c] for c in documents.columns],
            whole["text"].alias(kept),
            F.lit(0).cast("long").alias(dropped),
        )
    )


def dedup_lines(
    documents: DataFrame, least: int = MIN_CHARS, enough: int = MIN_DOCUMENTS
) -> DataFrame:
    """The documents, all columns, without lines that repeat across documents.

    A line's key is the line without ASCII white space at its ends, A-Z in lower case. Keys
    of at least `least` code points found in at least `enough` documents lose all their lines
    but those of the largest doc_id that has one; these all stay. Documents are told apart
    by doc_id: rows that repeat one are one document, and rows without id count for none but
    lose the lines. Null texts stay null; a text that loses every line is empty. Lines are
    compared by 128 bits of SHA-256, of any length. An empty table gives an empty one.
    """
    kept = _unused(documents.columns, "kept_text")
    out = _deduplicated(documents, least, enough, kept, _unused([*documents.columns, kept], "dropped"))
    return out.select(
        *[F.col(f"`{kept}`").alias("text") if c == "text" else F.col(f"`{c}`") for c in documents.columns]
    )


def line_report(
    documents: DataFrame, least: int = MIN_CHARS, enough: int = MIN_DOCUMENTS
) -> DataFrame:
    """A row per document row: doc_id, n_lines, n_dropped and the text that stays.

    As `dedup_lines`; a null text is reported as empty, which is one empty line.
    """
    out = _deduplicated(documents.select("doc_id", "text"), least, enough, "kept_text", "n_dropped")
    text = F.coalesce(F.col("text"), F.lit(""))
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return out.select(
        "doc_id",
        (breaks + 1).cast("long").alias("n_lines"),
        "n_dropped",
        F.coalesce(F.col("kept_text"), F.lit("")).alias("kept_text"),
    )


def op11_line_dedup(documents: DataFrame) -> DataFrame:
    return line_report(documents).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


#: The same rows by unnesting all lines.
ORACLE = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS place FROM d),
k AS (
  SELECT doc_id, place, line, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
gone AS (
  SELECT key, max(doc_id) AS keeps FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (
  SELECT k.doc_id, place, line,
    gone.key IS NOT NULL AND k.doc_id IS DISTINCT FROM gone.keeps AS dropped
  FROM k LEFT JOIN gone USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
