"""Benchmark decontamination by winnowed fingerprints.

Each text keeps the least k-gram hash of every window of `span - k + 1` k-grams. Two texts
that share `span` words in a row share such a window, so they keep a fingerprint in
common: joining the fingerprints and extending each hit word by word finds every shared
passage of `span` words or more. An item of fewer words is one window of its own length
and is looked up by the hash of that window.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstar.llm.expressions import (
    ascii_lower,
    covered,
    let,
    window_hashes,
    window_minima,
    words_between,
)
from parcelstar.llm.membership import split_by_membership
from parcelstar.session import write_through

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN, K = 13, 8
#: Bits of a fingerprint that hold its place, modulo 64.
PLACE_BITS = 6
#: Fingerprint rows up to which the benchmark is broadcast, about 250 bytes each.
#: Words of 64 bits of the bitmap of short items.
MARKS = 1 << 10
BROADCAST_ROWS = 250_000
KEY = ["_doc", "_text"]

ENTRY = "array<struct<pos:int,fp:bigint,left:int,ctx:array<bigint>>>"


def benchmark_words(text: Column) -> Column:
    """Words of the contract: runs of a-z, 0-9 and characters beyond ASCII."""
    return words_between(ascii_lower(text), SEPARATORS)


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _grams(hashes: Column, k: int) -> Column:
    """k-gram hashes with the place in the lowest bits."""
    low = (1 << PLACE_BITS) - 1
    return F.transform(
        window_hashes(hashes, k),
        lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.bitwiseAND(F.lit(low)).cast("long")),
    )


def _context(hashes: Column, pos: Column, span: int, k: int) -> Column:
    """Fingerprint rows carry the words a hit can be extended by."""
    left = F.least(pos, F.lit(span - k))
    return F.struct(
        left.alias("left"),
        F.slice(hashes, pos - left + 1, left + F.lit(span)).alias("ctx"),
    )


def _entry(pos: Column, packed: Column, hashes: Column, span: int, k: int) -> Column:
    context = _context(hashes, pos, span, k)
    return F.struct(
        pos.alias("pos"),
        F.shiftright(packed, PLACE_BITS).alias("fp"),
        context["left"].alias("left"),
        context["ctx"].alias("ctx"),
    )


def _place(packed: Column, window: Column) -> Column:
    """Place of the least k-gram of a window that starts at `window`."""
    low = (1 << PLACE_BITS) - 1
    return window + F.pmod(packed.bitwiseAND(F.lit(low)).cast("int") - window, F.lit(low + 1))


def _document_entries(hashes: Column, span: int, k: int) -> Column:
    """One entry per place that is the least of a window; ties go to one of them."""

    def entries(h: Column) -> Column:
        full = F.greatest(F.size(h) - (span - 1), F.lit(0))
        minima = F.slice(window_minima(_grams(h, k), span - k + 1), F.lit(1), full)
        return let(
            minima,
            lambda m: F.filter(
                F.transform(
                    m,
                    lambda x, i: F.when(
                        (i == 0) | (x != F.get(m, i - 1)),
                        let(_place(x, i), lambda pos: _entry(pos, x, h, span, k)),
                    ),
                ),
                lambda e: e.isNotNull(),
            ),
        )

    return F.when(F.size(hashes) >= span, let(hashes, entries)).otherwise(F.array().cast(ENTRY))


def _item_entries(hashes: Column, span: int, k: int) -> Column:
    """One entry per place that is the least of a window, with all ties."""

    def entries(h: Column) -> Column:
        full = F.size(h) - (span - 1)
        return let(
            _grams(h, k),
            lambda g: F.flatten(
                F.transform(
                    F.slice(window_minima(g, span - k + 1), F.lit(1), full),
                    lambda x, i: F.filter(
                        F.transform(
                            F.sequence(i, i + (span - k)),
                            lambda p: F.when(
                                F.shiftright(F.get(g, p), PLACE_BITS)
                                == F.shiftright(x, PLACE_BITS),
                                _entry(p, x, h, span, k),
                            ),
                        ),
                        lambda e: e.isNotNull(),
                    ),
                )
            ),
        )

    return F.when(F.size(hashes) >= span, let(hashes, entries)).otherwise(F.array().cast(ENTRY))


def _keyed(documents: DataFrame) -> DataFrame:
    """Documents are told apart by id and text, so that repeated ids do not mix."""
    return documents.select(
        F.col("doc_id").alias("_doc"),
        F.xxhash64(F.col("text")).alias("_text"),
        benchmark_words(F.col("text")).alias("_words"),
    )


def _long_items(benchmark: DataFrame, span: int, k: int) -> DataFrame:
    return (
        benchmark.select(
            F.col("item_id").alias("_item"),
            _hashes(benchmark_words(F.col("text"))).alias("_h"),
        )
        .select("_item", F.inline_outer(_item_entries(F.col("_h"), span, k)))
        .where(F.col("fp").isNotNull())
        .select(
            "_item", F.col("fp"), F.col("left").alias("_ileft"), F.col("ctx").alias("_ictx")
        )
        .distinct()
    )


def _short_items(benchmark: DataFrame, span: int) -> DataFrame:
    return (
        benchmark.select(
            F.col("item_id").alias("_item"),
            _hashes(benchmark_words(F.col("text"))).alias("_h"),
        )
        .where((F.size("_h") > 0) & (F.size("_h") < span))
        .select(
            "_item",
            F.size("_h").alias("_length"),
            _item_hash(F.col("_h")).alias("fp"),
        )
        .distinct()
    )


def _extended(span: int, k: int) -> Column:
    """The shared run around a fingerprint as (first, last), null if below `span`."""

    def same(offset: Column) -> Column:
        return F.coalesce(
            F.get("ctx", F.col("left") + offset) == F.get("_ictx", F.col("_ileft") + offset),
            F.lit(False),
        )

    reach = span - k
    before = F.aggregate(
        F.sequence(F.lit(1), F.lit(reach)),
        F.lit(0),
        lambda a, j: F.when((a == j - 1) & same(-j), j).otherwise(a),
    )
    after = F.aggregate(
        F.sequence(F.lit(k), F.lit(k + reach - 1)),
        F.lit(k - 1),
        lambda a, j: F.when((a == j - 1) & same(j), j).otherwise(a),
    )
    core = F.forall(F.sequence(F.lit(0), F.lit(k - 1)), same)
    run = let(
        F.struct(before.alias("b"), after.alias("a")),
        lambda r: F.when(
            r["b"] + r["a"] + 1 >= span,
            F.struct(
                (F.col("pos") - r["b"]).alias("first"), (F.col("pos") + r["a"]).alias("last")
            ),
        ),
    )
    return F.when(F.col("_item_found") & core, run)


def _joined(rows: DataFrame, items: DataFrame, small: bool, span: int, k: int) -> DataFrame:
    """Rows of documents with the spans that fingerprints of items extend to."""
    right = items.withColumn("_item_found", F.lit(True))
    return (
        rows.join(F.broadcast(right) if small else right, "fp", "left")
        .withColumn("_item_found", F.coalesce("_item_found", F.lit(False)))
        .withColumn("_span", _extended(span, k))
        .where(F.col("_span").isNotNull() | (F.col("pos") == -1))
        .select(*KEY, "_n", "pos", "_item", "_span")
    )


def _document_rows(documents: DataFrame, span: int, k: int) -> DataFrame:
    """A row per document with pos -1, and one per fingerprint."""
    marker = F.array(
        F.struct(
            F.lit(-1).alias("pos"),
            F.lit(None).cast("long").alias("fp"),
            F.lit(0).alias("left"),
            F.array().cast("array<bigint>").alias("ctx"),
        )
    )
    return (
        _keyed(documents)
        .select(*KEY, _hashes(F.col("_words")).alias("_h"))
        .select(*KEY, F.size("_h").alias("_n"), "_h")
        .select(
            *KEY, "_n", F.inline_outer(F.concat(marker, _document_entries(F.col("_h"), span, k)))
        )
    )


def _narrowed(documents: DataFrame, items: DataFrame, span: int, k: int) -> DataFrame:
    """Rows of `_document_rows`, without fingerprints that no item has.

    For a benchmark too large to broadcast: only key, place and hash of the documents'
    fingerprints are shuffled; the words around them follow for those that met.
    """
    rows = _document_rows(documents, span, k)
    met = (
        rows.select(*KEY, "pos", "fp")
        .where(F.col("fp").isNotNull())
        .join(items.select("fp").distinct(), "fp", "left_semi")
        .groupBy(*KEY)
        .agg(F.collect_set("pos").alias("_met"))
        .select(F.col("_doc").alias("_d"), F.col("_text").alias("_t"), "_met")
    )
    return (
        rows.join(met, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_text") == F.col("_t")), "left")
        .where((F.col("pos") == -1) | F.coalesce(F.array_contains("_met", F.col("pos")), F.lit(False)))
        .drop("_d", "_t", "_met")
    )


def _item_hash(hashes: Column) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x))


def _word_and_bit(hashed: Column) -> tuple[Column, Column]:
    return F.shiftright(hashed, 6).bitwiseAND(F.lit(MARKS - 1)), hashed.bitwiseAND(F.lit(63)).cast("int")


def _marks(items: DataFrame) -> Column:
    """A bitmap of the items' hashes, as a constant array of MARKS words."""
    word, bit = _word_and_bit(F.col("fp"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    rows = items.groupBy(word.alias("word")).agg(F.bit_or(one).alias("bits")).collect()
    words = {r["word"]: r["bits"] for r in rows}
    return F.array(*[F.lit(words.get(i, 0)).cast("long") for i in range(MARKS)])


def _short_windows(hashes: Column, lengths: list[int], marks: Column) -> Column:
    """All windows of these lengths that may be items: (length, pos, fp)."""
    def marked(hashed: Column) -> Column:
        word, bit = _word_and_bit(hashed)
        shifted = F.call_function("shiftrightunsigned", F.get(marks, word.cast("int")), bit)
        return shifted.bitwiseAND(F.lit(1)) == 1

    def of_length(h: Column, n: int) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(h) - n, F.lit(0))),
            lambda i: F.struct(
                F.lit(n).alias("_length"), i.alias("pos"), _item_hash(F.slice(h, i + 1, n)).alias("fp")
            ),
        )
        return F.filter(windows, lambda w: (w["pos"] + n <= F.size(h)) & marked(w["fp"]))

    return let(hashes, lambda h: F.flatten(F.array(*[of_length(h, n) for n in lengths])))


def _short_hits(documents: DataFrame, items: DataFrame, small: bool, lengths: list[int]) -> DataFrame:
    """Occurrences of items with fewer words than a span, of all lengths from one pass.

    Windows that the bitmap of the items rules out never become rows.
    """
    keyed = _keyed(documents).select(*KEY, _hashes(F.col("_words")).alias("_h"))
    windows = keyed.select(*KEY, F.inline(_short_windows(F.col("_h"), lengths, _marks(items))))
    end = F.col("pos") + F.col("_length") - 1
    return windows.join(F.broadcast(items) if small else items, ["_length", "fp"]).select(
        *KEY,
        F.lit(None).cast("int").alias("_n"),
        "pos",
        "_item",
        F.struct(F.col("pos").alias("first"), end.alias("last")).alias("_span"),
    )


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    span: int = SPAN,
    k: int = K,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Words of each document that lie in passages of the benchmark.

    Returns a row per document row: doc_id, n_words, n_hit, n_items, items (array of
    item_ids as sorted strings), spans (array of (first, last) word places, maximal
    within the fingerprints' reach, possibly overlapping) and `text_key`.

    Null or empty texts have no words. A document without id is kept with a null id. An
    item without words is never met; one without id counts for n_hit, not for items.
    Repeated items count by their id, repeated document rows give repeated rows.
    """
    items = write_through(_long_items(benchmark, span, k), "benchmark-fingerprints")
    short = write_through(_short_items(benchmark, span), "benchmark-short")
    small = items.count() <= broadcast_rows
    rows = _document_rows(documents, span, k) if small else _narrowed(documents, items, span, k)
    hits = _joined(rows, items, small, span, k)
    lengths = sorted(r[0] for r in short.select("_length").distinct().collect())  # below span
    if lengths:
        few = short.count() <= broadcast_rows
        hits = hits.unionByName(_short_hits(documents, short, few, lengths))
    grouped = hits.groupBy(*KEY).agg(
        F.max("_n").alias("_n"),
        F.sum((F.col("pos") == -1).cast("int")).alias("_copies"),
        F.array_sort(F.collect_set(F.col("_item").cast("string"))).alias("items"),
        F.collect_set("_span").alias("spans"),
    )
    # A repeated row repeats the spans, not the marker of the row.
    return grouped.select(
        F.col("_doc").alias("doc_id"),
        F.col("_text").alias("text_key"),
        F.col("_n").cast("long").alias("n_words"),
        covered(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        "spans",
        F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"),
    ).drop("_copy")


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those of which a twentieth or more is benchmark text."""
    bad = write_through(
        contamination(documents, benchmark)
        .where(is_contaminated(F.col("n_hit"), F.col("n_words")))
        .select(F.col("doc_id").alias("_bad_doc"), F.col("text_key").alias("_bad_text"))
        .distinct(),
        "contaminated",
    )
    maybe, clean = split_by_membership(documents, "doc_id", bad, "_bad_doc")
    own = maybe["doc_id"].eqNullSafe(bad["_bad_doc"])
    same = F.xxhash64(maybe["text"]) == bad["_bad_text"]
    return clean.union(maybe.join(bad, own & same, "left_anti"))


def op1_decontamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = contamination(documents, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


#: The same rows by unnesting words and joining whole windows.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
    array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s
        FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, dw.n, s FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, n, s FROM hit))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
