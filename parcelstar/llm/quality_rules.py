"""Quality rules as a short-circuit cascade.

Each rule is a column that is true where a document fails. A bounded sample tells what a
rule costs and how much it rejects; the rules then run in the order of rejection per cost,
and a document that fails one is not put to the later ones. The order changes the time
only: a document is kept if and only if no rule fails.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstar.llm.expressions import SPACES, let, window_hashes, words_between
from parcelstar.session import write_through

#: Rows of the sample that costs and selectivity are estimated on.
SAMPLE_ROWS = 500
#: Timed runs of a rule over the sample.
RUNS = 3
WINDOW = 8


class Rule(NamedTuple):
    """`fails` takes the text (not null) and its words, and gives a boolean."""

    name: str
    fails: Callable[[Column, Column], Column]


def _left(text: Column, pattern: str) -> Column:
    """Characters that stay when a pattern is taken out."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def n_words(words: Column) -> Column:
    return F.size(words).cast("long")


def word_chars(text: Column) -> Column:
    return _left(text, SPACES)


def n_symbols(text: Column) -> Column:
    return _left(text, r"[^#*$%&|<>]+")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _covered_from(starts: Column, width: int) -> Column:
    """Places in windows of `width` that begin at sorted starts."""
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("until"), F.lit(0).cast("long").alias("total")),
        lambda s, x: F.struct(
            (x + width).alias("until"),
            (s["total"] + (x + width - F.greatest(s["until"], x))).alias("total"),
        ),
        lambda s: s["total"],
    )


def n_repeat_words(words: Column, width: int = WINDOW) -> Column:
    """Words in windows of `width` words that a text has twice or more.

    Most texts repeat no window, which the number of distinct hashes tells. In the
    others the windows are sorted by hash, so that equal ones lie side by side.
    """
    zero = F.lit(0).cast("long")

    def repeated(k: Column) -> Column:
        pairs = F.sort_array(
            F.transform(k, lambda x, i: F.struct(x.alias("hash"), i.alias("at")))
        )
        starts = let(
            pairs,
            lambda z: F.filter(
                F.transform(
                    z,
                    lambda e, j: F.when(
                        F.coalesce(F.get(z, j - 1)["hash"] == e["hash"], F.lit(False))
                        | F.coalesce(F.get(z, j + 1)["hash"] == e["hash"], F.lit(False)),
                        e["at"],
                    ),
                ),
                lambda p: p.isNotNull(),
            ),
        )
        return F.when(F.size(F.array_distinct(k)) == F.size(k), zero).otherwise(
            _covered_from(F.sort_array(starts), width)
        )

    def windows(w: Column) -> Column:
        hashes = window_hashes(F.transform(w, lambda x: F.xxhash64(x)), width)
        return let(F.slice(hashes, F.lit(1), F.size(w) - (width - 1)), repeated)

    return F.when(F.size(words) > width, windows(words)).otherwise(zero)


def _ascii_letters(text: Column, letters: str) -> Column:
    return _left(text, f"[^{letters}]+")


def _n_stutters(words: Column) -> Column:
    """Words equal to the one before."""
    return F.size(
        F.filter(words, lambda x, i: F.coalesce(F.get(words, i - 1) == x, F.lit(False)))
    ).cast("long")


#: A text must have 20 words, of which at most 30 % lie in repeated windows.
BASE = [
    Rule("too few words", lambda t, w: n_words(w) < 20),
    Rule("repeated windows", lambda t, w: 100 * n_repeat_words(w) > 30 * n_words(w)),
]
#: Shares that prose stays well away from.
PROSE = [
    Rule("symbols", lambda t, w: 10 * n_symbols(t) > n_words(w)),
    Rule(
        "word length",
        lambda t, w: (word_chars(t) < 2 * n_words(w)) | (word_chars(t) > 12 * n_words(w)),
    ),
    Rule(
        "capitals",
        lambda t, w: _ascii_letters(t, "A-Z") > _ascii_letters(t, "a-z"),
    ),
    Rule(
        "few letters",
        lambda t, w: 10
        * (word_chars(t) - _left(t, r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"))
        > 6 * word_chars(t),
    ),
    Rule(
        "repeated lines",
        lambda t, w: 10 * n_dup_lines(t) > 4 * F.size(_lines(t)),
    ),
    Rule("stutter", lambda t, w: 5 * _n_stutters(w) > n_words(w)),
]


def _text(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def _failed(text: Column, words: Column, rules: list[Rule]) -> Column:
    """The first rule that fails, null if none does; later ones are not worked out."""
    tests = [F.when(r.fails(text, words), F.lit(r.name)) for r in rules]
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


def ordered(
    documents: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """The rules by rejection per cost on a sample of at most `sample_rows` rows.

    The sample is drawn with a chance that gives about so many rows of the whole table, and
    takes all rows of a small one. It sets the order only. A rule costs what the fastest of
    some runs takes.
    """
    source = documents.select(F.col(text).alias("_t"))
    share = 1.2 * sample_rows / max(1, documents.count())
    drawn = source.sample(share, seed=1) if share < 1 else source
    sample = write_through(drawn.limit(sample_rows), "rules-sample")
    sample = sample.select(_text(F.col("_t")).alias("_t"))

    def measured(fails: Callable[[Column, Column], Column] | None) -> tuple[float, float]:
        words = words_between(F.col("_t"), SPACES)
        test = let(words, lambda w: fails(F.col("_t"), w) if fails else F.size(w) < 0)
        query = sample.agg(F.avg(test.cast("double")), F.count("*"))
        query.collect()  # the first run compiles
        seconds = []
        for _ in range(RUNS):
            began = time.perf_counter()
            rejected, _ = query.collect()[0]
            seconds.append(time.perf_counter() - began)
        return rejected or 0.0, min(seconds)

    _, plain = measured(None)
    rates = []
    for rule in rules:
        rejected, seconds = measured(rule.fails)
        rates.append(rejected / max(seconds - plain, 1e-3))
    # A rule that rejects nothing in the sample still counts: the cheapest come first.
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: -rates[i])]


def keep_quality(documents: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The documents that no rule rejects, all columns as they are.

    Null, empty and wordless texts have fewer than 20 words and go. Repeated rows are
    judged one by one, rows without id too.
    """
    cascade = ordered(documents, BASE + PROSE if rules is None else rules)
    text = _text(documents["text"])
    failed = let(words_between(text, SPACES), lambda w: _failed(text, w, cascade))
    return documents.where(failed.isNull())


def measures(documents: DataFrame) -> DataFrame:
    """doc_id, `_text`, `_words` and the measures of the base rules, a row per document."""
    text = F.col("_text")
    return (
        documents.select(F.col("doc_id"), _text(F.col("text")).alias("_text"))
        .select("doc_id", "_text", words_between(text, SPACES).alias("_words"))
        .select(
            "doc_id",
            "_text",
            "_words",
            n_words(F.col("_words")).alias("n_words"),
            word_chars(text).alias("word_chars"),
            n_symbols(text).alias("n_symbols"),
            n_dup_lines(text).alias("n_dup_lines"),
            n_repeat_words(F.col("_words")).alias("n_repeat_words"),
        )
    )


def op2_quality_rules(documents: DataFrame) -> DataFrame:
    cascade = ordered(documents, PROSE)
    base_failed = (F.col("n_words") < 20) | (
        100 * F.col("n_repeat_words") > 30 * F.col("n_words")
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return (
        measures(documents)
        .select("doc_id", "_text", "_words", *counts, base_failed.alias("base_failed"))
        .select(
            "doc_id",
            *counts,
            "base_failed",
            F.when(F.col("base_failed"), F.lit(False))
            .otherwise(_failed(F.col("_text"), F.col("_words"), cascade).isNull())
            .alias("kept"),
        )
    )


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM t),
g AS (
  SELECT doc_id, s, array_to_string(w[s:s + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS s FROM w WHERE len(w) > 8)),
r AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
    SELECT doc_id, unnest(range(s, s + 8)) AS p FROM (
      SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1)
  GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    len(l) AS n_lines,
    length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_upper,
    length(regexp_replace(t, '[^a-z]+', '', 'g')) AS n_lower,
    length(regexp_replace(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]+', '', 'g')) AS n_letters,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters
  FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words
    OR word_chars < 2 * n_words OR word_chars > 12 * n_words
    OR n_upper > n_lower OR 10 * (word_chars - n_letters) > 6 * word_chars
    OR 10 * n_dup_lines > 4 * n_lines OR 5 * n_stutters > n_words) AS kept
FROM b
"""
