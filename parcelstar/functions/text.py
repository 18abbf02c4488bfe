"""Text normalisation: place names, states, street addresses, zip codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelstar.constants import STATE_CODES, STREET_SUFFIXES, WHITE_SPACE


def clean_name(c: Column) -> Column:
    """Strip white space of every kind from both ends and lowercase."""
    # btrim with the character list: F.trim alone strips blanks only.
    return F.lower(F.btrim(c, F.lit(WHITE_SPACE)))


def expand_state(c: Column) -> Column:
    """Two-letter code, any case, to the lowercase state name; other text is lowercased."""
    names = F.create_map(
        *[F.lit(text.lower()) for name, code in STATE_CODES.items() for text in (code, name)]
    )
    return F.coalesce(names[F.lower(c)], F.lower(c))


def state_code(c: Column) -> Column:
    """Full state name, as spelled in the contract, to its code; NULL when unknown."""
    codes = F.create_map(*[F.lit(text) for pair in STATE_CODES.items() for text in pair])
    return codes[c]


def known_state(c: Column) -> Column:
    """The value if it is a full state name; anything else raises when it is read."""
    message = F.concat(F.lit("unknown state name: "), F.coalesce(c, F.lit("NULL")))
    return F.when(state_code(c).isNotNull(), c).otherwise(F.raise_error(message))


def shorten_street(c: Column) -> Column:
    """Abbreviate the first occurrence of each street suffix, whole words only.

    One pattern shortens all words of a text in which none comes twice; only a text with a
    repeated word is searched word by word. Both look at a word's boundaries after its letters.
    """
    words = "|".join(word for word, _ in STREET_SUFFIXES)
    initials = "".join(sorted({word[0] for word, _ in STREET_SUFFIXES}))
    letters = "|".join(_kept_letters(word, short) for word, short in STREET_SUFFIXES)
    # The groups of words that do not match are empty.
    kept = "".join(f"${i}" for i in range(1, sum(len(short) for _, short in STREET_SUFFIXES) + 1))
    once = F.regexp_replace(c, rf"(?U)(?=[{initials}])\b(?:{letters})\b", kept)
    each = c
    for word, short in STREET_SUFFIXES:
        # The match runs to the end of the text, so there is no second one.
        each = F.regexp_replace(each, rf"(?Us)(?={word})\b{word}\b(.*)", f"{short}$1")
    repeated = F.rlike(c, F.lit(rf"(?Us)(?=[{initials}])\b({words})\b.*(?=\1)\b\1\b"))
    return F.when(repeated, each).otherwise(once)


def _kept_letters(word: str, short: str) -> str:
    """Pattern of a word with a group for each letter of its abbreviation, which are in order."""
    pattern, rest = "", word
    for letter in short:
        skipped, _, rest = rest.partition(letter)
        pattern += f"{skipped}({letter})"
    return pattern + rest


def zip_text(c: Column, mode: str = "canonical") -> Column:
    """Numeric zip code as text.

    `canonical` gives the five digits the API feed uses; `legacy` keeps the plain
    number-to-text cast (78701.0 -> '78701.0').
    """
    if mode == "legacy":
        return c.cast("string")
    if mode != "canonical":
        raise ValueError(f"unknown zip mode: {mode}")
    whole = c.try_cast("bigint")
    digits = whole.cast("string")
    return F.when(whole < 100_000, F.lpad(digits, 5, "0")).otherwise(digits)
