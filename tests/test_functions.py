from datetime import date

import pytest
from pyspark.sql import functions as F

from parcelstar.constants import STREET_SUFFIXES
from parcelstar.functions import dates, text
from parcelstar.functions.aggregates import mean, percent_change
from parcelstar.functions.property_types import type_from_bedrooms, type_from_label


def apply(spark, function, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_clean_name_strips_every_kind_of_space(spark):
    given = ["Alabama", " Oregon ", "oregon", "\t Eugene \n", " El Paso ", "", None, "\r\n"]
    assert apply(spark, text.clean_name, given) == [
        "alabama", "oregon", "oregon", "eugene", "el paso", "", None, "",
    ]


def test_expand_state(spark):
    given = ["AL", "al", "Or", "DC", " OR", None, "oregon"]
    assert apply(spark, text.expand_state, given) == [
        "alabama", "alabama", "oregon", "dc", " or", None, "oregon",
    ]


def test_state_code(spark):
    given = ["Oregon", "New York", "oregon", "Guam", None]
    assert apply(spark, text.state_code, given) == ["OR", "NY", None, None, None]


def test_shorten_street_first_whole_word_only(spark):
    given = [
        "48 Cedar Street", "456 Oak Avenue", "1 Street Street", "1 Street Street Ln",
        "9 Streetside Court", "5 main street", "A Drive\nB Drive", "7 Boulevard Road Lane", None,
        "Street",
    ]
    assert apply(spark, text.shorten_street, given) == [
        "48 Cedar St", "456 Oak Ave", "1 St Street", "1 St Street Ln",
        "9 Streetside Ct", "5 main street", "A Dr\nB Drive", "7 Blvd Rd Ln", None, "St",
    ]


def test_shorten_street_as_word_by_word(spark):
    words = [word for word, _ in STREET_SUFFIXES]
    pairs = [f"1 {a} {b}{end}" for a in words for b in words for end in ("", " x", "side", "\u0301")]
    given = [
        *pairs, " ".join(words), " ".join([*words, *words]), "StreetStreet", "Street_Street",
        "Street-Street", "\u00e9Street Street", "Lane\nLane Court", "Stree Lan $1 Road\\", "", None,
    ]

    def word_by_word(c):
        for word, short in STREET_SUFFIXES:
            c = F.regexp_replace(c, rf"(?Us)\b{word}\b(.*)", f"{short}$1")
        return c

    assert apply(spark, text.shorten_street, given) == apply(spark, word_by_word, given)


def test_shorten_street_searches_a_text_once_unless_a_word_comes_twice(spark):
    df = spark.createDataFrame([("1 Main Street",)], "v string")
    plan = df.select(text.shorten_street(F.col("v")))._jdf.queryExecution().analyzed().toString()
    otherwise = plan.split(" ELSE ")[1].split(" END")[0]
    assert otherwise.count("regexp_replace") == 1


def test_zip_text(spark):
    given = [97401.0, 601.0, 123456.0, None]
    assert apply(spark, text.zip_text, given, "double") == ["97401", "00601", "123456", None]
    legacy = apply(spark, lambda c: text.zip_text(c, "legacy"), given[:1], "double")
    assert legacy == ["97401.0"]
    with pytest.raises(ValueError, match="zip mode"):
        text.zip_text(F.col("v"), "other")


def test_plain_date(spark):
    given = ["2019-07-04", "not-a-date", "2020-13-01", "2020-1-5", None]
    assert apply(spark, dates.plain_date, given) == [date(2019, 7, 4), None, None, None, None]


def test_iso_instant_date(spark):
    given = ["2023-11-20T00:00:00.000Z", "2023-11-20T23:59:59.999Z", "2025-01-01", "x", None]
    assert apply(spark, dates.iso_instant_date, given) == [
        date(2023, 11, 20), date(2023, 11, 20), None, None, None,
    ]


def test_type_from_bedrooms(spark):
    given = [0.0, 1.0, 4.0, 4.5, 5.0, 20.0, -1.0, None]
    assert apply(spark, type_from_bedrooms, given, "double") == [
        "studio", "single_family", "single_family", "unknown", "multi_family", "multi_family",
        "single_family", "unknown",
    ]


def test_type_from_label(spark):
    given = ["Single Family", "Condo", "Townhouse", "Multi-Family", "Land", "condo", None]
    assert apply(spark, type_from_label, given) == [
        "single_family", "condo", "townhouse", "multi_family", "unknown", "unknown", "unknown",
    ]


def test_division_by_zero_gives_null(spark):
    row = spark.range(1).select(
        percent_change(F.lit(0.0), F.lit(5.0)), percent_change(F.lit(200.0), F.lit(250.0)),
        mean(F.lit(1.0), F.lit(0)),
    ).first()
    assert tuple(row) == (None, 25.0, None)
