from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark import clean


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


NATIONAL = [
    ("SE", "19850101-1234", "198501011234"),
    ("SE", "19850101-12345678", "198501011234"),
    ("NO", "010185 12345 99", "01018512345"),
    ("DK", "010185-1234", "0101851234"),
    ("FI", "010185-123a", "010185-123A"),
    ("FI", "010185+123ab", "010185+123A"),
    ("XX", "010185-1234", None),
    (None, "010185-1234", None),
    ("SE", None, None),
    ("SE", "", ""),
]


def test_national_id_by_market(spark):
    rows = [(m, v) for m, v, _ in NATIONAL]
    got = values(spark, rows, "m string, v string", clean.national_id(F.col("v"), F.col("m")))
    assert got == [e for _, _, e in NATIONAL]


def test_national_id_literal_market_and_lenient_form(spark):
    rows = [("0",), ("000",), ("010185-123a",), ("12",)]
    strict = clean.national_id(F.col("v"), "FI", zero_to_null=True)
    assert values(spark, rows, "v string", strict) == [None, None, "010185-123A", "12"]
    lenient = clean.national_id(F.col("v"), "XX", fallback_digits=True)
    assert values(spark, rows, "v string", lenient) == ["0", "000", "010185123", "12"]


PHONES = [
    # A leading blank before the plus is dropped, nothing else happens.
    ("SE", " +46 70 123", "+46 70 123"),
    # Numbers with a plus lose blanks and must have 7 to 17 characters.
    ("SE", "+46 70 123 45 67", "+46701234567"),
    ("SE", "+46 12", None),
    ("XX", "+4670123456", "+4670123456"),
    ("SE", "+123456789012345678", None),
    # Finland
    ("FI", "358401234567", "+358401234567"),
    ("FI", "35840", None),
    ("FI", "0401234567", "+358401234567"),
    ("FI", "012345", None),
    ("FI", "401234567", "+358401234567"),
    ("FI", "40123", None),
    # Sweden and Denmark have no length check
    ("SE", "46701234567", "+46701234567"),
    ("SE", "046701234567", "+46701234567"),
    ("SE", "0046701234567", "+46701234567"),
    ("SE", "0701234567", "+46701234567"),
    ("SE", "701234567", "+46701234567"),
    ("DK", "4512345678", "+4512345678"),
    ("DK", "12345678", "+4512345678"),
    # Norway checks lengths; a prefix that fails its length falls through only where the test includes it
    ("NO", "4712345678", "+4712345678"),
    ("NO", "47123456", None),
    ("NO", "04712345678", "+4712345678"),
    ("NO", "004712345678", "+4712345678"),
    ("NO", "047123456", "+4747123456"),
    ("NO", "012345678", "+4712345678"),
    ("NO", "12345678", "+4712345678"),
    ("NO", "1234567", None),
    # unknown markets and missing values
    ("XX", "12345678", None),
    ("SE", None, None),
]


def test_phone_by_market(spark):
    rows = [(m, v) for m, v, _ in PHONES]
    got = values(spark, rows, "m string, v string", clean.phone(F.col("v"), F.col("m")))
    assert got == [e for _, _, e in PHONES]


@pytest.mark.parametrize("market", ["SE", "FI", "NO", "DK"])
def test_literal_market_equals_column_market(spark, market):
    rows = [(v,) for _, v, _ in PHONES]
    by_column = values(spark, rows, "v string", clean.phone(F.col("v"), F.lit(market)))
    assert values(spark, rows, "v string", clean.phone(F.col("v"), market)) == by_column


def test_flags_differ_on_null(spark):
    rows = [("0",), ("1",), ("2",), (None,)]
    v = F.col("v")
    assert values(spark, rows, "v string", clean.flag_is_one(v)) == [False, True, False, False]
    assert values(spark, rows, "v string", clean.flag_not_zero(v)) == [False, True, True, True]
    assert values(spark, rows, "v string", clean.flag_not_zero_or_null(v)) == [False, True, True, False]


def test_zero_dates_and_safe_times(spark):
    rows = [("0000-00-00 00:00:00",), ("2020-01-02 03:04:05",), (None,)]
    floor = clean.zero_date(F.col("v"), clean.ZERO_DATE_REPLACEMENT).cast("timestamp").cast("string")
    assert values(spark, rows, "v string", floor) == ["1900-01-01 00:00:00", "2020-01-02 03:04:05", None]
    assert values(spark, rows, "v string", clean.zero_date(F.col("v")))[0] is None
    rows = [("2020-01-02",), ("0000",), ("12",), ("junk",), (None,)]
    safe = clean.safe_timestamp(F.col("v")).cast("date").cast("string")
    assert values(spark, rows, "v string", safe) == ["2020-01-02", None, None, None, None]


def test_click_id_absent_and_empty(spark):
    rows = [("?gclid=a&x=1",), ("?gclid=&x=1",), ("?x=1",), (None,)]
    assert values(spark, rows, "v string", clean.click_id(F.col("v"), "gclid")) == ["a", "", None, None]


def test_emptiness_follows_the_type(spark):
    number, text = clean.not_blank(F.col("v"), T.LongType()), clean.not_blank(F.col("v"), T.StringType())
    assert values(spark, [(0,), (1,), (None,)], "v long", F.coalesce(number, F.lit(False))) == [False, True, False]
    assert values(spark, [("",), ("0",), (None,)], "v string", F.coalesce(text, F.lit(False))) == [False, True, False]
    assert values(spark, [("",), ("0",), (None,)], "v string", clean.blank(F.col("v"), T.StringType())) == [
        True,
        False,
        True,
    ]


def test_paths_and_names(spark):
    rows = [("gs://b/x/2024/1/9/f.json",)]
    assert str(values(spark, rows, "v string", clean.date_from_path(F.col("v")))[0]) == "2024-01-09"
    assert str(values(spark, rows, "v string", clean.date_from_path_pattern(F.col("v")))[0]) == "2024-01-09"
    rows = [("payload.National_ID",), ("National_ID",), ("a.b.c_d",)]
    assert values(spark, rows, "v string", clean.path_name_key(F.col("v"))) == ["nationalid", "nationalid", "b.cd"]
