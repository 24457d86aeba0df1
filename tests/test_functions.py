"""Edge cases of the column functions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom import functions as sf


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,expected", [
    (None, "BLANK"),
    ("", "BLANK"),
    ("   ", "BLANK"),
    (" united states. ", "UNITED STATES"),
    ("don’t know", "DON'T KNOW"),
    ("don`t know", "DON'T KNOW"),
    ('"(a) [b]; c: d,"', "A B C D"),
    ("a\tb\nc\rd", "A B C D"),
    ("a" + " " * 17 + "b", "A  B"),   # four halving passes leave 2 of 17 blanks
    ("a" + " " * 16 + "b", "A B"),
])
def test_normalize_text(spark, raw, expected):
    assert one(spark, sf.normalize_text, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("U.S.A.", "UNITED STATES"), ("us", "UNITED STATES"), ("England", "UNITED KINGDOM"),
    ("Canada", "CANADA"), (None, "BLANK"),
])
def test_normalize_country(spark, raw, expected):
    assert one(spark, sf.normalize_country, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("none", "0"), ("No Days", "0"), ("05", "5"), ("30", "30"), ("31", "NOT FOUND"),
    ("88", "88"), ("77", "77"), ("", "BLANK"), ("abc", "NOT FOUND"), ("12.0", "NOT FOUND"),
])
def test_normalize_days(spark, raw, expected):
    assert one(spark, sf.normalize_days, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("25.0", "25"), (" 6 ", "6"), ("25.7", "25"), ("1e1", "10"), ("nan", None), ("1d", None),
    ("Infinity", None), ("", None), (None, None), ("-3", "-3"),
])
def test_canonical_code(spark, raw, expected):
    assert one(spark, sf.canonical_code, raw) == expected


@pytest.mark.parametrize("raw,expected", [("32", 32), ("32.0", None), ("abc", None), (" 7 ", 7)])
def test_try_int(spark, raw, expected):
    assert one(spark, sf.try_int, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("17", "Not Found"), ("18", "18-24"), ("24", "18-24"), ("25", "25-34"), ("65", "65+"),
    ("99", "65+"), ("32.0", "Not Found"), ("abc", "Not Found"), (None, "Not Found"),
])
def test_age_band(spark, raw, expected):
    assert one(spark, sf.band, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("01152024", dt.date(2024, 1, 15)), ("1152024", dt.date(2024, 1, 15)),
    ("13452024", None), ("abc", None), (None, None),
])
def test_date_from_digits(spark, raw, expected):
    assert one(spark, sf.date_from_digits, raw) == expected


def test_date_from_parts(spark):
    df = spark.createDataFrame([("2024", "4", None), ("2024.0", "13", None), ("2024", "2.5", None),
                                ("x", "1", None), ("2024", "1", dt.date(2020, 5, 5))],
                               "y string, m string, d date")
    got = [r[0] for r in df.select(sf.date_from_parts("y", "m", "d")).collect()]
    assert got == [dt.date(2024, 4, 1), None, None, None, dt.date(2020, 5, 5)]


@pytest.mark.parametrize("raw,expected", [
    ("  abc\t", "abc"), ("nan", None), (" N/A ", None), ("None", None), ("abc ", "abc"), (None, None),
])
def test_clean_text(spark, raw, expected):
    assert one(spark, sf.clean_text, raw) == expected


@pytest.mark.parametrize("raw,expected", [("b'01152024'", "01152024"), ("b''", None), ("'x'", "x")])
def test_clean_special_text(spark, raw, expected):
    assert one(spark, sf.clean_special_text, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    (" Y ", "Yes"), ("TRUE", "Yes"), ("0", "No"), ("Don't know", "Don't know"), ("dont know", "Don't know"),
    ("maybe", "Maybe"), ("whatever", "whatever"), ("null", None),
])
def test_yes_no(spark, raw, expected):
    assert one(spark, sf.yes_no, raw) == expected


def test_percent_text(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 5), (1, 0), (1, 32)], "a long, b long")
    got = [r[0] for r in df.select(sf.percent_text("a", "b")).collect()]
    assert got == ["12.50 %", "33.33 %", "66.67 %", "0.00 %", None, "3.13 %"]


def test_decimal_avg_and_weighted(spark):
    df = spark.createDataFrame([(1, 1.005, 2), (1, 2.0, 1), (1, None, 5)], "k int, v double, n int")
    r = df.groupBy("k").agg(sf.decimal_avg("v").alias("a"), sf.weighted_avg("v", "n").alias("w")).first()
    assert r["a"] == Decimal("1.50")        # NULL skipped, (1.005 + 2.0) / 2 = 1.5025 -> 1.50
    # SUM(v*n) / SUM(n): a NULL value still adds its weight, (1.005*2 + 2*1) / 8 = 0.50
    assert r["w"] == Decimal("0.50")


def test_row_hash_keeps_null_slots(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    h = [r[0] for r in df.select(sf.row_hash(["x", "y", "z"])).collect()]
    assert h[0] != h[1] and len(h[0]) == 64
