"""Scalar functions on hand-made edge values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fairweather import functions as fn
from fairweather.functions.text import WHITE_SPACE, parse_number

AS_OF = dt.datetime(2026, 12, 1)


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_parse_day_follows_day_month_year(spark):
    values = ["1-2-2024", "01-02-2024", " 1-2-2024", "31-02-2024", "2024-02-01", "01-02-2024 ",
              "bad-date", "", None, "001-2-2024", "01-13-2024", "29-02-2024", "01-01-0001"]
    first = dt.date(2024, 2, 1)
    assert apply(spark, fn.parse_day, values) == [
        first, first, first, None, None, None, None, None, None, None, None,
        dt.date(2024, 2, 29), dt.date(1, 1, 1),
    ]


def test_department_key(spark):
    values = ["2A", "01", " 31 ", "31", "31.0", " 2B ", None]
    assert apply(spark, fn.department_key, values) == ["2A", "1", "31", "31", "31.0", "2B", None]


def test_clean_key_strips_what_python_strips(spark):
    assert all(c.isspace() for c in WHITE_SPACE)
    # every white space character of the basic plane is covered
    assert {chr(c) for c in range(0x10000) if chr(c).isspace()} == set(WHITE_SPACE)
    values = ["\t a b  ", " x\n", "   ", "", None, "a\tb"]
    assert apply(spark, fn.clean_key, values) == ["a b", "x", "", "", None, "a\tb"]


@pytest.mark.parametrize(
    ("text", "number"),
    [("12,3", 12.3), ("12.3", 12.3), ("12", 12.0), ("-0,5", -0.5), ("abc", None), ("1,2,3", None),
     ("1d", None), ("0x1F", None), ("", None), (None, None), (",5", 0.5), ("1e2", 100.0)],
)
def test_parse_decimal_comma(spark, text, number):
    assert apply(spark, fn.parse_decimal_comma, [text]) == [number]


def test_parse_number_takes_points_only(spark):
    assert apply(spark, parse_number, ["1.5", "1,5", "x", "1f", None]) == [1.5, None, None, None, None]


def test_null_tokens_are_exact(spark):
    assert apply(spark, fn.null_tokens, [*fn.NULL_TOKENS, "na", " NA", "0", None]) == (
        [None] * len(fn.NULL_TOKENS) + ["na", " NA", "0", None]
    )


def test_parse_validity(spark):
    rows = [
        ("2000-01-02 06:00:00", ""),
        ("2000-01-02 06:00:00", None),
        ("2000-01-02 06:00:00", "2001-01-01 00:00:00"),
        ("2000-01-02 06:00:00", "soon"),
        ("2000-01-02", ""),
        (None, ""),
    ]
    df = spark.createDataFrame(rows, "a string, b string")
    start, end = fn.parse_validity(F.col("a"), F.col("b"), AS_OF)
    opened = dt.datetime(2000, 1, 2, 6)
    assert [tuple(r) for r in df.select(start, end).collect()] == [
        (opened, AS_OF), (opened, AS_OF), (opened, dt.datetime(2001, 1, 1)), (opened, None),
        (None, AS_OF), (None, AS_OF),
    ]


def test_validity_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2024-03-31 02:30:00", "")], "a string, b string")
    start, _ = fn.parse_validity(F.col("a"), F.col("b"), AS_OF)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        # this local time does not exist in Paris
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
        assert df.select(start).first()[0] == dt.datetime(2024, 3, 31, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_keys_skip_null_parts_and_keep_empty_ones(spark):
    df = spark.createDataFrame(
        [(" 1 rue ", None, "Paris "), ("x", "", "y"), (None, None, None)], "a string, p string, c string"
    )
    key = fn.address_key(F.col("a"), F.col("p"), F.col("c"))
    assert [r[0] for r in df.select(key).collect()] == ["1 rue, Paris", "x, , y", ""]
    row = spark.createDataFrame([(43.6, 1e-5, "31", None)], "a double, b double, d string, j string")
    combined = fn.combination_key(F.col("a"), F.col("b"), F.col("d"), F.col("j"))
    assert row.select(combined).first()[0] == "43.6_1.0E-5_31"


def test_day_bounds(spark):
    day = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date")
    assert tuple(day.select(*fn.day_bounds(F.col("d"))).first()) == (
        "2024-02-29T00:00:00Z", "2024-02-29T23:59:59Z",
    )
