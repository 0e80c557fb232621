"""Scalar functions (X1-X7) on hand-worked values."""

import datetime as dt

from pyspark.sql import functions as F

from panelgrowth.functions import clean as C


def _one(spark, expr, values, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_zero_pad_keeps_long_codes(spark):
    assert _one(spark, lambda c: C.zero_pad(c, 8), ["7", "123456789", "12345678", None]) == \
        ["00000007", "123456789", "12345678", None]
    assert _one(spark, lambda c: C.zero_pad(c, 2), ["1", "01", ""]) == ["01", "01", "00"]


def test_lenient_double(spark):
    got = _one(spark, C.lenient_double, ["12.5", "-", "", "1d", "NaN", "1,000", "  3", "-2e3", ".5", None])
    assert got == [12.5, None, None, None, None, None, None, -2000.0, 0.5, None]


def test_round_half_even_on_binary_doubles(spark):
    vals = [0.575, 0.145, 1.005, 2.675, 0.125, -0.575]
    got = _one(spark, C.round2, vals, "x double")
    assert got == [0.57, 0.14, 1.0, 2.68, 0.12, -0.57]


def test_pct_round_scales_then_rounds(spark):
    got = _one(spark, C.pct_round, [0.00125, 0.2, None], "x double")
    assert got == [0.12, 20.0, None]


def test_strip_all_whitespace(spark):
    got = _one(spark, C.strip_all, ["  a b\t\r\n", "\x0bx\x0c", "", None])
    assert got == ["a b", "x", "", None]


def test_remove_and_month(spark):
    assert _one(spark, C.month_from_period, ["M01", "M13", "MM2"]) == ["01", "13", "2"]
    assert _one(spark, lambda c: C.remove(c, "\r"), ["a\rb\r", "c"]) == ["ab", "c"]


def test_ytd_months():
    assert C.ytd_months_for(dt.date(2024, 3, 15)) == 2
    assert C.ytd_months_for(dt.date(2024, 1, 10)) == 0
