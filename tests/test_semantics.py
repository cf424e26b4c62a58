"""Column helpers against values worked out by hand."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from courierlake import functions as fx


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def ts(text):
    return F.lit(text).cast("timestamp")


@pytest.mark.parametrize(
    "text,want",
    [
        ("out-for_delivery ok", "Out-For_Delivery Ok"),
        ("thai/palace (a) [b] o'neil", "Thai/Palace (A) [B] O'neil"),
        ("DELIVERED", "Delivered"),
        ("a\tb\\c|d", "A\tB\\C|D"),
        ("", ""),
        (None, None),
        ("3rd street", "3rd Street"),
        ("x&y~z^w", "X&Y~Z^W"),
    ],
)
def test_title_case(spark, text, want):
    assert one(spark, fx.title_case(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("a,b,low,high", [(1, 2, 1, 2), (None, 2, None, None), (3, None, None, None)])
def test_least_and_greatest_propagate_null(spark, a, b, low, high):
    x, y = F.lit(a).cast("int"), F.lit(b).cast("int")
    assert one(spark, fx.least_or_null(x, y)) == low
    assert one(spark, fx.greatest_or_null(x, y)) == high


@pytest.mark.parametrize(
    "part,a,b,want",
    [
        ("minute", "2020-01-01 10:00:50", "2020-01-01 10:01:10", 1),
        ("minute", "2020-01-01 10:00:00", "2020-01-01 10:00:59", 0),
        ("minute", "2020-01-01 10:01:00", "2020-01-01 10:00:59", -1),
        ("month", "2000-09-30", "2001-09-01", 12),
        ("month", "2001-08-31", "2001-09-01", 1),
        ("year", "1999-12-31", "2000-01-01", 1),
        ("day", "2001-08-31 23:59:59", "2001-09-01 00:00:00", 1),
    ],
)
def test_date_diff_counts_boundaries(spark, part, a, b, want):
    assert one(spark, fx.date_diff_boundary(part, ts(a), ts(b))) == want


def test_date_diff_rejects_unknown_part():
    with pytest.raises(ValueError):
        fx.date_diff_boundary("century", F.lit(1), F.lit(2))


@pytest.mark.parametrize("x,want", [(12.7, 13), (12.5, 13), (-12.5, -13), (12.4, 12), (None, None)])
def test_to_int_rounds_half_away(spark, x, want):
    assert one(spark, fx.to_int(F.lit(x).cast("double"))) == want


@pytest.mark.parametrize(
    "text,want",
    [("on", True), ("Off", False), ("1", True), ("n", False), (" TRUE ", True), ("maybe", None), (None, None)],
)
def test_try_boolean(spark, text, want):
    assert one(spark, fx.try_boolean(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(
    "text,want",
    [("09:05", "09:05:00"), ("23:59:58", "23:59:58"), ("bad", None), ("25:00", None), (None, None)],
)
def test_try_time(spark, text, want):
    assert one(spark, fx.try_time(F.lit(text).cast("string"))) == want


def test_timestamp_needs_both_parts(spark):
    day, none = F.lit("2001-02-03").cast("date"), F.lit(None).cast("string")
    assert one(spark, fx.timestamp_from_parts(day, F.lit("04:05:06"))) == datetime(2001, 2, 3, 4, 5, 6)
    assert one(spark, fx.timestamp_from_parts(day, none)) is None
    assert one(spark, fx.timestamp_from_parts(none.cast("date"), F.lit("04:05:06"))) is None


@pytest.mark.parametrize("x,want", [(10.0, "10"), (12.5, "12.5"), (0.25, "0.25"), (100.0, "100"), (0.0, "0")])
def test_number_label(spark, x, want):
    assert one(spark, fx.number_label(F.lit(x))) == want


def test_ratios_guard_zero_and_round_half_up(spark):
    assert one(spark, fx.safe_ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, fx.safe_ratio(F.lit(Decimal("10.01")), F.lit(2))) == Decimal("5.01")
    assert one(spark, fx.decimal_ratio(F.lit(954.275), F.lit(49))) == 19.48
    assert one(spark, fx.percent(F.lit(1), F.lit(8))) == 12.5


def test_ratio_of_long_decimals_is_not_rounded_twice(spark):
    top, bottom = F.lit("1.499999").cast("decimal(38,8)"), F.lit("300").cast("decimal(38,8)")
    assert one(spark, fx.safe_ratio(top, bottom)) == 0
    assert one(spark, fx.safe_ratio(F.lit("1.5").cast("decimal(38,8)"), bottom)) == Decimal("0.01")


def test_conditional_sum_is_zero_not_null(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    row = df.agg(fx.sum_if(F.col("k") == "b", "v").alias("s"), fx.count_if_true(F.lit(None).cast("boolean")).alias("c")).first()
    assert (row.s, row.c) == (0, 0)


def test_surrogate_keys(spark):
    ids = spark.range(20000).select(F.concat(F.lit("O"), "id").alias("id"))
    ids = ids.unionByName(spark.createDataFrame([(None,)], "id string"))
    keys = ids.select(fx.surrogate_key("id").alias("sk"))
    assert keys.filter("sk IS NULL OR sk < 0").count() == 0
    assert keys.distinct().count() == 20001


def test_try_date(spark):
    assert one(spark, fx.try_date(F.lit("2001-02-03"))) == date(2001, 2, 3)
    assert one(spark, fx.try_date(F.lit("bad"))) is None
