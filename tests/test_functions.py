"""Column conversions on small hand-written cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions import parse
from cartwheel.functions.hashing import choice, padded_id, uniform_cents, uniform_int
from cartwheel.functions.text import tidy_city


def _one(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_p3_to_long_bad_and_padded(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = _one(spark, ["abc", " 5 ", "42", None, "X89"])
        got = [r[0] for r in df.select(parse.to_long(df, "v")).collect()]
        assert got == [None, 5, 42, None, None]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_p6_to_date_strict(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = _one(spark, ["2026-13-01", "2026-1-2", "2026-01-02 03:00:00", "2026-01-02", None])
        got = [r[0] for r in df.select(parse.to_date(df, "v")).collect()]
        assert got == [None, None, None, dt.date(2026, 1, 2), None]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_p7_to_timestamp_strict_and_zone_free(spark):
    df = _one(spark, ["2026-01-02", "2026-01-02 03:04:05", "2026-02-30 00:00:00", "n/a"])
    out = df.select(parse.to_timestamp(df, "v").alias("t"))
    assert out.schema["t"].dataType == T.TimestampNTZType()
    assert [r[0] for r in out.collect()] == [None, dt.datetime(2026, 1, 2, 3, 4, 5), None, None]


def test_p7_session_zone_does_not_shift(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist in New York on this day (DST starts).
        df = _one(spark, ["2026-03-08 02:30:00"])
        assert df.select(parse.to_timestamp(df, "v")).first()[0] == dt.datetime(2026, 3, 8, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_p5_to_money_rounding_and_overflow(spark):
    df = _one(spark, ["12.345", "99999999999.99", "n/a", "10723.48", " 7 "])
    got = [r[0] for r in df.select(parse.to_money(df, "v")).collect()]
    assert got == [Decimal("12.35"), None, None, Decimal("10723.48"), Decimal("7.00")]


def test_typed_input_passes_through(spark):
    df = spark.createDataFrame(
        [(dt.date(2026, 1, 2), dt.datetime(2026, 1, 2, 3, 0), 12.5, 7)],
        "d date, ts timestamp, amt double, n int",
    )
    row = df.select(
        parse.to_date(df, "d"),
        parse.to_timestamp(df, "ts"),
        parse.to_money(df, "amt"),
        parse.to_long(df, "n"),
        parse.to_text(df, "n"),
    ).first()
    assert row[0] == dt.date(2026, 1, 2)
    assert row[1] == dt.datetime(2026, 1, 2, 3, 0)
    assert row[2] == Decimal("12.50")
    assert row[3] == 7
    assert row[4] == "7"


def test_x1_x2_tidy_city(spark):
    df = _one(spark, ["NEW-delhi o'neil", "  DELHI ", "kolkata", None])
    got = [r[0] for r in df.select(tidy_city(F.col("v"))).collect()]
    assert got == ["New-delhi O'neil", "Delhi", "Kolkata", None]


def test_x9_x10_draws(spark):
    df = spark.range(1, 2001).select(
        uniform_int(42, "a", F.col("id"), 1, 300).alias("u"),
        choice(42, "b", F.col("id"), ["x", "y", "z"]).alias("c"),
        uniform_cents(42, "m", F.col("id"), 30000, 7500000).alias("m"),
        padded_id("C", F.col("id"), 4).alias("p"),
    )
    agg = df.agg(
        F.min("u"), F.max("u"), F.countDistinct("c"), F.min("m"), F.max("m"), F.max(F.length("p"))
    ).first()
    assert 1 <= agg[0] and agg[1] <= 300 and agg[1] > 250
    assert agg[2] == 3
    assert agg[3] >= Decimal("300.00") and agg[4] <= Decimal("75000.00")
    assert agg[5] == 5
    assert df.filter(F.col("p") == "C0007").count() == 1


def test_p7_one_cast_agrees_with_the_strict_pattern(spark):
    from pyspark.sql import functions as F

    from cartwheel.functions import parse
    from cartwheel.schema import TIMESTAMP_FORMAT

    odd = [
        "2026-01-02 07:00:00", "2024-02-29 23:59:59", "2026-02-29 00:00:00", "2026-02-30 00:00:00", "2026-13-01 00:00:00",
        "2026-01-02 24:00:00", "2026-01-02 23:60:00", "2026-01-02 23:59:60", "0000-01-01 00:00:00", "0001-01-01 00:00:00",
        "9999-12-31 23:59:59", "10000-01-01 00:00:00", "2026-1-2 7:0:0", "2026-01-02", "2026-01-02T07:00:00", "2026-01-02 07:00:00.5",
        "2026-01-02 07:00:00Z", "2026-01-02 07:00:00 ", " 2026-01-02 07:00:00", "2026-01-02 07:00:00\n", "２０26-01-02 07:00:00", "", "x", None,
        "2026-03-08 02:30:00", "2026-01-02 07:00:00+01:00", "-2026-01-02 07:00:00",
    ]
    df = spark.createDataFrame([(x,) for x in odd], "t string")
    strict = F.when(F.try_to_timestamp("t", F.lit(TIMESTAMP_FORMAT)).isNotNull(), F.col("t").try_cast("timestamp_ntz"))
    rows = df.select("t", parse.to_timestamp(df, "t").cast("string").alias("got"), strict.cast("string").alias("want")).collect()
    assert [(r.t, r.got) for r in rows] == [(r.t, r.want) for r in rows]
    assert sum(r.got is not None for r in rows) == 7


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_p3_one_rule_for_text_and_numbers(spark, ansi):
    cases = [("5.0", 5), ("5.", 5), (" -7.000 ", -7), ("5.5", None), ("5.0x", None), (".0", None), ("1e3", None), ("9223372036854775808.0", None), ("", None), (None, None)]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        text = spark.createDataFrame([(v,) for v, _ in cases], "v string")
        assert [r[0] for r in text.select(parse.to_long(text, "v")).collect()] == [want for _, want in cases]
        numbers = spark.createDataFrame([(5.0, Decimal("5.00")), (5.5, Decimal("5.50")), (-7.0, Decimal("-7")), (float("nan"), None), (1e30, None)], "d double, m decimal(10,2)")
        got = [tuple(r) for r in numbers.select(parse.to_long(numbers, "d"), parse.to_long(numbers, "m")).collect()]
        assert got == [(5, 5), (None, None), (-7, -7), (None, None), (None, None)]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
