"""F1-F4, D1, A1-A6, O1, Q1-Q6, L1 on small inputs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import (
    QualityError,
    city_month_distribution,
    city_revenue,
    constraint_violations,
    dedup_latest,
    duplicate_keys,
    exists,
    exists_flag,
    gate_month,
    gate_required,
    invalid_rows,
    keep_equal,
    keep_present,
    normalize_orders,
    quality_report,
    require_columns,
    row_count,
    tidy_orders,
)
from cartwheel.schema import CONFORMED_SCHEMA, ORDER_COLUMNS, RAW_SCHEMA


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


ROW = ("900017", "C7777", "2025-11-20", "Home", "Pune", "512.25", "SHIPPED", "PAID", "2025-11-21 18:30:15")


def with_(**kw):
    values = dict(zip(ORDER_COLUMNS, ROW))
    values.update(kw)
    return tuple(values[c] for c in ORDER_COLUMNS)


def test_f1_tidy_filters_before_cast(spark):
    df = raw(spark, [with_(order_id=None), with_(order_id="abc"), with_(city="  DELHI ")])
    out = tidy_orders(df).collect()
    assert len(out) == 2
    assert sorted([r.order_id is None for r in out]) == [False, True]
    assert {r.city for r in out} == {"Pune", "Delhi"}
    assert out[0].updated_month == 11


def test_f2_exact_case(spark):
    df = raw(spark, [with_(city="Kolkata"), with_(city="KOLKATA"), with_(city=" Kolkata")])
    assert keep_equal(df, "city", "Kolkata").count() == 1
    assert keep_present(df, "city").count() == 3


def test_normalize_schema_and_extra_columns(spark):
    df = raw(spark, [ROW]).withColumn("extra", F.lit(1))
    out = normalize_orders(df)
    assert out.schema == CONFORMED_SCHEMA
    assert out.first().order_amount == Decimal("512.25")


def test_q1_missing_columns_sorted(spark):
    df = raw(spark, [ROW]).drop("updated_at", "city")
    with pytest.raises(ValueError, match="city, updated_at"):
        require_columns(df, ORDER_COLUMNS)
    with pytest.raises(ValueError, match="city, updated_at"):
        normalize_orders(df)


def test_d1_latest_wins_and_ties_are_defined(spark):
    rows = [
        with_(order_id="1", updated_at="2026-01-01 00:00:00", city="A"),
        with_(order_id="1", updated_at="2026-01-03 00:00:00", city="B"),
        with_(order_id="1", updated_at=None, city="Z"),
        with_(order_id="2", updated_at="2026-01-01 00:00:00", city="A"),
        with_(order_id="2", updated_at="2026-01-01 00:00:00", city="C"),
        with_(order_id=None, city="N1"),
        with_(order_id=None, city="N2"),
    ]
    df = normalize_orders(raw(spark, rows))
    got = {r.order_id: r.city for r in dedup_latest(df).collect()}
    assert got == {1: "B", 2: "C", None: "N2"}


def test_d1_same_result_for_any_partitioning(spark):
    rows = [with_(order_id=str(i % 50), updated_at=f"2026-01-{1 + i % 28:02d} 00:00:00", city=f"c{i}") for i in range(400)]
    df = normalize_orders(raw(spark, rows))
    a = sorted(dedup_latest(df.repartition(1)).collect())
    b = sorted(dedup_latest(df.repartition(7)).collect())
    assert a == b and len(a) == 50


def test_d1_hot_key_is_combined_before_shuffle(spark):
    # One key holds most rows: the plan must aggregate partially per task.
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("order_id"),
        F.col("id").cast("string").alias("city"),
        (F.lit(dt.datetime(2026, 1, 1)) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id") % 1000)).cast("timestamp_ntz").alias("updated_at"),
    )
    out = dedup_latest(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert out.filter("order_id = 7").count() == 1


def test_a1_a4_exact_average(spark):
    # 10,000 amounts of 0.01 and 10,001 of 0.00: exact mean 0.00499975 -> 0.00.
    df = spark.range(0, 20001).select(
        F.lit("X").alias("city"),
        F.when(F.col("id") < 10000, F.lit(Decimal("0.01"))).otherwise(F.lit(Decimal("0.00"))).cast("decimal(12,2)").alias("order_amount"),
    )
    row = city_revenue(df).first()
    assert row.order_count == 20001
    assert row.total_revenue == Decimal("100.00")
    assert row.average_order_value == Decimal("0.00")


def test_a1_counts_null_amounts_average_skips_them(spark):
    df = spark.createDataFrame(
        [("A", Decimal("10.00")), ("A", None), ("A", Decimal("20.01")), ("B", None)],
        "city string, order_amount decimal(12,2)",
    )
    got = {r.city: r for r in city_revenue(df).collect()}
    assert got["A"].order_count == 3
    assert got["A"].average_order_value == Decimal("15.01")  # 30.01 / 2 = 15.005 -> half up
    assert got["B"].order_count == 1 and got["B"].average_order_value is None


def test_a5_o1_city_month_sorted(spark):
    rows = [
        with_(city="B", updated_at="2026-02-01 00:00:00"),
        with_(city="A", updated_at="2026-03-01 00:00:00"),
        with_(city="A", updated_at="2025-03-09 00:00:00"),
        with_(city="A", updated_at="2026-01-05 00:00:00"),
        with_(city="A", updated_at=None),
    ]
    out = city_month_distribution(normalize_orders(raw(spark, rows))).collect()
    assert [(r.city, r.month, r.record_count) for r in out] == [
        ("A", None, 1),
        ("A", 1, 1),
        ("A", 3, 2),
        ("B", 2, 1),
    ]


def test_a5_with_year_keeps_years_apart(spark):
    rows = [with_(city="A", updated_at="2026-03-01 00:00:00"), with_(city="A", updated_at="2025-03-09 00:00:00")]
    out = city_month_distribution(normalize_orders(raw(spark, rows)), with_year=True).collect()
    assert [(r.month, r.record_count) for r in out] == [(202503, 1), (202603, 1)]


def test_a6_row_count(spark):
    assert row_count(spark.range(123)).first()[0] == 123


def test_f3_q2_gate(spark):
    good = normalize_orders(raw(spark, [ROW]))
    bad = normalize_orders(raw(spark, [ROW, with_(order_amount="n/a"), with_(order_date="2026-13-01")]))
    assert invalid_rows(bad).count() == 2
    assert gate_required(good)["invalid_rows"] == 0
    with pytest.raises(QualityError, match="nothing was written"):
        gate_required(bad)
    rep = quality_report(bad).first()
    assert (rep.row_count, rep.null_order_amount, rep.null_order_date, rep.invalid_rows) == (3, 1, 1, 2)


def test_q3_month_gate(spark):
    df = normalize_orders(raw(spark, [ROW, with_(updated_at=None)])).withColumn("month", F.month("updated_at"))
    with pytest.raises(QualityError, match="updated_at"):
        gate_month(df)
    assert gate_month(df.filter("month IS NOT NULL"))["row_count"] == 1


def test_q4_l1_empty_and_exists(spark):
    empty = raw(spark, [])
    assert not exists(empty)
    assert exists(raw(spark, [ROW]))
    assert exists_flag(empty, "x").first().x is False
    assert exists_flag(raw(spark, [ROW, ROW]), "x").first().x is True


def test_q5_constraint_violations(spark):
    df = normalize_orders(raw(spark, [ROW, with_(customer_id="C" * 40, order_id=None)]))
    got = {(r.constraint_name, r.column_name): r.violations for r in constraint_violations(df).collect()}
    assert got[("not_null", "order_id")] == 1
    assert got[("max_length", "customer_id")] == 1
    assert got[("not_null", "updated_at")] == 0
    assert len(got) == 10


def test_q6_duplicate_keys(spark):
    df = normalize_orders(raw(spark, [ROW, ROW, with_(order_id="2"), with_(order_id=None), with_(order_id=None)]))
    assert [(r.order_id, r.copies) for r in duplicate_keys(df).collect()] == [(900017, 2)]
