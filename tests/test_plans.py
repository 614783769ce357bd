"""Plan shapes that matter at scale, checked on the physical plans Spark picks."""

from __future__ import annotations

import pytest

from cartwheel.operators import city_revenue, tidy_orders
from cartwheel.plans.registry import QUERIES
from cartwheel.sinks.files import write_parquet_by_month
from cartwheel.sources import raw_orders

from .conftest import SF001

# Operators that would mean a pair explosion, a Python row path or a driver collect.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "CollectLimit")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_no_python_rows(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    assert not [op for op in FORBIDDEN if op in plan], plan


def test_fixture_needs_no_join(spark):
    plan = _plan(raw_orders(spark, SF001))
    assert "Join" not in plan


def test_revenue_prunes_columns_and_combines_before_shuffle(spark):
    df = city_revenue(tidy_orders(raw_orders(spark, SF001)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning(city") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan and "HashAggregate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_month_write_rebalances(spark, out):
    from pyspark.sql import functions as F

    df = tidy_orders(raw_orders(spark, SF001)).filter("updated_month IS NOT NULL").withColumnRenamed(
        "updated_month", "month"
    )
    logical = df.hint("rebalance", "month")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in logical
    assert write_parquet_by_month(df, out) == df.count()
    assert spark.read.parquet(out).filter(F.col("month") == 1).count() == df.filter("month = 1").count()


def _partial_before_exchange(plan: str) -> bool:
    """True when a map-side aggregate sits below the first key exchange."""
    lines = plan.splitlines()
    ex = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    return bool(ex) and any("Aggregate" in line for line in lines[ex[0] + 1 :])


def test_keyed_aggregates_combine_before_shuffle(spark, db):
    from pyspark.sql import functions as F

    from cartwheel.operators import dedup_latest, duplicate_keys, normalize_orders
    from cartwheel.sinks import create_table_if_missing

    # One key holds a third of all rows.
    norm = normalize_orders(raw_orders(spark, SF001)).withColumn(
        "order_id", F.when(F.col("order_id") % 3 == 0, F.lit(1)).otherwise(F.col("order_id"))
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _partial_before_exchange(_plan(dedup_latest(norm)))
        assert _partial_before_exchange(_plan(duplicate_keys(norm)))
        assert _partial_before_exchange(_plan(city_revenue(norm)))
        name = f"{db}.orders"
        create_table_if_missing(spark, name)
        existing = spark.table(name).select("order_id").distinct()
        batch = norm.groupBy("order_id").count()
        assert _partial_before_exchange(_plan(batch.join(existing, "order_id", "left")))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    hot = duplicate_keys(norm).filter("order_id = 1").first()
    assert hot.copies == norm.filter("order_id = 1").count()
