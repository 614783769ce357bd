"""Driver contract and every registered query against its DuckDB oracle."""

from __future__ import annotations

import importlib.util
import os

import pytest

from cartwheel.plans.oracles import ORACLES
from cartwheel.plans.registry import QUERIES

from .conftest import ROOT, SF01
from .oracle_compare import compare, duckdb_connection


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_on_sf0001(spark):
    mod = _entry_module()
    df = mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 7
    assert df.columns == ["city", "order_count", "total_revenue", "average_order_value"]
    assert sum(r.order_count for r in rows) == 1513


def test_every_query_has_an_oracle():
    mod = _entry_module()
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(mod.queries()) and set(ORACLES) <= set(mod.oracle_sql()) <= set(mod.queries())


@pytest.fixture(scope="module")
def duck():
    return duckdb_connection(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_sf001(spark, duck, name):
    result = compare(spark, duck, name, SF01)
    assert result["ok"], result
    assert not result["type_issues"], result


@pytest.mark.parametrize("name", ["register_csv_inferred", "normalize_orders", "tidy_orders", "city_extract"])
def test_query_matches_oracle_in_other_session_settings(spark, duck, name):
    """The driver's session may use another time zone (with DST gaps) or ANSI off."""
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        result = compare(spark, duck, name, SF01)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.unset("spark.sql.ansi.enabled")
    assert result["ok"], result
