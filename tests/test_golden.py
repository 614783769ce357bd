"""The counts FIXTURES.md section 4 gives for the dirty raw view, per scale factor."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import (
    city_month_distribution,
    city_revenue,
    dedup_latest,
    duplicate_keys,
    invalid_rows,
    keep_equal,
    normalize_orders,
    tidy_orders,
)
from cartwheel.plans.registry import passes_gate
from cartwheel.sources import raw_orders

from .conftest import SF001, SF01

SF1 = "/root/testdata/sf0.1"

GOLDEN = {
    SF001: dict(raw=1530, invalid=89, dup_keys=29, dedup_valid=1412, dedup_all=1469, tidy=1513, kolkata=240),
    SF01: dict(raw=15300, invalid=897, dup_keys=293, dedup_valid=14120, dedup_all=14679, tidy=15141, kolkata=2177),
    SF1: dict(raw=153000, invalid=8958, dup_keys=2936, dedup_valid=141220, dedup_all=146786, tidy=151422, kolkata=21818),
}


@pytest.mark.parametrize("sf_dir", [SF001, SF01, SF1])
def test_fixture_counts(spark, sf_dir):
    want = GOLDEN[sf_dir]
    raw = raw_orders(spark, sf_dir)
    norm = normalize_orders(raw)
    tidy = tidy_orders(raw)
    got = dict(
        raw=raw.count(),
        invalid=invalid_rows(norm).count(),
        dup_keys=duplicate_keys(norm).count(),
        dedup_valid=dedup_latest(normalize_orders(passes_gate(raw))).count(),
        dedup_all=dedup_latest(norm).count(),
        tidy=tidy.count(),
        kolkata=keep_equal(tidy, "city", "Kolkata").count(),
    )
    assert got == want
    assert city_month_distribution(tidy).count() == 91
    assert city_revenue(tidy).count() == 7


def test_sf01_null_counts(spark):
    norm = normalize_orders(raw_orders(spark, SF01))
    row = norm.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in
                     ("order_id", "customer_id", "order_date", "order_amount", "updated_at")]).first()
    assert tuple(row) == (329, 0, 185, 194, 211)
    assert keep_equal(raw_orders(spark, SF01), "city", "Kolkata").count() == 1700
