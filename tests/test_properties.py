"""D1 and A1-A4 against a brute-force Python model on random small inputs."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartwheel.operators import city_revenue, dedup_latest
from cartwheel.schema import CONFORMED_SCHEMA

_keys = st.one_of(st.none(), st.integers(min_value=1, max_value=6))
_ts = st.one_of(st.none(), st.integers(min_value=0, max_value=5).map(lambda h: dt.datetime(2026, 1, 1, h)))
_text = st.one_of(st.none(), st.sampled_from(["A", "B", "Kolkata", "Pune"]))
_money = st.one_of(st.none(), st.integers(min_value=0, max_value=50000).map(lambda c: Decimal(c) / 100))

_row = st.tuples(
    _keys,
    _text,
    st.one_of(st.none(), st.just(dt.date(2026, 1, 2))),
    _text,
    _text,
    _money,
    _text,
    _text,
    _ts,
)

SETTINGS = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def _sort_key(row):
    # The survivor order: updated_at first, then the other columns in table
    # order without the key; NULL is smallest.
    ordered = (row[8],) + tuple(row[1:8])
    return tuple((v is not None, v if v is not None else 0) for v in ordered)


def _expected_dedup(rows):
    best = {}
    for r in rows:
        k = r[0]
        if k not in best or _sort_key(r) > _sort_key(best[k]):
            best[k] = r
    return sorted(best.values(), key=repr)


@SETTINGS
@given(st.lists(_row, min_size=0, max_size=25))
def test_dedup_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, CONFORMED_SCHEMA)
    got = sorted((tuple(r) for r in dedup_latest(df).collect()), key=repr)
    assert got == _expected_dedup(rows)


@SETTINGS
@given(st.lists(st.tuples(_text, _money), min_size=0, max_size=30))
def test_city_revenue_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "city string, order_amount decimal(12,2)")
    expected = {}
    for city, amount in rows:
        n, total, k = expected.get(city, (0, None, 0))
        if amount is not None:
            total = (total or Decimal(0)) + amount
            k += 1
        expected[city] = (n + 1, total, k)
    want = {
        c: (n, t, None if k == 0 else (t / k).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
        for c, (n, t, k) in expected.items()
    }
    got = {r.city: (r.order_count, r.total_revenue, r.average_order_value) for r in city_revenue(df).collect()}
    assert got == want
