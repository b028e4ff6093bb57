"""Metric states advanced day by day against the full computation."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from barloom.operators.metric_state import (
    advance,
    metric_state,
    metrics_from_state,
    rebuild,
)
from barloom.operators.risk import risk_metrics
from barloom.schemas import METRIC_COLUMNS
from tests.conftest import START, table


def walk(seed: int, days: int, start: float = 100.0) -> list[float]:
    dice, out = random.Random(seed), [start]
    for _ in range(days - 1):
        out.append(round(out[-1] * (1 + dice.gauss(0, 0.02)), 4))
    return out


def until(prices, day):
    return prices.where(F.col("date") <= START + timedelta(days=day))


def on(prices, day):
    return prices.where(F.col("date") == START + timedelta(days=day))


def kept(spark, tmp_path, state, number):
    path = str(tmp_path / f"state-{number}")
    state.write.parquet(path)
    return spark.read.parquet(path)


def assert_same(left, right):
    got, want = table(left, "ticker"), table(right, "ticker")
    assert [r["ticker"] for r in got] == [r["ticker"] for r in want]
    for a, b in zip(got, want):
        assert (a["window_start"], a["window_end"]) == (b["window_start"], b["window_end"])
        for name in METRIC_COLUMNS:
            assert a[name] == pytest.approx(b[name], abs=1e-9), (a["ticker"], name)


@pytest.fixture
def market(closes):
    return closes(
        LONG=walk(1, 260),
        GAPS=[c if i % 3 else None for i, c in enumerate(walk(2, 260))],
        YOUNG=[None] * 250 + walk(3, 10),
        FLAT=[50.0] * 260,
        ZERO=walk(4, 120) + [0.0] + walk(5, 139),
        GONE=walk(6, 200) + [None] * 60,
        PAIR=[None] * 258 + [10.0, 9.0],
    )


def test_a_state_of_all_bars_gives_the_full_metric_set(market):
    assert_same(metrics_from_state(metric_state(market), digits=None), risk_metrics(market, digits=None))


def test_each_day_equals_the_full_computation(spark, tmp_path, market):
    state = kept(spark, tmp_path, metric_state(until(market, 248)), 0)
    for day in range(249, 260):
        state = kept(spark, tmp_path, advance(state, on(market, day)), day)
        known = until(market, day)
        assert_same(metrics_from_state(rebuild(state, known), digits=None), risk_metrics(known, digits=None))


def test_a_batch_may_hold_many_days(market):
    later = market.where(F.col("date") > START + timedelta(days=100))
    state = advance(metric_state(until(market, 100)), later)
    assert_same(metrics_from_state(rebuild(state, market), digits=None), risk_metrics(market, digits=None))


def test_the_tail_stays_short(closes):
    [row] = metric_state(closes(A=walk(7, 1000))).collect()
    assert row.returns == 999 and 51 <= len(row.tail) <= 110 and row.tail == sorted(row.tail)


def test_ties_at_the_cut_are_kept(closes):
    prices = closes(A=[100.0 if i % 2 else 90.0 for i in range(400)])
    assert_same(metrics_from_state(metric_state(prices), digits=None), risk_metrics(prices, digits=None))


def test_a_worn_tail_is_rebuilt(closes):
    calm = [1000.0]
    for _ in range(1500):
        calm.append(calm[-1] * 1.001)
    prices = closes(A=walk(8, 300) + calm, B=walk(9, 300))
    later = prices.where(F.col("date") >= START + timedelta(days=300))
    state = advance(metric_state(until(prices, 299)), later)
    assert {r.ticker: r.stale for r in state.collect()} == {"A": True, "B": False}
    with pytest.raises(PySparkException, match="stale metric state of A"):
        metrics_from_state(state).collect()
    assert_same(metrics_from_state(rebuild(state, prices), digits=None), risk_metrics(prices, digits=None))


def test_a_late_bar_makes_its_ticker_stale(market):
    state = metric_state(market.where(F.col("date") != START + timedelta(days=150)))
    late = advance(state, on(market, 150).where(F.col("ticker").isin("LONG", "GAPS")))
    stale = {r.ticker for r in late.where("stale").collect()}
    assert stale == {"LONG", "GAPS"} & {r.ticker for r in on(market, 150).collect()}
    whole = advance(late, on(market, 150).where(~F.col("ticker").isin("LONG", "GAPS")))
    assert_same(metrics_from_state(rebuild(whole, market), digits=None), risk_metrics(market, digits=None))


def test_nothing_in_nothing_out(market):
    state = metric_state(market)
    assert metric_state(market.limit(0)).count() == 0
    unchanged = advance(state, market.limit(0))
    assert repr(table(unchanged, "ticker")) == repr(table(state, "ticker"))  # NaN is not NaN


def test_one_shuffle_and_no_second_reading(market):
    plan = advance(metric_state(until(market, 200)), on(market, 201))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(ticker") <= 2  # the state's own and the step's
