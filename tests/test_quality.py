from __future__ import annotations

import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.operators import quality

TODAY = date(2024, 6, 30)
NOW = datetime(2024, 7, 1, 14)


@pytest.fixture
def prices(spark):
    def make(**days_ago):
        rows = [
            (t, TODAY - timedelta(days=n), float(c), datetime.combine(TODAY - timedelta(days=n), datetime.min.time()))
            for t, series in days_ago.items()
            for n, c in series
        ]
        return spark.createDataFrame(rows, "ticker string, date date, close double, ingested_at timestamp")

    return make


def by_ticker(frame):
    return {r.ticker: r for r in frame.collect()}


def test_freshness_steps(prices):
    made = prices(A=[(0, 1)], B=[(1, 1)], C=[(2, 1)], D=[(9, 1), (5, 1)])
    got = by_ticker(quality.quality_freshness(made, TODAY, NOW))
    # 38 hours after the day's midnight, then a day more each
    assert {t: (r.hours_since_ingest, r.score) for t, r in got.items()} == {
        "A": (38, 0.7), "B": (62, 0.4), "C": (86, 0.4), "D": (158, 0.1),
    }


def test_completeness_counts_transitions_inside_the_month(prices):
    daily = [(n, 1) for n in range(31)]
    made = prices(A=daily, B=[(40, 1), (29, 1), (20, 1), (18, 1)], C=[(45, 1), (3, 1)])
    got = by_ticker(quality.quality_completeness(made, TODAY))
    assert set(got) == {"A", "B"}  # C has one bar in the month, so no transition
    assert (got["A"].total_days, got["A"].score, got["A"].gaps_detected) == (30, 1.0, 0)
    assert (got["B"].total_days, got["B"].max_gap_days, got["B"].gaps_detected) == (2, 9, 1)
    assert got["B"].coverage_ratio == pytest.approx(0.093) and got["B"].score == 0.2


def test_gap_steps(prices):
    made = prices(
        A=[(n, 1) for n in range(0, 100, 5)],
        B=[(n, 1) for n in range(0, 100, 50)],
        C=[(n, 1) for n in range(0, 180, 30)],
        D=[(n, 1) for n in range(0, 180, 10)],
        E=[(200, 1), (0, 1)],
    )
    got = by_ticker(quality.quality_gaps(made, TODAY))
    assert {t: (r.large_gaps, r.score) for t, r in got.items()} == {
        "A": (0, 1.0), "B": (1, 0.8), "C": (5, 0.5), "D": (17, 0.2),
    }


def test_outliers_warm_up_outside_the_scored_days(prices):
    calm = [(n, 10 + n % 3) for n in range(1, 200)]
    made = prices(A=[*calm, (0, 100)], B=calm, C=[(n, 5) for n in range(60)])
    got = by_ticker(quality.quality_outliers(made, TODAY))
    assert set(got) == {"A", "B"}  # C never moves, so nothing can be scored
    assert (got["A"].outlier_count, got["A"].total_points, got["A"].score) == (1, 181, 0.9)
    assert (got["B"].outlier_count, got["B"].score) == (0, 1.0)


def test_all_scores_and_reports(prices):
    made = prices(A=[(n, 10 + n % 3) for n in range(120)], B=[(50, 1), (20, 2), (9, 3)])
    scores = quality.quality_scores(made, TODAY, NOW)
    rows = {(r.ticker, r.check_name): r for r in scores.collect()}
    assert set(rows) == {(t, c) for t in "AB" for c in ("freshness", "completeness", "outliers", "gaps")}
    assert json.loads(rows[("B", "gaps")].details) == {
        "large_gaps": 2, "total_transitions": 2, "widest_gap_days": 30,
    }
    assert quality.quality_count(scores, TODAY).first().scores == 8
    summary = by_ticker(quality.quality_summary(scores, TODAY))
    assert summary["A"].failing_checks == "" and summary["A"].worst_check_score == 0.7
    assert summary["B"].failing_checks == "completeness, freshness"
    worst = quality.quality_heatmap_worst(scores, TODAY, worst=1)
    assert {r.ticker for r in worst.collect()} == {"B"} and worst.count() == 4
    attention = quality.tickers_needing_attention(scores, TODAY)
    assert {(r.ticker, r.check_name) for r in attention.collect()} == {("B", "completeness"), ("B", "freshness")}
    trend = {r.check_name: r.tickers_below_threshold for r in quality.quality_trend(scores, TODAY).collect()}
    assert trend == {"freshness": 1, "completeness": 1, "outliers": 0, "gaps": 0}
    assert quality.quality_count(scores.where(F.col("ticker") == "none"), TODAY).isEmpty()


@pytest.mark.parametrize("seed", [1, 2])
def test_history_equals_the_scores_of_each_day(spark, seed):
    rng = random.Random(seed)
    rows, last = [], date(2024, 6, 30)
    for ticker, every in (("A", 1), ("B", 2.5), ("C", 12), ("D", 40), ("E", 1.2)):
        day = last - timedelta(days=400) if ticker != "E" else last - timedelta(days=12)
        while day <= last + timedelta(days=2):
            close = 50.0 if ticker == "B" and rng.random() < 0.7 else rng.choice([50.0, 51.0, 52.5, 90.0])
            stamp = datetime.combine(day, datetime.min.time()) + timedelta(hours=18 + rng.choice([0, 0, 100]))
            rows.append((ticker, day, None if rng.random() < 0.02 else close, stamp))
            day += timedelta(days=max(1, round(rng.expovariate(1 / every))))
    prices = spark.createDataFrame(rows, "ticker string, date date, close double, ingested_at timestamp").repartition(3)
    columns = ["check_date", "ticker", "check_name", "score", "checked_at"]
    found = quality.quality_history(prices, last, days=9).select(*columns).collect()
    wanted = []
    for back in range(9):
        day = last - timedelta(days=back)
        at = datetime.combine(day, datetime.min.time()) + timedelta(hours=38)
        scores = quality.quality_scores(prices.where(F.col("date") <= day), day, at)
        wanted += scores.select(*columns).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, wanted))


def test_history_of_no_bars(spark):
    none = spark.createDataFrame([], "ticker string, date date, close double, ingested_at timestamp")
    assert quality.quality_history(none, TODAY).isEmpty()
