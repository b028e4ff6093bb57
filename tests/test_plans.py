"""The physical plans operators are meant to have over stored bars."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barloom.operators import changes, mutate, portfolio, quality, returns, risk, rolling
from barloom.plans import bindings as b
from barloom.plans import reports
from barloom.schemas import BAR_KEY
from barloom.sources import files

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "prices")
    files.write_table(b.prices_supplier(spark, SMALL), path)
    return spark.read.parquet(path)


def plan(frame) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


def count(node: str, text: str) -> int:
    tree = text.split("\n\n")[0]
    return len(re.findall(rf"[-+*] ?(?:\(\d+\) )?{node}\b", tree))


@pytest.mark.parametrize(
    "operator",
    [
        risk.risk_metrics, risk.conditional_var, risk.max_drawdown, risk.max_drawdown_from_returns,
        risk.sharpe_ratio, risk.return_stats, rolling.rolling_metrics, rolling.rolling_vol_var,
        rolling.price_zscore_outliers, returns.daily_returns, returns.date_gaps,
    ],
)
def test_one_exchange_and_one_sort(stored, operator):
    text = plan(operator(stored))
    assert count("Exchange", text) == 1 and count("Sort", text) == 1
    assert "ReadSchema: struct<ticker:string,date:date" in text
    assert "volume" not in text


def test_quality_scores_read_recent_bars_once(stored):
    text = plan(quality.quality_scores(stored, date(2001, 11, 4), datetime(2001, 11, 5)))
    assert count("Exchange", text) == 2 and count("Scan parquet", text) == 2
    assert "GreaterThanOrEqual(date,2001-03-24)" in text
    assert "partial_max(ingested_at" in text


def test_trend_of_thirty_days_reads_recent_bars_once(stored):
    text = plan(quality.quality_history(stored, date(2001, 11, 4), days=30))
    # the other scan is freshness: two columns of the whole history
    assert count("Scan parquet", text) == 2 and "GreaterThanOrEqual(date,2001-02-23)" in text
    frame = plan(quality.recent_counts(stored, date(2001, 11, 4), days=30))
    assert count("Scan parquet", frame) == 1 and count("Exchange", frame) == 1


def test_ticker_filter_reaches_the_scan_below_the_windows(stored):
    rolled = reports.rolling_single_ticker(rolling.rolling_metrics(stored), "s000003", date(2001, 11, 4))
    assert "EqualTo(ticker,S000003)" in plan(rolled)
    text = plan(returns.price_range(stored, "s000003", date(2000, 1, 1), date(2000, 12, 31)))
    assert "GreaterThanOrEqual(date,2000-01-01)" in text and "LessThanOrEqual(date,2000-12-31)" in text


def test_trailing_window_has_no_join(stored):
    text = plan(risk.risk_metrics_trailing(stored))
    assert "Join" not in text and count("Exchange", text) >= 1


def test_settling_duplicates_aggregates_before_the_shuffle(stored):
    text = plan(mutate.last_per_key(stored, BAR_KEY, ["volume"]))
    assert "partial_max_by" in text and "Window" not in text and count("Exchange", text) == 1


def test_tick_bars_aggregate_before_the_shuffle(spark):
    text = plan(b.prices_supplier(spark, SMALL))
    assert "partial_min" in text and count("Exchange", text) == 1


def test_no_cross_join_of_rows(spark, stored):
    feed = changes.snapshot_diff(stored, stored, BAR_KEY, 1)
    assert "CartesianProduct" not in plan(feed) and "NestedLoop" not in plan(feed)
    gaps = reports.coverage_gaps(stored, b.universe_supplier(spark, SMALL), datetime(2001, 11, 5))
    assert "NestedLoop" not in plan(gaps)


def test_portfolio_risk_expands_holdings_once(stored):
    held = stored.select(F.lit("p").alias("portfolio"), "ticker", F.lit(1.0).alias("weight")).distinct()
    text = plan(portfolio.portfolio_risk(stored, held))
    assert count("Generate", text) == 1
    # what is expanded is aggregated where it is, by portfolio and day
    below = text.split("\n\n")[0].split("Generate")[0].splitlines()[-4:]
    assert not any("Exchange" in line for line in below)
