from __future__ import annotations

import math
from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators import latest, returns, risk, rolling
from barloom.schemas import METRIC_COLUMNS
from conftest import START, table

ZIGZAG = [100, 101.5, 99.8, 102.3, 103.1, 101.9, 104.2, 103.5, 105.8, 104.9,
          106.3, 105.1, 107.4, 106.8, 108.2, 107.5, 109.1, 108.3, 109.8, 110.0]
SELLOFF = [100, 100.5, 101, 101.5, 102, 95, 87, 89, 92, 94]


def only(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0]


def from_returns(values):
    path = [100.0]
    for r in values:
        path.append(path[-1] * (1 + r))
    return path


def test_daily_returns(closes):
    got = table(returns.daily_returns(closes(A=[100, 110, 99], B=[5])), "date")
    assert [r["ticker"] for r in got] == ["A", "A"]
    assert [r["daily_return"] for r in got] == pytest.approx([0.1, -0.1])


def test_returns_after_zero_price_are_infinite_or_dropped(closes):
    got = table(returns.daily_returns(closes(A=[1, 0, 0, 2])), "date")
    assert [r["daily_return"] for r in got] == [-1.0, math.inf]
    assert risk.risk_metrics(closes(A=[1, 0, 2, 3])).isEmpty()


@pytest.mark.parametrize(
    ("path", "fall"),
    [([100, 110, 88, 95], 22 / 110), ([100, 120, 90], 30 / 120), ([1, 2, 3], 0.0), ([100, 120, 90, 110], 0.25)],
)
def test_max_drawdown(closes, path, fall):
    assert only(risk.max_drawdown(closes(A=path), digits=9)).max_drawdown == pytest.approx(fall)


def test_return_drawdown_is_blind_on_the_first_day(closes):
    prices = closes(A=[100, 80, 90, 85])
    assert only(risk.max_drawdown(prices)).max_drawdown == pytest.approx(0.2)
    assert only(risk.max_drawdown_from_returns(prices)).max_drawdown == pytest.approx(5 / 90, abs=1e-6)


def test_cvar_counts_the_whole_tail(closes):
    prices = closes(A=from_returns([-0.10, -0.05, 0.0, 0.05, 0.10] * 4))
    row = only(risk.conditional_var(prices))
    assert row.cvar_95 == pytest.approx(0.10, abs=0.01)
    var = only(risk.historical_var(prices))
    assert row.cvar_95 >= var.var_95 - 1e-9 and row.cvar_99 >= var.var_99 - 1e-9


def test_var_of_gains_is_negative(closes):
    assert only(risk.historical_var(closes(A=from_returns([0.01, 0.02, 0.03])))).var_95 < 0


def test_parametric_close_to_historical_for_normal_returns(closes):
    sample = np.random.default_rng(42).normal(0.0, 0.01, 3000)
    prices = closes(A=from_returns(sample))
    a, b = only(risk.parametric_var(prices)), only(risk.historical_var(prices))
    assert a.parametric_var_95 == pytest.approx(b.var_95, abs=0.01)
    assert b.var_99 >= b.var_95


def test_single_price_and_flat_series(closes):
    one = closes(A=[5])
    assert risk.annualized_volatility(one).isEmpty()
    assert only(risk.sharpe_ratio(one)).sharpe_ratio == 0.0
    assert only(risk.historical_var(one)).var_95 == 0.0
    assert only(risk.conditional_var(one)).cvar_95 == 0.0
    assert only(risk.parametric_var(one)).parametric_var_95 == 0.0
    flat = only(risk.risk_metrics(closes(A=[7] * 10)))
    assert (flat.annualized_volatility, flat.max_drawdown, flat.sharpe_ratio) == (0.0, 0.0, 0.0)


def test_metric_set_matches_pandas(closes):
    row = only(risk.risk_metrics(closes(A=ZIGZAG), digits=None))
    p = pd.Series(ZIGZAG, dtype=float)
    r = p.pct_change().dropna()
    q95, q99 = np.percentile(r, 5), np.percentile(r, 1)
    want = [
        r.std() * math.sqrt(252), -q95, -q99, -r[r <= q95].mean(), -r[r <= q99].mean(),
        (r - 0.02 / 252).mean() / r.std() * math.sqrt(252), ((p.cummax() - p) / p.cummax()).max(),
    ]
    assert [row[m] for m in METRIC_COLUMNS] == pytest.approx(want, rel=1e-9)
    assert (row.window_start, row.window_end) == (START, date(2024, 1, 20))


def test_metric_set_needs_three_prices(closes):
    got = table(risk.risk_metrics(closes(A=[1, 2], B=[1, 2, 3])), "ticker")
    assert [r["ticker"] for r in got] == ["B"]


def test_window_metrics(closes):
    prices = closes(A=SELLOFF)
    part = only(risk.risk_metrics_window(prices, date(2024, 1, 5), date(2024, 1, 10)))
    assert part.max_drawdown == pytest.approx(15 / 102, abs=1e-6)
    assert part.annualized_volatility > only(risk.risk_metrics(prices)).annualized_volatility
    with pytest.raises(ValueError):
        risk.risk_metrics_window(prices, date(2024, 2, 1), date(2024, 1, 1))
    short = (date(2024, 1, 1), date(2024, 1, 2))
    assert risk.risk_metrics_window(prices, *short).isEmpty()
    assert only(risk.window_rejections(prices, *short)).points == 2
    assert risk.window_rejections(prices, date(2025, 1, 1)).isEmpty()


def test_trailing_metrics_native_and_grouped_map_agree(closes):
    rng = np.random.default_rng(7)
    prices = closes(
        A=from_returns(rng.normal(0, 0.02, 60)), B=from_returns(rng.normal(0, 0.02, 10)),
        C=from_returns(rng.normal(0, 0.03, 45)),
    )
    native = table(risk.risk_metrics_trailing(prices, window_days=50, min_price_points=30), "ticker")
    pandas = table(risk.risk_metrics_grouped_map(prices, window_days=50, min_price_points=30), "ticker")
    assert [r["ticker"] for r in native] == ["A", "C"]
    for a, b in zip(native, pandas, strict=True):
        assert list(a.values())[:3] == list(b.values())[:3]
        assert list(a.values())[3:] == pytest.approx(list(b.values())[3:], abs=2e-6)


def test_trailing_window_of_an_empty_table_fails(closes, spark, tmp_path):
    closes(A=[1]).where("close < 0").write.parquet(str(tmp_path / "prices"))
    nothing = spark.read.parquet(str(tmp_path / "prices"))
    with pytest.raises(Exception, match="price table is empty"):
        returns.trailing_window(nothing, 365).collect()


def test_trailing_window_floor_is_exclusive(closes):
    got = returns.trailing_window(closes(A=range(1, 11)), 3)
    assert got.count() == 3


def test_return_stats_and_series(closes):
    prices = closes(A=[100, 110, 99], B=[1, 2])
    stats = only(risk.return_stats(prices))
    assert (stats["count"], stats["mean"], stats["min"], stats["max"]) == (2, 0.0, -0.1, 0.1)
    series = only(risk.return_series(prices))
    assert series["values"] == [0.1, -0.1]
    assert series["dates"] == [date(2024, 1, 2), date(2024, 1, 3)]


def test_rolling_volatility_warms_up(closes):
    got = table(rolling.rolling_vol_var(closes(A=ZIGZAG, B=[1, 2, 3]), window=5), "date")
    r = pd.Series(ZIGZAG, dtype=float).pct_change().dropna()
    want = (r.rolling(5).std() * math.sqrt(252)).round(6)
    assert len(got) == 19 and all(g["annualized_volatility"] is None for g in got[:4])
    assert [g["annualized_volatility"] for g in got[4:]] == pytest.approx(list(want[4:]), abs=2e-6)
    var = [-np.percentile(r[i - 4 : i + 1], 5) for i in range(4, 19)]
    assert [g["var_95"] for g in got[4:]] == pytest.approx(var, abs=2e-6)
    with pytest.raises(ValueError):
        rolling.rolling_vol_var(closes(A=ZIGZAG), window=4)


def test_rolling_metrics_leave_out_the_first_rows_and_bad_closes(closes):
    path = [100 + i % 7 for i in range(30)]
    got = table(rolling.rolling_metrics(closes(A=[0, *path])), "date")
    r = pd.Series(path, dtype=float).pct_change()
    assert len(got) == 30 - 21
    assert got[0]["rolling_vol_21d"] == pytest.approx(r[1:22].std() * math.sqrt(252))
    assert got[-1]["rolling_mean_21d"] == pytest.approx(r[-21:].mean())


def test_z_scores_use_only_earlier_rows(closes):
    path = [10, 12, 11, 50]
    got = table(rolling.price_zscore_outliers(closes(A=path)), "date")
    assert [g["date"].day for g in got] == [3, 4]
    earlier = pd.Series(path[:3], dtype=float)
    assert got[-1]["z_score"] == pytest.approx((50 - earlier.mean()) / earlier.std())
    assert got[-1]["is_outlier"] and not got[0]["is_outlier"]


def test_latest_metrics_two_orders(spark):
    rows = spark.createDataFrame(
        [("A", 1, 5, 0.1), ("A", 2, 3, 0.2), ("A", 2, 4, 0.3), ("B", 1, 1, 0.9)],
        "ticker string, window_end int, computed_at int, var_95 double",
    )
    by_window = table(latest.latest_metrics(rows), "ticker")
    assert [r["var_95"] for r in by_window] == [0.3, 0.9]
    by_time = table(latest.latest_metrics_by_computed_at(rows), "ticker")
    assert [r["var_95"] for r in by_time] == [0.1, 0.9]


def test_properties_on_random_paths(closes):
    rng = np.random.default_rng(3)
    series = {f"T{i}": from_returns(rng.normal(0, 0.03, 5 + 7 * i)) for i in range(8)}
    sets = risk.risk_metrics(closes(**series), digits=None)
    assert sets.count() == 8
    wrong = sets.where(
        (F.col("cvar_95") < F.col("var_95") - 1e-12)
        | (F.col("cvar_99") < F.col("var_99") - 1e-12)
        | (F.col("var_99") < F.col("var_95") - 1e-12)
        | ~F.col("max_drawdown").between(0, 1)
    )
    assert wrong.isEmpty()
