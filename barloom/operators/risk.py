"""Risk measures per ticker: volatility, VaR, CVaR, Sharpe ratio, drawdown.

All measures come from one frame whose windows and final group-by share the
partitioning by ticker, so stored bars are shuffled once.
"""

from __future__ import annotations

from datetime import date
from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import (
    PRECISION,
    TRADING_DAYS,
    annualized,
    as_loss,
    ieee_ratio,
    is_finite,
    rounded,
)
from barloom.operators.returns import (
    between_dates,
    eligible_prices,
    so_far,
    trailing_window,
    with_drawdown,
    with_returns,
)
from barloom.schemas import METRIC_COLUMNS

FLAT = 1e-10  # a deviation below this counts as no movement
RISK_FREE = 0.02
MIN_POINTS = 3

CONFIDENCES = {"95": 0.95, "99": 0.99}
TAIL = {"95": 0.05, "99": 0.01}


# -- aggregate expressions over a column of daily returns ---------------------


def volatility_of(r: str = "daily_return") -> Column:
    vol = annualized(F.stddev_samp(r))
    return F.when(vol < FLAT, F.lit(0.0)).otherwise(vol)


def var_of(tail: float, r: str = "daily_return") -> Column:
    return F.coalesce(as_loss(F.percentile(r, F.lit(tail))), F.lit(0.0))


def parametric_var_of(confidence: float, r: str = "daily_return") -> Column:
    z = NormalDist().inv_cdf(1.0 - confidence)
    return as_loss(F.avg(r) + F.lit(z) * F.stddev_samp(r))


def cvar_of(threshold: str, r: str = "daily_return") -> Column:
    tail_mean = F.avg(F.when(F.col(r) <= F.col(threshold), F.col(r)))
    return F.coalesce(as_loss(tail_mean), F.lit(0.0))


def sharpe_of(risk_free_rate: float = RISK_FREE, ddof: int = 1, r: str = "daily_return") -> Column:
    excess = F.col(r) - F.lit(risk_free_rate / TRADING_DAYS)
    std = F.stddev_samp(excess) if ddof == 1 else F.stddev_pop(excess)
    flat = F.coalesce(std < FLAT, F.count(r) == 0)
    return F.when(flat, F.lit(0.0)).otherwise(
        annualized(F.try_divide(F.avg(excess), std))
    )


def worst_fall(drawdown: str = "drawdown") -> Column:
    return F.max(F.when(~F.isnan(drawdown), F.col(drawdown)))


# -- enriched frames ----------------------------------------------------------


def _clean_returns(prices: DataFrame) -> DataFrame:
    """Every bar, its return NULL where there is none (first bar, or 0/0)."""
    frame = with_returns(prices.select("ticker", "date", "close"))
    defined = F.when(~F.isnan("daily_return"), F.col("daily_return"))
    return frame.withColumn("daily_return", defined)


def _with_thresholds(frame: DataFrame, by: str, r: str = "daily_return") -> DataFrame:
    whole = Window.partitionBy(by)
    for name, tail in TAIL.items():
        frame = frame.withColumn(f"q_{name}", F.percentile(r, F.lit(tail)).over(whole))
    return frame


# -- single measures ----------------------------------------------------------


def annualized_volatility(prices: DataFrame, digits: int = PRECISION) -> DataFrame:
    """Tickers with fewer than two returns have no volatility and no row."""
    vol = rounded(volatility_of(), digits).alias("annualized_volatility")
    return _clean_returns(prices).groupBy("ticker").agg(vol).where(is_finite("annualized_volatility"))


def historical_var(prices: DataFrame, digits: int = PRECISION) -> DataFrame:
    measures = [rounded(var_of(tail), digits).alias(f"var_{n}") for n, tail in TAIL.items()]
    return _clean_returns(prices).groupBy("ticker").agg(*measures)


def parametric_var(prices: DataFrame, digits: int = PRECISION) -> DataFrame:
    measures = [
        F.when(F.count("daily_return") == 0, F.lit(0.0))
        .otherwise(rounded(parametric_var_of(c), digits))
        .alias(f"parametric_var_{n}")
        for n, c in CONFIDENCES.items()
    ]
    return _clean_returns(prices).groupBy("ticker").agg(*measures)


def conditional_var(prices: DataFrame, digits: int = PRECISION) -> DataFrame:
    frame = _with_thresholds(_clean_returns(prices), "ticker")
    measures = [rounded(cvar_of(f"q_{n}"), digits).alias(f"cvar_{n}") for n in TAIL]
    return frame.groupBy("ticker").agg(*measures)


def sharpe_ratio(
    prices: DataFrame,
    risk_free_rate: float = RISK_FREE,
    ddof: int = 1,
    digits: int = PRECISION,
) -> DataFrame:
    measure = rounded(sharpe_of(risk_free_rate, ddof), digits).alias("sharpe_ratio")
    return _clean_returns(prices).groupBy("ticker").agg(measure)


def max_drawdown(prices: DataFrame, digits: int = PRECISION) -> DataFrame:
    """Largest fall of the close from its running peak."""
    return with_drawdown(prices.select("ticker", "date", "close")).groupBy("ticker").agg(
        rounded(worst_fall(), digits).alias("max_drawdown")
    )


def _with_return_drawdown(frame: DataFrame) -> DataFrame:
    """Drawdown of the compounded returns.

    The compounded path is close / first close and starts at the second bar, so
    the running peak of the closes from the second bar on gives the same falls.
    """
    later = F.when(F.col("prev_close").isNotNull(), F.col("close"))
    peak = F.col("peak")
    return frame.withColumn("peak", F.max(later).over(so_far())).withColumn(
        "drawdown", ieee_ratio(peak - later, peak)
    )


def max_drawdown_from_returns(prices: DataFrame, digits: int = PRECISION) -> DataFrame:
    """As `max_drawdown`, but blind to a fall on the first day."""
    frame = _with_return_drawdown(with_returns(prices.select("ticker", "date", "close")))
    return frame.groupBy("ticker").agg(
        rounded(F.coalesce(worst_fall(), F.lit(0.0)), digits).alias("max_drawdown")
    )


# -- the full metric set ------------------------------------------------------


def risk_metrics(
    prices: DataFrame,
    min_points: int = MIN_POINTS,
    risk_free_rate: float = RISK_FREE,
    sharpe_ddof: int = 1,
    drawdown: str = "prices",
    bounds: str = "prices",
    digits: int | None = PRECISION,
) -> DataFrame:
    """Seven measures per ticker; a set with any non-finite value is dropped.

    drawdown: 'prices' sees a fall on the first day, 'returns' does not.
    bounds: window_start is the first price date or the first return date.
    """
    frame = _clean_returns(prices)
    if drawdown == "prices":
        frame = with_drawdown(frame)
    else:
        frame = _with_return_drawdown(frame)
    frame = _with_thresholds(frame, "ticker")

    first = F.min("date")
    if bounds == "returns":
        first = F.min(F.when(F.col("prev_close").isNotNull(), F.col("date")))
    sets = frame.groupBy("ticker").agg(
        first.alias("window_start"),
        F.max("date").alias("window_end"),
        F.count(F.lit(1)).alias("points"),
        volatility_of().alias("annualized_volatility"),
        *[as_loss(F.min(f"q_{n}")).alias(f"var_{n}") for n in TAIL],
        *[cvar_of(f"q_{n}").alias(f"cvar_{n}") for n in TAIL],
        sharpe_of(risk_free_rate, sharpe_ddof).alias("sharpe_ratio"),
        worst_fall().alias("max_drawdown"),
    )
    sets = sets.where(F.col("points") >= min_points)
    for name in METRIC_COLUMNS:
        sets = sets.where(is_finite(name))
    measures = [
        F.col(name) if digits is None else rounded(name, digits).alias(name)
        for name in METRIC_COLUMNS
    ]
    return sets.select("ticker", "window_start", "window_end", *measures)


def risk_metrics_trailing(
    prices: DataFrame,
    window_days: int = 365,
    min_price_points: int = 30,
    risk_free_rate: float = RISK_FREE,
    anchor: date | Column | None = None,
    digits: int | None = PRECISION,
) -> DataFrame:
    """Metric set of the trailing window, tickers with too few bars in it left out."""
    windowed = trailing_window(prices, window_days, anchor)
    return risk_metrics(
        windowed,
        min_points=min_price_points,
        risk_free_rate=risk_free_rate,
        sharpe_ddof=0,
        drawdown="returns",
        bounds="returns",
        digits=digits,
    )


def risk_metrics_window(
    prices: DataFrame, start: date | None = None, end: date | None = None, **options
) -> DataFrame:
    """Metric set of an explicit window, both ends inclusive."""
    if start is not None and end is not None and start > end:
        raise ValueError("start must not be after end")
    return risk_metrics(between_dates(prices, start, end), **options)


def window_rejections(
    prices: DataFrame,
    start: date | None = None,
    end: date | None = None,
    min_points: int = MIN_POINTS,
) -> DataFrame:
    """Tickers that have bars in the window, but too few for a metric set."""
    counts = between_dates(prices, start, end).groupBy("ticker").agg(
        F.count(F.lit(1)).alias("points")
    )
    return counts.where(F.col("points") < min_points)


# -- per-ticker extension hook ------------------------------------------------


def apply_per_ticker(frame: DataFrame, fn, schema) -> DataFrame:
    """Run a pandas function on each ticker's rows, sorted by date.

    A group is one ticker's unique daily bars, see `returns` for its bound.
    """
    return frame.groupBy("ticker").applyInPandas(
        lambda pdf: fn(pdf.sort_values("date", ignore_index=True)), schema
    )


def risk_metrics_grouped_map(
    prices: DataFrame,
    window_days: int = 365,
    min_price_points: int = 30,
    risk_free_rate: float = RISK_FREE,
    anchor: date | Column | None = None,
    digits: int = PRECISION,
) -> DataFrame:
    """The trailing metric set through the pandas hook.

    Written with Series methods on a date index, so that it shares nothing with the
    native expressions but the definitions.
    """

    def tails(returns: pd.Series) -> dict[str, float]:
        cuts = returns.quantile(list(TAIL.values()))
        worst = {name: returns[returns.le(cuts[share])] for name, share in TAIL.items()}
        at_risk = {f"var_{name}": -cuts[share] for name, share in TAIL.items()}
        return at_risk | {f"cvar_{name}": -losses.mean() for name, losses in worst.items()}

    def profile(rows: pd.DataFrame) -> pd.DataFrame:
        returns = rows.set_index("date")["daily_return"]
        yearly = TRADING_DAYS**0.5
        deviation = returns.std(ddof=0)
        growth = returns.add(1).cumprod()
        fall = growth.rsub(growth.cummax()).div(growth.cummax())
        mean_excess = returns.mean() - risk_free_rate / TRADING_DAYS
        return pd.DataFrame(
            {
                "ticker": rows["ticker"].head(1),
                "window_start": returns.index.min(),
                "window_end": returns.index.max(),
                "annualized_volatility": returns.std() * yearly,
                **tails(returns),
                "sharpe_ratio": mean_excess / deviation * yearly if deviation > FLAT else 0.0,
                "max_drawdown": fall.max(),
            }
        )

    schema = "ticker string, window_start date, window_end date, " + ", ".join(
        f"{name} double" for name in METRIC_COLUMNS
    )
    windowed = eligible_prices(trailing_window(prices, window_days, anchor), min_price_points)
    returns = with_returns(windowed).where(F.col("prev_close").isNotNull())
    sets = apply_per_ticker(returns, profile, schema).where(is_finite("annualized_volatility"))
    return sets.select(
        "ticker",
        "window_start",
        "window_end",
        *[rounded(name, digits).alias(name) for name in METRIC_COLUMNS],
    )


# -- return statistics --------------------------------------------------------


def return_stats(
    prices: DataFrame,
    start: date | None = None,
    end: date | None = None,
    min_points: int = MIN_POINTS,
    digits: int = PRECISION,
) -> DataFrame:
    frame = _clean_returns(between_dates(prices, start, end))
    r = F.col("daily_return")
    return (
        frame.groupBy("ticker")
        .agg(
            F.count(F.lit(1)).alias("points"),
            F.count(r).alias("count"),
            rounded(F.avg(r), digits).alias("mean"),
            rounded(F.stddev_samp(r), digits).alias("std"),
            rounded(F.min(r), digits).alias("min"),
            rounded(F.max(r), digits).alias("max"),
        )
        .where(F.col("points") >= min_points)
        .drop("points")
    )


def return_series(
    prices: DataFrame,
    start: date | None = None,
    end: date | None = None,
    min_points: int = MIN_POINTS,
    digits: int = PRECISION,
) -> DataFrame:
    """Each ticker's returns as two parallel arrays in date order."""
    frame = _clean_returns(between_dates(prices, start, end))
    point = F.when(
        F.col("daily_return").isNotNull(),
        F.struct("date", rounded("daily_return", digits).alias("value")),
    )
    return (
        frame.groupBy("ticker")
        .agg(F.count(F.lit(1)).alias("points"), F.array_sort(F.collect_list(point)).alias("path"))
        .where(F.col("points") >= min_points)
        .select(
            "ticker",
            F.col("path.date").alias("dates"),
            F.col("path.value").alias("values"),
        )
    )
