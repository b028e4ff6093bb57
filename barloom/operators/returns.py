"""Daily returns, drawdown paths and date gaps of each ticker.

Window size: a stored bar is unique per (ticker, date) and dates are calendar
days, so one ticker's series has at most one row per day: about 7,300 rows for
20 years and never more than the 3.65 million days of the DATE domain. However
many ticks or duplicate rows a ticker has, they are reduced to one bar per day
by partially aggregated group-bys (`mutate.first_per_key`, the tick bars of the
test bindings) before any window below sees them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import ieee_ratio, lit_or_col, symbol


def series(by: str = "ticker", order: str = "date"):
    return Window.partitionBy(by).orderBy(order)


def so_far(by: str = "ticker", order: str = "date"):
    return series(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def with_returns(prices: DataFrame) -> DataFrame:
    """Adds prev_close and daily_return, NULL on each ticker's first bar."""
    prev = F.lag("close").over(series())
    ratio = ieee_ratio(F.col("close"), F.col("prev_close")) - 1.0
    return prices.withColumn("prev_close", prev).withColumn("daily_return", ratio)


def daily_returns(prices: DataFrame) -> DataFrame:
    """Simple close-to-close returns; undefined ones (0/0) are dropped."""
    return (
        with_returns(prices.select("ticker", "date", "close"))
        .where(F.col("daily_return").isNotNull() & ~F.isnan("daily_return"))
    )


def with_drawdown(prices: DataFrame) -> DataFrame:
    """Adds the running peak of the close and the fall from it as a positive fraction."""
    fall = ieee_ratio(F.col("running_max") - F.col("close"), F.col("running_max"))
    return prices.withColumn("running_max", F.max("close").over(so_far())).withColumn(
        "drawdown", fall
    )


def drawdown_series(prices: DataFrame) -> DataFrame:
    return with_drawdown(prices.select("ticker", "date", "close"))


def date_gaps(prices: DataFrame) -> DataFrame:
    """Calendar days between a ticker's consecutive bars."""
    return (
        prices.select("ticker", "date", F.lag("date").over(series()).alias("prev_date"))
        .where(F.col("prev_date").isNotNull())
        .withColumn("gap_days", F.datediff("date", "prev_date"))
    )


def price_range(
    prices: DataFrame,
    ticker: str,
    start: date | Column | None = None,
    end: date | Column | None = None,
    ordered: bool = True,
) -> DataFrame:
    """One ticker's bars, both date bounds inclusive and optional."""
    rows = prices.where(F.col("ticker") == symbol(F.lit(ticker)))
    rows = between_dates(rows, start, end)
    return rows.orderBy("date") if ordered else rows


def between_dates(
    rows: DataFrame, start: date | Column | None = None, end: date | Column | None = None
) -> DataFrame:
    if start is not None:
        rows = rows.where(F.col("date") >= lit_or_col(start))
    if end is not None:
        rows = rows.where(F.col("date") <= lit_or_col(end))
    return rows


def tickers_by_prefix(prices: DataFrame, prefix: str) -> DataFrame:
    wanted = F.col("ticker").startswith(prefix.strip().upper())
    return prices.select("ticker").where(wanted).distinct()


def latest_date(prices: DataFrame) -> Column:
    """The table's own last date as a scalar subquery; having no date fails the query."""
    nothing = F.raise_error(F.lit("price table is empty")).cast("date")
    last = F.when(F.count("date") == 0, nothing).otherwise(F.max("date"))
    return prices.agg(last).scalar()


def trailing_window(
    prices: DataFrame, days: int, anchor: date | Column | None = None
) -> DataFrame:
    """Bars after anchor - days (exclusive); the anchor defaults to the last stored date.

    Without an anchor, an empty table is an error rather than an empty result.
    """
    if anchor is None:
        anchor = latest_date(prices)
    rows = prices.where(F.col("date") > F.date_sub(lit_or_col(anchor), days))
    return rows.select("ticker", "date", "close")


def eligible_tickers(windowed: DataFrame, min_points: int = 30) -> DataFrame:
    """Tickers with enough bars inside the window."""
    return (
        windowed.groupBy("ticker")
        .agg(F.count(F.lit(1)).alias("num_days"))
        .where(F.col("num_days") >= min_points)
    )


def eligible_prices(windowed: DataFrame, min_points: int = 30) -> DataFrame:
    """Bars of the eligible tickers.

    The count and the filter share one partitioning by ticker, so the rows are
    counted in a window instead of being joined back to their own count.
    """
    per_ticker = F.count(F.lit(1)).over(Window.partitionBy("ticker"))
    return windowed.withColumn("num_days", per_ticker).where(F.col("num_days") >= min_points).drop(
        "num_days"
    )
