"""Rolling measures over a fixed number of bars, and trailing outlier scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import PRECISION, annualized, as_loss, rounded
from barloom.operators.returns import daily_returns, series, with_returns

ROLLING_ROWS = 21
TREND_LIMITS = (5, 252)
OUTLIER_ROWS = 20
OUTLIER_Z = 3.0


def rolling_metrics(prices: DataFrame, rows: int = ROLLING_ROWS) -> DataFrame:
    """Rolling volatility and mean return, the first `rows` bars of a ticker left out."""
    frame = series().rowsBetween(1 - rows, Window.currentRow)
    positive = prices.select("ticker", "date", "close").where(F.col("close") > 0)
    return (
        with_returns(positive)
        .withColumn(f"rolling_vol_{rows}d", annualized(F.stddev_samp("daily_return").over(frame)))
        .withColumn(f"rolling_mean_{rows}d", F.avg("daily_return").over(frame))
        .withColumn("bar_number", F.row_number().over(series()))
        .where(F.col("bar_number") > rows)
        .drop("bar_number", "prev_close")
    )


def rolling_vol_var(
    prices: DataFrame, window: int = ROLLING_ROWS, digits: int = PRECISION
) -> DataFrame:
    """Rolling volatility and 95 % VaR per return date, NULL until the window is full.

    Tickers with fewer than window + 1 bars have no rows.
    """
    low, high = TREND_LIMITS
    if not low <= window <= high:
        raise ValueError(f"window must be between {low} and {high}")
    frame = series().rowsBetween(1 - window, Window.currentRow)
    full = F.col("number") >= window
    r = "daily_return"
    return (
        daily_returns(prices)
        .withColumn("returns", F.count(F.lit(1)).over(Window.partitionBy("ticker")))
        .withColumn("number", F.row_number().over(series()))
        .withColumn("vol", F.when(full, annualized(F.stddev_samp(r).over(frame))))
        .withColumn("var", F.when(full, as_loss(F.percentile(r, F.lit(0.05)).over(frame))))
        .where(F.col("returns") >= window)
        .select(
            "ticker",
            "date",
            rounded("vol", digits).alias("annualized_volatility"),
            rounded("var", digits).alias("var_95"),
        )
    )


def with_z_scores(prices: DataFrame, rows: int = OUTLIER_ROWS) -> DataFrame:
    """|z| of each close against the `rows` bars before it; NULL where they do not vary."""
    before = series().rowsBetween(-rows, -1)
    mean, std = F.avg("close").over(before), F.stddev_samp("close").over(before)
    z = F.when(F.col("std_before") > 0, F.abs((F.col("close") - F.col("mean_before")) / F.col("std_before")))
    return (
        prices.withColumn("mean_before", mean)
        .withColumn("std_before", std)
        .withColumn("z_score", z)
        .drop("mean_before", "std_before")
    )


def price_zscore_outliers(
    prices: DataFrame, rows: int = OUTLIER_ROWS, threshold: float = OUTLIER_Z
) -> DataFrame:
    scored = with_z_scores(prices.select("ticker", "date", "close"), rows)
    return scored.where(F.col("z_score").isNotNull()).withColumn(
        "is_outlier", F.col("z_score") > threshold
    )
