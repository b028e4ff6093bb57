"""Dashboard reports over stored tables; `as_of` stands for today."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions import lit_or_col, percent, rounded, symbol, whole_hours
from barloom.operators.latest import latest_metrics
from barloom.operators.distinct_counts import merged_counts
from barloom.operators.quantiles import exact_quantile

STALE_DAYS = 4


# -- latest risk snapshot --------------------------------------------------------


def current_risk_metrics(metrics: DataFrame) -> DataFrame:
    return (
        latest_metrics(metrics)
        .select(
            "ticker",
            "window_start",
            "window_end",
            percent("annualized_volatility", 2).alias("volatility_pct"),
            percent("var_95", 2).alias("var_95_pct"),
            percent("cvar_95", 2).alias("cvar_95_pct"),
            rounded("sharpe_ratio", 3).alias("sharpe_ratio"),
            percent("max_drawdown", 2).alias("max_drawdown_pct"),
            "computed_at",
        )
        .orderBy("ticker")
    )


def volatility_top(metrics: DataFrame, top: int = 25) -> DataFrame:
    return (
        latest_metrics(metrics)
        .orderBy(F.desc("annualized_volatility"), "ticker")
        .limit(top)
        .select(
            "ticker",
            percent("annualized_volatility", 2).alias("volatility_pct"),
            percent("var_95", 2).alias("var_95_pct"),
            percent("max_drawdown", 2).alias("max_drawdown_pct"),
        )
    )


def risk_return_scatter(metrics: DataFrame, universe: DataFrame) -> DataFrame:
    return (
        latest_metrics(metrics)
        .join(universe.select("ticker", "sector"), "ticker", "left")
        .select(
            "ticker",
            "sector",
            rounded("annualized_volatility", 4).alias("volatility"),
            rounded("sharpe_ratio", 4).alias("sharpe_ratio"),
            rounded("var_95", 4).alias("var_95"),
        )
    )


def fattest_tails(metrics: DataFrame, top: int = 25) -> DataFrame:
    shown = [
        percent(name, 3).alias(f"{name}_pct") for name in ("var_95", "cvar_95", "var_99", "cvar_99")
    ]
    gap = percent(F.col("cvar_99") - F.col("var_99"), 3).alias("tail_gap_pct")
    return (
        latest_metrics(metrics)
        .select("ticker", *shown, gap)
        .orderBy(F.desc("tail_gap_pct"), "ticker")
        .limit(top)
    )


def metrics_summary(metrics: DataFrame) -> DataFrame:
    return (
        latest_metrics(metrics)
        .orderBy(F.desc("annualized_volatility"), "ticker")
        .select(
            "ticker",
            "window_start",
            "window_end",
            rounded("annualized_volatility", 4).alias("volatility"),
            rounded("var_95", 4).alias("var_95"),
            rounded("cvar_95", 4).alias("cvar_95"),
            rounded("sharpe_ratio", 4).alias("sharpe"),
            rounded("max_drawdown", 4).alias("max_drawdown"),
            "computation_duration_ms",
        )
    )


# -- rolling series ----------------------------------------------------------------


def sector_rolling_vol(
    rolling: DataFrame, universe: DataFrame, as_of: date | Column, days: int = 90
) -> DataFrame:
    """Median rolling volatility of a sector's tickers per date.

    One round of splitters is enough: of ten million tickers in one sector a task orders
    about 400,000 values.
    """
    sectors = universe.select("ticker", "sector").where(F.col("sector").isNotNull())
    recent = rolling.where(F.col("date") >= F.date_sub(lit_or_col(as_of), days))
    medians = exact_quantile(
        recent.join(sectors, "ticker"), ["sector", "date"], "rolling_vol_21d", 0.5, rounds=1, out="median"
    )
    return medians.select(
        "sector",
        "date",
        percent("median", 2).alias("rolling_vol_pct"),
        F.col("n").alias("tickers"),
    ).orderBy("sector", "date")


def _one_ticker(rolling: DataFrame, ticker: str, as_of: date | Column, days: int) -> DataFrame:
    return rolling.where(
        (F.col("ticker") == symbol(F.lit(ticker)))
        & (F.col("date") >= F.date_sub(lit_or_col(as_of), days))
    )


def rolling_single_ticker(
    rolling: DataFrame, ticker: str, as_of: date | Column, days: int = 365
) -> DataFrame:
    return (
        _one_ticker(rolling, ticker, as_of, days)
        .select(
            "ticker",
            "date",
            percent("rolling_vol_21d", 2).alias("rolling_vol_pct"),
            percent("daily_return", 3).alias("daily_return_pct"),
        )
        .orderBy("date")
    )


def return_distribution(
    rolling: DataFrame, ticker: str, as_of: date | Column, days: int = 365
) -> DataFrame:
    return (
        _one_ticker(rolling, ticker, as_of, days)
        .select("ticker", "date", percent("daily_return", 3).alias("return_pct"))
        .orderBy("date")
    )


# -- coverage and ingestion ----------------------------------------------------------


def _per_ticker(prices: DataFrame) -> DataFrame:
    return prices.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.max("ingested_at").alias("last_ingested"),
    )


def coverage_summary(prices: DataFrame, universe: DataFrame, as_of: date | Column) -> DataFrame:
    size = universe.where("active").agg(F.count(F.lit(1)).alias("universe_size"))
    stale = F.col("last_date") < F.date_sub(lit_or_col(as_of), STALE_DAYS)
    # one row per ticker, so counting rows counts distinct tickers
    shape = _per_ticker(prices).agg(
        F.count("ticker").alias("tickers_with_data"),
        F.count_if(stale).alias("tickers_stale"),
        F.min("first_date").alias("history_starts"),
        F.sum("total_records").alias("total_rows"),
    )
    return size.crossJoin(F.broadcast(shape))  # one row by one row


def coverage_gaps(
    prices: DataFrame,
    universe: DataFrame,
    as_of_time: datetime | Column,
    market: date | Column | None = None,
) -> DataFrame:
    """Active tickers without bars, or with a last bar well behind the market's last date,
    by default the table's."""
    per_ticker = _per_ticker(prices)
    market = prices.agg(F.max("date")).scalar() if market is None else lit_or_col(market)
    behind = F.col("last_date").isNull() | (F.col("last_date") < F.date_sub(market, STALE_DAYS))
    return (
        universe.where("active")
        .select("ticker", "sector")
        .join(per_ticker, "ticker", "left")
        .where(behind)
        .select(
            "ticker",
            "sector",
            F.coalesce("total_records", F.lit(0).cast("bigint")).alias("total_records"),
            "first_date",
            "last_date",
            F.datediff(market, F.col("last_date")).alias("days_behind"),
            whole_hours(F.col("last_ingested"), lit_or_col(as_of_time)).alias("hours_since_update"),
        )
        .orderBy(F.desc_nulls_first("days_behind"), "ticker")
    )


def ingestion_volume(prices: DataFrame, as_of: date | Column, days: int = 30) -> DataFrame:
    floor = F.date_sub(lit_or_col(as_of), days).cast("timestamp")
    return (
        prices.where(F.col("ingested_at") >= floor)
        .groupBy(F.to_date("ingested_at").alias("ingest_date"))
        .agg(
            F.count(F.lit(1)).alias("records_ingested"),
            F.count_distinct("ticker").alias("tickers_touched"),
        )
        .orderBy("ingest_date")
    )


def source_distribution(prices: DataFrame) -> DataFrame:
    return prices.groupBy("source").agg(
        F.count(F.lit(1)).alias("record_count"), F.count_distinct("ticker").alias("ticker_count")
    )


def ingestion_volume_daily(daily: DataFrame, as_of: date | Column, days: int = 30) -> DataFrame:
    """`ingestion_volume` from the rows of `distinct_counts.daily_tickers`."""
    recent = daily.where(F.col("ingest_date") >= F.date_sub(lit_or_col(as_of), days))
    return merged_counts(recent, ["ingest_date"], "records_ingested", "tickers_touched").orderBy(
        "ingest_date"
    )


def source_distribution_daily(daily: DataFrame) -> DataFrame:
    """`source_distribution` from the rows of `distinct_counts.daily_tickers`."""
    return merged_counts(daily, ["source"], "record_count", "ticker_count")


def ingest_summary(prices: DataFrame) -> DataFrame:
    return prices.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("ticker").alias("tickers"),
        F.min("date").alias("earliest_date"),
        F.max("date").alias("latest_date"),
        F.max("ingested_at").alias("last_ingested"),
    )


def stale_tickers(prices: DataFrame, market: date | Column | None = None) -> DataFrame:
    """Tickers whose last bar is well behind the market's last date, by default the table's."""
    market = prices.agg(F.max("date")).scalar() if market is None else lit_or_col(market)
    return (
        _per_ticker(prices)
        .where(F.col("last_date") < F.date_sub(market, STALE_DAYS))
        .select(
            "ticker",
            F.col("total_records").alias("row_count"),
            F.col("first_date").alias("earliest_date"),
            F.col("last_date").alias("latest_date"),
            "last_ingested",
        )
        .orderBy("latest_date", "ticker")
    )
