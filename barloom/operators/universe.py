"""Tracked tickers: active list, scoring scope, coverage by sector."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import symbols_in_list
from barloom.operators.returns import price_range


def active_universe(universe: DataFrame, required: bool = True) -> DataFrame:
    """Active tickers in order; having none is an error when required."""
    active = universe.where("active").select("ticker")
    if required and active.isEmpty():
        raise ValueError("no active tickers in the universe")
    return active.orderBy("ticker")


def scoped_prices(prices: DataFrame, universe: DataFrame | None) -> DataFrame:
    """Bars of the active tickers, or all bars when there is no active ticker to go by."""
    if universe is None:
        return prices
    active = universe.where("active").select("ticker")
    # one-row probe of the universe: deciding inside the query would scan the bars twice
    if active.isEmpty():
        warnings.warn("no active tickers found, every ticker is in scope", stacklevel=2)
        return prices
    return prices.join(active, "ticker", "left_semi").select(*prices.columns)


def universe_by_sector(universe: DataFrame) -> DataFrame:
    return (
        universe.groupBy("sector")
        .agg(
            F.count(F.lit(1)).alias("tickers"),
            F.sum(F.col("active").cast("bigint")).alias("active_tickers"),
        )
        .orderBy(F.desc("tickers"), "sector")
    )


def parse_ticker_list(lists: DataFrame, id_col: str = "list_id", text: str = "symbols") -> DataFrame:
    """Comma-separated symbols, one row per symbol."""
    return lists.select(id_col, F.explode(symbols_in_list(text)).alias("ticker"))


def list_tickers(prices: DataFrame) -> DataFrame:
    return prices.select("ticker").distinct().orderBy("ticker")


def list_tickers_page(prices: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    check_page(limit, offset, 1000)
    return list_tickers(prices).offset(offset).limit(limit)


def check_page(limit: int, offset: int, most: int) -> None:
    if not 1 <= limit <= most or offset < 0:
        raise ValueError(f"limit must be 1..{most} and offset not negative")


def price_page(
    prices: DataFrame, ticker: str, limit: int = 500, offset: int = 0, start=None, end=None
) -> DataFrame:
    """A page of one ticker's bars with the total number of matching bars."""
    check_page(limit, offset, 5000)
    rows = price_range(prices, ticker, start, end, ordered=False)
    total = rows.agg(F.count(F.lit(1))).scalar()
    page = rows.orderBy("date").offset(offset).limit(limit)
    return page.select(
        "ticker", total.alias("total"), "date", "open", "high", "low", "close", "volume"
    )
