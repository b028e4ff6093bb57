"""Wide download frames: one row per date, one column per field and ticker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import symbol
from barloom.schemas import BAR_COLUMNS

FIELDS = ["open", "high", "low", "close", "volume"]
SEPARATOR = "|"


def wide_column(ticker: str, field: str) -> str:
    return f"{ticker}{SEPARATOR}{field}"


def tickers_of(wide: DataFrame) -> list[str]:
    ends = f"{SEPARATOR}close"
    return [c[: -len(ends)] for c in wide.columns if c.endswith(ends)]


def tidy_wide_bars(wide: DataFrame, date_col: str = "date") -> DataFrame:
    """Long bars without any shuffle; a bar with a missing field is dropped."""
    bars = F.array(
        *[
            F.struct(
                F.lit(t).alias("ticker"),
                *[F.col(f"`{wide_column(t, f)}`").cast("double").alias(f) for f in FIELDS],
            )
            for t in tickers_of(wide)
        ]
    )
    long = wide.select(F.col(date_col).cast("date").alias("date"), F.inline(bars))
    for field in FIELDS:
        long = long.where(F.col(field).isNotNull() & ~F.isnan(field))
    return long.select(
        symbol("ticker").alias("ticker"),
        *[F.col(c).cast("bigint").alias(c) if c == "volume" else F.col(c) for c in BAR_COLUMNS[1:]],
    )


def tidy_no_data(requested: DataFrame, bars: DataFrame) -> DataFrame:
    """Requested tickers for which no usable bar came back."""
    asked = requested.select(symbol("ticker").alias("ticker")).distinct()
    return asked.join(bars.select("ticker").distinct(), "ticker", "left_anti")
