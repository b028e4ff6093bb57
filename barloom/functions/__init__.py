"""Column expressions shared by the operators."""

from __future__ import annotations

import math
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

TRADING_DAYS = 252
PRECISION = 6
INFINITY = float("inf")


def lit_or_col(value: date | datetime | float | int | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def symbol(col: str | Column) -> Column:
    """Canonical ticker spelling: no outer blanks, upper case."""
    return F.upper(F.trim(col))


def symbols_in_list(col: str | Column) -> Column:
    """'aapl, msft,,' -> ['AAPL', 'MSFT']."""
    names = F.transform(F.split(col, ","), symbol)
    return F.filter(names, lambda name: name != "")


def ieee_ratio(numerator: Column, denominator: Column) -> Column:
    """Floating-point quotient; a zero denominator yields an infinity or NaN, not an error."""
    by_zero = (
        F.when(numerator > 0.0, F.lit(INFINITY))
        .when(numerator < 0.0, F.lit(-INFINITY))
        .when(numerator.isNotNull(), F.lit(float("nan")))
    )
    return F.when(denominator != 0.0, F.try_divide(numerator, denominator)).when(
        denominator == 0.0, by_zero
    )


def is_finite(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != INFINITY)


def as_loss(col: Column) -> Column:
    """Return quantile or mean -> positive loss; 0.0 - x keeps zero unsigned."""
    return F.lit(0.0) - col


def annualized(daily_std: Column) -> Column:
    return daily_std * math.sqrt(TRADING_DAYS)


def rounded(col: str | Column, digits: int = PRECISION) -> Column:
    return F.round(col, digits)


def percent(col: str | Column, digits: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * 100.0, digits)


def whole_hours(start: Column, end: Column) -> Column:
    return F.timestamp_diff("HOUR", start, end)


def whole_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def ladder(value: Column, steps: list[tuple[Column, float]], otherwise: float) -> Column:
    """First matching condition decides the score."""
    out = None
    for condition, score in steps:
        out = F.when(condition, F.lit(score)) if out is None else out.when(condition, F.lit(score))
    return out.otherwise(F.lit(otherwise))
