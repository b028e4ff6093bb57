"""Declared schemas and natural keys of the tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(spec: dict[str, T.DataType], optional: set[str] = frozenset()) -> T.StructType:
    return T.StructType([T.StructField(n, t, n in optional) for n, t in spec.items()])


_S, _D, _F, _L, _TS, _B = (
    T.StringType(),
    T.DateType(),
    T.DoubleType(),
    T.LongType(),
    T.TimestampType(),
    T.BooleanType(),
)

BARS = T.StructType(
    [
        T.StructField("ticker", _S),
        T.StructField("date", _D),
        T.StructField("open", _F),
        T.StructField("high", _F),
        T.StructField("low", _F),
        T.StructField("close", _F),
        T.StructField("volume", _L),
    ]
)
BAR_COLUMNS = BARS.fieldNames()
BAR_KEY = ["ticker", "date"]

PRICES = _struct(
    {
        "ticker": _S, "date": _D, "open": _F, "high": _F, "low": _F, "close": _F,
        "volume": _L, "ingested_at": _TS, "source": _S,
    }
)

METRIC_COLUMNS = [
    "annualized_volatility",
    "var_95",
    "var_99",
    "cvar_95",
    "cvar_99",
    "sharpe_ratio",
    "max_drawdown",
]
METRIC_KEY = ["ticker", "window_start", "window_end"]
METRICS = _struct(
    {
        "ticker": _S, "window_start": _D, "window_end": _D,
        **{name: _F for name in METRIC_COLUMNS},
        "computed_at": _TS, "computation_duration_ms": _L,
    },
    optional={"computation_duration_ms"},
)

PORTFOLIOS = _struct({"portfolio_id": _S, "name": _S, "created_at": _TS, "updated_at": _TS})
HOLDING_KEY = ["portfolio", "ticker"]
HOLDINGS = _struct({"portfolio": _S, "ticker": _S, "weight": _F})

RUNS = _struct(
    {
        "run_id": _S, "run_type": _S, "status": _S, "started_at": _TS, "finished_at": _TS,
        "rows_processed": _L, "rows_failed": _L, "tickers_processed": T.ArrayType(_S),
        "error_message": _S, "parameters": _S,
    },
    optional={
        "finished_at", "rows_processed", "rows_failed", "tickers_processed",
        "error_message", "parameters",
    },
)

SCORE_KEY = ["ticker", "check_date", "check_name"]
SCORES = _struct(
    {"check_date": _D, "ticker": _S, "check_name": _S, "score": _F, "details": _S, "checked_at": _TS}
)

UNIVERSE = _struct(
    {"ticker": _S, "company_name": _S, "sector": _S, "active": _B, "added_at": _TS},
    optional={"company_name", "sector"},
)


@dataclass(frozen=True)
class TableSpec:
    """A stored table: its schema, natural key, and the column whose month partitions it."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    dated_by: str


PRICE_TABLE = TableSpec("market_prices", PRICES, ("ticker", "date"), "date")
METRIC_TABLE = TableSpec(
    "computed_metrics", METRICS, ("ticker", "window_start", "window_end"), "window_end"
)
SCORE_TABLE = TableSpec(
    "data_quality_scores", SCORES, ("ticker", "check_date", "check_name"), "check_date"
)
RUN_TABLE = TableSpec("run_audit", RUNS, ("run_id", "started_at"), "started_at")
RUN_TICKER_TABLE = TableSpec(
    "run_tickers",
    _struct({"run_id": _S, "started_at": _TS, "ticker": _S}),
    ("run_id", "started_at", "ticker"),
    "started_at",
)
