"""The daily run over stored tables: ingest, quality scores, risk metrics.

Each step audits itself. A step that dies leaves its run marked running, and
the next run of the same type marks it failed. Every step writes its result
once and answers later questions from the stored table, not by computing again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import audit, quality, risk, validate
from barloom.operators.universe import scoped_prices
from barloom.schemas import (
    METRIC_TABLE,
    PRICE_TABLE,
    RUN_TABLE,
    RUN_TICKER_TABLE,
    SCORE_TABLE,
    TableSpec,
)
from barloom.session import scratch_path
from barloom.sources.files import read_table
from barloom.sources.upserts import read_stored, store


@dataclass(frozen=True)
class Tables:
    """The stored tables below one folder."""

    spark: SparkSession
    root: str

    def path(self, spec: TableSpec) -> str:
        return f"{self.root.rstrip('/')}/{spec.name}"

    def read(self, spec: TableSpec) -> DataFrame:
        return read_stored(self.spark, self.path(spec), spec)

    def write(self, spec: TableSpec, rows: DataFrame, order: list[str], policy="upsert") -> None:
        constraints = validate.PRICE_CONSTRAINTS if spec is PRICE_TABLE else None
        store(self.spark, self.path(spec), rows, order, spec, policy, constraints=constraints)


def _start(tables: Tables, run_id: str, run_type: str, now: datetime, parameters: dict) -> None:
    runs = tables.read(RUN_TABLE)
    orphans = runs.where((F.col("run_type") == run_type) & (F.col("status") == audit.RUNNING))
    changed = audit.register_run(
        audit.reap_orphan_runs(orphans, run_type), run_id, run_type, now, parameters
    )
    tables.write(RUN_TABLE, changed, ["started_at"])


def _finish(
    tables: Tables, run_id: str, now: datetime, rows: int, tickers: DataFrame, failed: int = 0
) -> None:
    this = tables.read(RUN_TABLE).where(F.col("run_id") == run_id)
    tables.write(RUN_TICKER_TABLE, audit.run_tickers(run_id, now, tickers), ["ticker"])
    tables.write(
        RUN_TABLE, audit.complete_run(this, run_id, now, rows, tickers, failed), ["started_at"]
    )


def run_ingest(
    tables: Tables,
    raw: DataFrame,
    source: str,
    run_id: str,
    now: datetime,
    policy: str = "upsert",
    profile: str = "full",
    ticker: str | None = None,
    parameters: dict | None = None,
) -> dict[str, int]:
    """Validate raw price rows and merge them; failures are counted over all rows."""
    _start(tables, run_id, "ingest", now, {"source": source, **(parameters or {})})
    landed = scratch_path(tables.spark, "raw")
    raw.write.parquet(landed)  # counted and merged from one copy
    raw = read_table(tables.spark, landed, raw.schema)
    counts = validate.validation_counts(raw, profile).first()
    rows = validate.stamp(validate.validate(raw, profile, ticker), source, now)
    before = tables.read(PRICE_TABLE).count()
    tables.write(PRICE_TABLE, rows, ["open", "high", "low", "close", "volume"], policy)
    stored = tables.read(PRICE_TABLE)
    touched = audit.run_readback(stored, source, now)
    _finish(tables, run_id, now, counts.total_valid, touched, counts.failures)
    return {
        "valid": counts.total_valid,
        "failures": counts.failures,
        "inserted": stored.count() - before,
    }


def run_quality(
    tables: Tables,
    run_id: str,
    as_of: date,
    now: datetime,
    universe: DataFrame | None = None,
    thresholds: quality.Thresholds = quality.DEFAULTS,
) -> int:
    """Score the tickers in scope; returns the scores stored for the day."""
    _start(tables, run_id, "quality_check", now, {"restricted": universe is not None})
    prices = scoped_prices(tables.read(PRICE_TABLE), universe)
    tables.write(SCORE_TABLE, quality.quality_scores(prices, as_of, now, thresholds), ["checked_at"])
    today = tables.read(SCORE_TABLE).where(F.col("check_date") == as_of)
    scores = today.count()
    _finish(tables, run_id, now, scores, today)
    return scores


def run_metrics(
    tables: Tables,
    run_id: str,
    now: datetime,
    window_days: int = 365,
    min_price_points: int = 30,
    risk_free_rate: float = risk.RISK_FREE,
) -> int:
    """Metric sets of the trailing window; returns how many this run stored."""
    parameters = {
        "metrics_window_days": window_days,
        "min_price_points": min_price_points,
        "risk_free_rate": risk_free_rate,
    }
    _start(tables, run_id, "metrics", now, parameters)
    prices = tables.read(PRICE_TABLE)
    sets = risk.risk_metrics_trailing(
        prices, window_days, min_price_points, risk_free_rate, digits=None
    )
    stamped = sets.withColumn("computed_at", F.lit(now)).withColumn(
        "computation_duration_ms", F.lit(None).cast("bigint")
    )
    tables.write(METRIC_TABLE, stamped, ["computed_at"])
    mine = audit.metrics_readback(tables.read(METRIC_TABLE), now)
    rows = mine.count()
    _finish(tables, run_id, now, rows, mine)
    return rows
