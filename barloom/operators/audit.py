"""Run audit table: register, complete, reap, and its reports."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions import lit_or_col, whole_seconds
from barloom.schemas import RUNS

# fixed values
RUNNING, SUCCEEDED, FAILED = "running", "succeeded", "failed"
REAPED_MESSAGE = (
    "Run never reported completion; marked failed by a subsequent run. "
    "Finish time unknown, so finished_at is left NULL."
)


def reap_orphan_runs(runs: DataFrame, run_type: str) -> DataFrame:
    """Runs of this type still marked running have died: failed, finish time unknown."""
    orphan = (F.col("run_type") == run_type) & (F.col("status") == RUNNING)
    return runs.withColumns(
        {
            "status": F.when(orphan, F.lit(FAILED)).otherwise(F.col("status")),
            "error_message": F.when(orphan, F.lit(REAPED_MESSAGE)).otherwise(F.col("error_message")),
        }
    )


def register_run(
    runs: DataFrame, run_id: str, run_type: str, started_at: datetime, parameters: dict
) -> DataFrame:
    """The audit table with one more running row; parameters are kept as JSON."""
    spark = runs.sparkSession
    names = sorted(parameters)
    as_json = F.to_json(F.struct(*[F.lit(parameters[n]).alias(n) for n in names]))
    row = spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_type).alias("run_type"),
        F.lit(RUNNING).alias("status"),
        F.lit(started_at).cast("timestamp").alias("started_at"),
        F.lit(None).cast("timestamp").alias("finished_at"),
        F.lit(0).cast("bigint").alias("rows_processed"),
        F.lit(0).cast("bigint").alias("rows_failed"),
        F.lit(None).cast("array<string>").alias("tickers_processed"),
        F.lit(None).cast("string").alias("error_message"),
        (as_json if names else F.lit("{}")).alias("parameters"),
    )
    return runs.select(*RUNS.fieldNames()).unionByName(row)


def _listed(tickers: DataFrame) -> Column:
    """All distinct tickers, sorted, as one array."""
    return tickers.agg(F.array_sort(F.collect_set("ticker"))).scalar()


def complete_run(
    runs: DataFrame,
    run_id: str,
    finished_at: datetime | Column,
    rows_processed: int | Column,
    tickers: DataFrame,
    rows_failed: int | Column | None = None,
) -> DataFrame:
    """Mark one run succeeded, with counts and all tickers it touched, sorted.

    The list is one cell of the audit table, whatever its length; it is as long as the
    universe at most. `run_tickers` has the same as rows.
    """
    done = {
        "status": F.lit(SUCCEEDED),
        "finished_at": lit_or_col(finished_at).cast("timestamp"),
        "rows_processed": lit_or_col(rows_processed).cast("bigint"),
        "tickers_processed": _listed(tickers),
    }
    if rows_failed is not None:
        done["rows_failed"] = lit_or_col(rows_failed).cast("bigint")
    this = F.col("run_id") == run_id
    return runs.withColumns({c: F.when(this, v).otherwise(F.col(c)) for c, v in done.items()})


def run_tickers(run_id: str, started_at: datetime, tickers: DataFrame) -> DataFrame:
    """The tickers of a run, one row each, for runs of any size."""
    return tickers.select("ticker").distinct().select(
        F.lit(run_id).alias("run_id"),
        F.lit(started_at).cast("timestamp").alias("started_at"),
        "ticker",
    )


def run_readback(prices: DataFrame, source: str, run_start: datetime | Column) -> DataFrame:
    """Tickers a run has stored, by its source and start time."""
    written = (F.col("source") == source) & (F.col("ingested_at") >= lit_or_col(run_start))
    return prices.where(written).select("ticker").distinct()


def metrics_readback(metrics: DataFrame, run_start: datetime | Column) -> DataFrame:
    return metrics.where(F.col("computed_at") >= lit_or_col(run_start))


def run_parameters(runs: DataFrame, field: str = "ticker_source") -> DataFrame:
    """How often each value of a recorded parameter was asked for."""
    parsed = F.from_json("parameters", f"struct<{field}:string>")[field]
    return (
        runs.select("run_type", parsed.alias(field))
        .groupBy("run_type", field)
        .agg(F.count(F.lit(1)).alias("runs"))
    )


def _since(runs: DataFrame, as_of: date | Column, days: int) -> DataFrame:
    floor = F.date_sub(lit_or_col(as_of), days).cast("timestamp")
    return runs.where(F.col("started_at") >= floor)


def run_history(runs: DataFrame, as_of: date | Column, days: int = 30) -> DataFrame:
    return (
        _since(runs, as_of, days)
        .select(
            "run_id",
            F.to_date("started_at").alias("run_date"),
            "run_type",
            "status",
            "rows_processed",
            "rows_failed",
            whole_seconds(F.col("started_at"), F.col("finished_at")).alias("duration_seconds"),
            "started_at",
        )
        .orderBy(F.desc("started_at"), "run_id")
        .drop("started_at")
    )


def run_success_rate(runs: DataFrame, as_of: date | Column, days: int = 7) -> DataFrame:
    good, total = F.count_if(F.col("status") == SUCCEEDED), F.count(F.lit(1))
    return _since(runs, as_of, days).agg(
        F.round(F.try_divide(good * 100.0, total), 1).alias("success_rate_pct"),
        total.alias("total_runs"),
        F.count_if(F.col("status") == FAILED).alias("failed_runs"),
    )


def last_runs(runs: DataFrame, as_of: date | Column, days: int = 1) -> DataFrame:
    return (
        _since(runs, as_of, days)
        .select(
            "run_id",
            "run_type",
            "status",
            "started_at",
            "finished_at",
            "rows_processed",
            "rows_failed",
            whole_seconds(F.col("started_at"), F.col("finished_at")).alias("duration_sec"),
            F.array_size("tickers_processed").alias("tickers_processed_count"),
            "error_message",
        )
        .orderBy(F.desc("started_at"), "run_id")
    )
