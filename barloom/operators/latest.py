"""Latest stored snapshot per ticker."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barloom.operators.mutate import last_per_key


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """By window end, then by time of computation."""
    return last_per_key(metrics, ["ticker"], ["window_end", "computed_at"])


def latest_metrics_by_computed_at(metrics: DataFrame) -> DataFrame:
    """By time of computation alone, ties by window end."""
    return last_per_key(metrics, ["ticker"], ["computed_at", "window_end"])
