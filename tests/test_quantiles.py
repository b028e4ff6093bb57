"""Exact quantiles by splitters against numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators.quantiles import bracketed, exact_quantile


def spread(name: str, n: int) -> np.ndarray:
    dice = np.random.default_rng(11)
    return {
        "peaked": 1.0 + dice.random(n) * 1e-6,
        "flat": dice.random(n) * 1e6,
        "outliers": np.concatenate([dice.normal(0, 1e-9, n - 2), [-1e300, 1e300]]),
        "ties": dice.integers(0, 4, n).astype(float),
    }[name]


def frame(spark, groups):
    rows = [(key, float(v)) for key, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "k string, v double")


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.999, 1.0])
def test_every_distribution(spark, q):
    groups = {name: spread(name, 3001) for name in ("peaked", "flat", "outliers", "ties")}
    got = {r.k: (r.n, r.quantile) for r in exact_quantile(frame(spark, groups), ["k"], "v", q).collect()}
    for name, values in groups.items():
        assert got[name][0] == len(values)
        assert got[name][1] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-24)


@pytest.mark.parametrize("name", ["peaked", "outliers"])
def test_what_one_task_orders_is_bounded(spark, name):
    """20,000 values within a millionth: two rounds leave a handful, not the group."""
    values = spread(name, 20_000)
    counted = frame(spark, {"a": values}).select(F.col("k").alias("_k0"), F.col("v").alias("_v"))
    counted = counted.groupBy("_k0", "_v").agg(F.count(F.lit(1)).alias("_c"))
    sizes = [bracketed(counted, ["_k0"], 0.5, rounds).count() for rounds in (1, 2)]
    assert 1 <= sizes[0] <= 20_000 / 25 and 1 <= sizes[1] <= 40


def test_small_groups_null_keys_and_null_values(spark):
    rows = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("b", 5.0), (None, 3.0), (None, 4.0), ("c", None)], "k string, v double"
    )
    got = {r.k: (r.n, r.quantile) for r in exact_quantile(rows, ["k"], "v").collect()}
    assert got == {"a": (2, 1.5), "b": (1, 5.0), None: (2, 3.5)}
    assert exact_quantile(rows.limit(0), ["k"], "v").count() == 0
