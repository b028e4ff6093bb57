"""Exact interpolated quantiles for groups of any size and any distribution.

`percentile` and `median` keep a whole group's values in one task's memory,
which is fine for one ticker's bars but not for all tickers of a sector on a
date. Here equal values are counted first (spread over the cluster by group and
value). Then each round cuts a group at splitters taken from its own values (a
mergeable quantile summary), counts the bins exactly and keeps the bin of the
wanted rank only. Splitters follow the data, so a peaked distribution is cut as
finely as a flat one: a round leaves one or two bins of about 1/50 of the
distinct values, however close to each other, and only what the last round leaves is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITTERS = 64
ACCURACY = 16 * SPLITTERS  # a splitter's rank is off by at most one in this many


def exact_quantile(
    rows: DataFrame,
    keys: list[str],
    value: str,
    q: float = 0.5,
    rounds: int = 2,
    out: str = "quantile",
) -> DataFrame:
    """(keys, n, out): the linearly interpolated q-quantile of the non-NULL values.

    A NULL key is a group like any other. After `rounds` rounds one or two bins of about
    1/50 ** rounds of a group's distinct values each are ordered in one task.
    """
    counted = (
        rows.where(F.col(value).isNotNull())
        .groupBy(*[F.col(key).alias(f"_k{i}") for i, key in enumerate(keys)], F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    group = [f"_k{i}" for i in range(len(keys))]
    left = bracketed(counted, group, q, rounds)

    in_order = Window.partitionBy(*group).orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = left.withColumn("_end", F.col("_below") + F.sum("_c").over(in_order)).withColumn(
        "_start", F.col("_end") - F.col("_c")
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v")))

    rank = _rank(q)
    part = F.first(rank - F.floor(rank))
    found = placed.groupBy(*group).agg(
        F.first("_n").alias("n"),
        at(F.floor(rank)).alias("_a"),
        at(F.ceil(rank)).alias("_b"),
        part.alias("_w"),
    )
    between = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_w")
    return found.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], "n", between.alias(out))


def _rank(q: float) -> Column:
    return (F.col("_n") - 1) * F.lit(q)


def bracketed(counted: DataFrame, group: list[str], q: float, rounds: int) -> DataFrame:
    """The counted values (group, _v, _c) among which the rank lies, with _n, the size of
    the group, and _below, how many values are smaller than these."""
    left = counted.withColumn("_n", F.lit(None).cast("bigint")).withColumn(
        "_below", F.lit(0).cast("bigint")
    )
    for _ in range(rounds):
        left = _narrowed(left, group, q)
    return left


def _narrowed(left: DataFrame, group: list[str], q: float) -> DataFrame:
    """One round: of each group, the bin or the two neighbours that hold the wanted rank."""
    shares = F.array(*[F.lit(i / SPLITTERS) for i in range(1, SPLITTERS)])
    cuts = left.groupBy(*group).agg(
        F.array_distinct(F.percentile_approx("_v", shares, F.lit(ACCURACY))).alias("_cuts")
    )
    # a value's bin is the number of splitters below it
    binned = (
        _matched(left, cuts, group)
        .withColumn("_bin", F.size(F.filter("_cuts", lambda cut: cut < F.col("_v"))))
        .drop("_cuts")
    )
    by_bin = Window.partitionBy(*group).orderBy("_bin")  # at most SPLITTERS rows of a group
    upto = by_bin.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*group)
    low, high = F.floor(_rank(q)), F.ceil(_rank(q))
    bins = (
        binned.groupBy(*group, "_bin")
        .agg(F.sum("_c").alias("_in_bin"), F.first("_n").alias("_n"), F.first("_below").alias("_below"))
        .withColumn("_until", F.col("_below") + F.sum("_in_bin").over(upto))
        .withColumn("_n", F.coalesce("_n", F.sum("_in_bin").over(whole)))
        .withColumn("_from", F.col("_until") - F.col("_in_bin"))
        .where((F.col("_from") <= high) & (low < F.col("_until")))
    )
    kept = bins.groupBy(*group).agg(
        F.min("_bin").alias("_first"),
        F.max("_bin").alias("_last"),
        F.first("_n").alias("_n"),
        F.min("_from").alias("_below"),
    )
    found = _matched(binned.drop("_n", "_below"), kept, group)
    return found.where(F.col("_bin").between(F.col("_first"), F.col("_last"))).select(
        *group, "_v", "_c", "_n", "_below"
    )


def _matched(left: DataFrame, right: DataFrame, group: list[str]) -> DataFrame:
    """Inner join on the group, in which NULL equals NULL."""
    other = right.select(
        *[F.col(g).alias(f"{g}r") for g in group], *[c for c in right.columns if c not in group]
    )
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}r"))
    return left.join(other, same).drop(*[f"{g}r" for g in group])
