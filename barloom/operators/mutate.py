"""Keyed table changes as pure functions: (target, source) -> new target.

Duplicate keys inside a batch are settled by a partially aggregated group-by,
so a key that repeats in a third of the batch collapses before the shuffle.
After that every key is unique on both sides and no join key can be hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _unkeyed(keys: list[str]) -> Column:
    unkeyed = F.lit(False)
    for key in keys:
        unkeyed = unkeyed | F.isnull(key)
    return unkeyed


def _one_per_key(rows: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    # every other column extends the order, so equal ranks cannot leave the pick to chance
    rank = F.struct(*order, *[c for c in rest if c not in order])
    return (
        rows.groupBy(*keys)
        .agg(pick(F.struct(*rest), rank).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in rows.columns])
    )


def first_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _one_per_key(rows, keys, order, F.min_by)


def last_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _one_per_key(rows, keys, order, F.max_by)


def new_rows(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Rows an insert-ignore would add: unknown keys, the first of each in the batch."""
    unknown = source.join(target.select(*keys), keys, "left_anti")
    return first_per_key(unknown, keys, order).select(*target.columns)


def insert_ignore(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Stored rows win over incoming ones."""
    return target.unionByName(new_rows(target, source, keys, order))


def insert_ignore_count(
    target: DataFrame, source: DataFrame, keys: list[str]
) -> DataFrame:
    """Number of keys an insert-ignore would add; 0 for an empty batch."""
    # one aggregation of flagged keys: nothing is sorted or joined
    flagged = source.select(*keys, F.lit(False).alias("_stored")).unionByName(
        target.select(*keys, F.lit(True).alias("_stored"))
    )
    per_key = flagged.groupBy(*keys).agg(
        F.min("_stored").alias("_only_stored"), F.max("_stored").alias("_stored")
    )
    # a NULL key matches no stored one
    added = ~F.col("_only_stored") & (~F.col("_stored") | _unkeyed(keys))
    return per_key.agg(F.count_if(added).alias("inserted"))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    order: list[str],
    set_cols: list[str] | None = None,
) -> DataFrame:
    """Incoming rows win, the last of each key in the batch.

    set_cols limits what a match overwrites; inserts always take the whole row.
    """
    incoming = last_per_key(source, keys, order)
    rest = [c for c in target.columns if c not in keys]
    if set_cols is None or set(rest) <= set(set_cols):
        return _replaced(target, incoming.select(*target.columns), keys)
    return merge(
        target,
        incoming.select(*target.columns),
        keys,
        matched={c: F.col(f"new.{c}") for c in set_cols},
    )


def _replaced(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows, and the target's without an incoming one; the batch is computed once.

    Rows with a NULL key match nothing; a hash of the row keeps them apart.
    """
    columns = target.columns
    both = target.withColumn("_new", F.lit(False)).unionByName(incoming.withColumn("_new", F.lit(True)))
    apart = F.when(_unkeyed(keys), F.xxhash64(*columns))
    match = F.max("_new").over(Window.partitionBy(*keys, apart))
    stays = F.col("_new") | ~F.col("_match") | _unkeyed(keys)
    return both.withColumn("_match", match).where(stays).select(*columns)


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    matched: dict[str, Column] | None = None,
    unmatched_target: dict[str, Column] | None = None,
) -> DataFrame:
    """Three-clause merge by full outer join; keys must be unique on both sides.

    Expressions see the stored row as `old` and the incoming one as `new`.
    Unlisted columns keep the stored value; unknown keys are inserted whole.
    """
    matched, unmatched_target = matched or {}, unmatched_target or {}
    old = target.withColumn("_stored", F.lit(True)).alias("old")
    new = source.withColumn("_incoming", F.lit(True)).alias("new")
    on = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    joined = old.join(new, on, "full_outer")

    def settle(column: str) -> Column:
        stored = F.col(f"old.{column}")
        return (
            F.when(F.col("_stored").isNull(), F.col(f"new.{column}"))
            .when(F.col("_incoming").isNull(), unmatched_target.get(column, stored))
            .otherwise(matched.get(column, stored))
            .alias(column)
        )

    return joined.select(*[settle(c) for c in target.columns])


def delete_keys(target: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(doomed.select(*keys), keys, "left_anti").select(*target.columns)


def merge_universe(universe: DataFrame, listed: DataFrame) -> DataFrame:
    """Refresh the tracked tickers from a constituent list.

    Listed and known: new name and sector, active, added_at kept. Listed and
    unknown: inserted. Known but no longer listed: kept as inactive.
    """
    incoming = first_per_key(listed.select(*universe.columns), ["ticker"], ["added_at"])
    return merge(
        universe,
        incoming,
        ["ticker"],
        matched={
            "company_name": F.col("new.company_name"),
            "sector": F.col("new.sector"),
            "active": F.lit(True),
        },
        unmatched_target={"active": F.lit(False)},
    )
