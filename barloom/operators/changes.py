"""Row-level change feed between two versions of a keyed table.

Versions are compared by ranges of keys first: a range whose digests agree in both has
no changes, and only the rows of the others are shuffled and joined.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions import lit_or_col

INSERT = "insert"
DELETE = "delete"
BEFORE = "update_preimage"
AFTER = "update_postimage"

# Ranges are a bucket of the first key and a month, so at most 2^18 of them: what is
# broadcast of them has a fixed bound.
RANGE_BUCKETS, RANGE_MONTHS = 1024, 256


def _range(rows: DataFrame, keys: list[str]) -> Column:
    """The number of a row's range: bucket of the first undated key, month of the first dated."""
    kinds = dict(rows.dtypes)
    dated = [k for k in keys if kinds[k].startswith(("date", "timestamp"))]
    plain = [k for k in keys if k not in dated] or keys
    bucket = F.pmod(F.xxhash64(plain[0]), F.lit(RANGE_BUCKETS))
    if dated:
        month = F.year(dated[0]) * 12 + F.month(dated[0])
    else:
        month = F.xxhash64(*keys)
    number = bucket * RANGE_MONTHS + F.pmod(month, F.lit(RANGE_MONTHS))
    return F.coalesce(number, F.lit(-1)).cast("long")


def range_digests(rows: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """(range, rows, mixed, added, unkeyed): per range the number of rows, two digests that do
    not depend on their order, and how many rows have a NULL key."""
    # a NULL leaves a hash as it is, so the flags say where it stands
    marked = [c for name in [*keys, *compare] for c in (F.isnull(name), F.col(name))]
    unkeyed = F.lit(False)
    for key in keys:
        unkeyed = unkeyed | F.isnull(key)
    return rows.groupBy(_range(rows, keys).alias("range")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(F.xxhash64(F.lit(1), *marked)).alias("mixed"),
        F.sum(F.pmod(F.xxhash64(F.lit(2), *marked), F.lit(1 << 32))).alias("added"),
        F.count_if(unkeyed).alias("unkeyed"),
    )


def changed_ranges(
    before: DataFrame, after: DataFrame, keys: list[str], compare: list[str]
) -> DataFrame:
    """The ranges that may hold changes. Rows without a key match nothing, so theirs are among them."""
    facts = ["rows", "mixed", "added", "unkeyed"]
    old = range_digests(before, keys, compare).select("range", F.struct(*facts).alias("old"))
    new = range_digests(after, keys, compare).select("range", F.struct(*facts).alias("new"))
    differ = ~F.col("old").eqNullSafe(F.col("new")) | (F.col("old.unkeyed") > 0)
    return old.join(new, "range", "full_outer").where(differ).select("range")


def snapshot_diff(
    before: DataFrame,
    after: DataFrame,
    keys: list[str],
    version: int,
    committed_at: datetime | Column | None = None,
    compare: list[str] | None = None,
) -> DataFrame:
    """One insert or delete row, or a pre- and a post-image, per changed key."""
    columns = before.columns
    compare = compare or [c for c in columns if c not in keys]
    ranges = F.broadcast(changed_ranges(before, after, keys, compare))

    def touched(rows: DataFrame) -> DataFrame:
        # the range comes out of a generator, so that the join can't sink below the aggregate of a
        # computed version: it is read where it was digested instead of being computed again
        ranged = rows.select("*", F.explode(F.array(_range(rows, keys))).alias("_range"))
        return ranged.join(ranges, F.col("_range") == F.col("range"), "left_semi")

    old = touched(before).select(F.struct(*columns).alias("old"))
    new = touched(after).select(F.struct(*columns).alias("new"))
    on = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]

    def image(side: str, kind: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(side).alias("row"))

    same = F.lit(True)
    for c in compare:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    changes = (
        F.when(F.col("old").isNull(), F.array(image("new", INSERT)))
        .when(F.col("new").isNull(), F.array(image("old", DELETE)))
        .when(~same, F.array(image("old", BEFORE), image("new", AFTER)))
    )
    return (
        old.join(new, on, "full_outer")
        .select(F.explode(changes).alias("change"))
        .select(
            F.col("change.kind").alias("_change_type"),
            F.lit(version).cast("bigint").alias("_commit_version"),
            lit_or_col(committed_at).cast("timestamp").alias("_commit_timestamp"),
            "change.row.*",
        )
    )


def apply_changes(base: DataFrame, feed: DataFrame, keys: list[str]) -> DataFrame:
    """Replay a feed on the version it starts from."""
    untouched = base.join(feed.select(*keys).distinct(), keys, "left_anti")
    written = feed.where(F.col("_change_type").isin(INSERT, AFTER))
    return untouched.select(*base.columns).unionByName(written.select(*base.columns))


def change_volume(feed: DataFrame) -> DataFrame:
    return feed.groupBy("_commit_version", "_change_type").agg(
        F.min("_commit_timestamp").alias("committed_at"), F.count(F.lit(1)).alias("changes")
    )


def newest_changes(feed: DataFrame, since: datetime | Column, limit: int = 100) -> DataFrame:
    """Feed rows committed from `since` on, newest first."""
    shown = ["_change_type", "_commit_version", "_commit_timestamp", "ticker", "date", "close", "volume"]
    if "source" in feed.columns:
        shown.append("source")
    return (
        feed.where(F.col("_commit_timestamp") >= lit_or_col(since))
        .select(*shown)
        .orderBy(F.desc("_commit_timestamp"), "ticker", "date", "_change_type")
        .limit(limit)
    )
