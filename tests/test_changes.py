"""Change feeds by ranges against the whole comparison."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.operators import changes

KEYS = ["ticker", "date"]
KINDS = "ticker string, date date, close double, volume long"


def whole(before, after, compare):
    """Every key of both versions compared, in plain Python; rows without a key match none."""
    out = []
    old, new = ({r[:2]: r for r in rows if None not in r[:2]} for rows in (before, after))
    for rows, kind in ((before, changes.DELETE), (after, changes.INSERT)):
        out += [(kind, *r) for r in rows if None in r[:2]]
    for key in old.keys() | new.keys():
        if key not in new:
            out.append((changes.DELETE, *old[key]))
        elif key not in old:
            out.append((changes.INSERT, *new[key]))
        elif any(old[key][i] != new[key][i] for i in compare):
            out += [(changes.BEFORE, *old[key]), (changes.AFTER, *new[key])]
    return sorted(out, key=repr)


@pytest.fixture
def versions():
    rng = random.Random(4)
    days = [date(2020, 1, 1) + timedelta(days=n) for n in range(0, 700, 3)]
    before = [(t, d, rng.choice([1.0, 2.0, None]), rng.randrange(3)) for t in ("A", "B", "C") for d in days]
    after = [r for r in before if rng.random() > 0.01]
    after = [(*r[:2], 5.0, r[3]) if rng.random() < 0.02 else r for r in after]
    after = [(r[0], r[1], float(r[3]), None) if rng.random() < 0.01 else r for r in after]
    after += [("D", d, 1.0, 1) for d in days[:3]]
    unkeyed = [(None, days[0], 1.0, 1), ("A", None, 2.0, 2)]
    return before + unkeyed, after + unkeyed


@pytest.mark.parametrize("compare", [["close", "volume"], ["volume"]])
def test_feed_is_that_of_a_whole_comparison(spark, versions, compare):
    old, new = (spark.createDataFrame(rows, KINDS).repartition(3) for rows in versions)
    feed = changes.snapshot_diff(old, new, KEYS, 2, compare=compare)
    found = feed.select("_change_type", "ticker", "date", "close", "volume").collect()
    assert sorted(map(tuple, found), key=repr) == whole(*versions, [2 + (c == "volume") for c in compare])


def test_swapped_nulls_are_a_change(spark):
    old = spark.createDataFrame([("A", date(2020, 1, 1), 1.0, None)], KINDS)
    new = old.select("ticker", "date", F.lit(None).cast("double").alias("close"), F.lit(1).cast("long").alias("volume"))
    assert changes.snapshot_diff(old, new, KEYS, 2).count() == 2


def test_keys_without_a_date(spark):
    old = spark.createDataFrame([(n, n) for n in range(500)], "k long, v long")
    new = old.withColumn("v", F.when(F.col("k") == 77, 0).otherwise(F.col("v")))
    feed = changes.snapshot_diff(old, new, ["k"], 2)
    assert [(r.k, r.v) for r in feed.orderBy("_change_type").collect()] == [(77, 0), (77, 77)]
    assert changes.changed_ranges(old, new, ["k"], ["v"]).count() == 1
    assert changes.snapshot_diff(old, old, ["k"], 2).isEmpty()


def test_unchanged_ranges_are_not_shuffled(spark, tmp_path):
    days = [date(2020, 1, 1) + timedelta(days=n) for n in range(400)]
    rows = [(f"T{n}", d, 1.0, 1) for n in range(20) for d in days]
    old_path, new_path = str(tmp_path / "old"), str(tmp_path / "new")
    spark.createDataFrame(rows, KINDS).write.parquet(old_path)
    changed = F.when((F.col("ticker") == "T3") & (F.col("date") == days[200]), 9.0).otherwise(F.col("close"))
    spark.read.parquet(old_path).withColumn("close", changed).write.parquet(new_path)
    feed = changes.snapshot_diff(spark.read.parquet(old_path), spark.read.parquet(new_path), KEYS, 2)
    assert feed.count() == 2
    plan = feed._jdf.queryExecution().executedPlan()
    feed.collect()
    text = plan.toString()
    assert "FullOuter" in text and text.count("BroadcastHashJoin") >= 2 and "LeftSemi" in text
    # what reaches the join: the rows of one ticker bucket and month, of both versions
    frame = spark.read.parquet(old_path)
    ranges = changes.changed_ranges(frame, spark.read.parquet(new_path), KEYS, ["close", "volume"])
    kept = frame.withColumn("range", changes._range(frame, KEYS)).join(ranges, "range", "left_semi")
    assert ranges.count() == 1 and kept.count() <= 31 * 20 and kept.where("ticker <> 'T3'").count() < 200


def test_computed_versions_are_computed_once(spark):
    lines = spark.range(300).select(
        (F.col("id") % 7).cast("string").alias("ticker"), F.expr("date_add(date'2024-01-01', int(id % 40))").alias("date"), "id"
    )
    one = lines.groupBy("ticker", "date").agg(F.max("id").alias("volume"))
    two = lines.where("id % 3 > 0").groupBy("ticker", "date").agg(F.max("id").alias("volume"))
    feed = changes.snapshot_diff(one, two, ["ticker", "date"], 1)
    kinds = {r._change_type: r.n for r in feed.groupBy("_change_type").agg(F.count("*").alias("n")).collect()}
    old, new = ({(r.ticker, r.date): r.volume for r in v.collect()} for v in (one, two))
    moved = sum(new[k] != old[k] for k in new)
    assert moved and kinds == {"delete": len(set(old) - set(new)), "update_preimage": moved, "update_postimage": moved}
    # the semi join stays above the aggregates, so both are those that were digested
    above = feed._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[0]
    assert "LeftSemi" in above and "Generate" in above
