"""Distinct counts merged from daily bitmaps against exact counts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from barloom.operators.distinct_counts import daily_tickers, merged_counts, no_numbers, numbered

DAY = datetime(2024, 1, 1, 9)


def prices_of(spark, rows):
    return spark.createDataFrame(
        [(t, DAY + timedelta(days=d), source) for t, d, source in rows],
        "ticker string, ingested_at timestamp, source string",
    )


def counts(frame, by):
    return {tuple(r[k] for k in by): (r.records, r.tickers) for r in frame.collect()}


def exact(prices, by):
    frame = prices.withColumn("ingest_date", F.to_date("ingested_at")).groupBy(*by)
    return counts(
        frame.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("ticker").alias("tickers")), by
    )


def test_merged_from_daily_rows(spark):
    rows = [(f"T{(i * 7) % 300}", i % 9, ("a", "b", None)[i % 3]) for i in range(3000)]
    rows += [("HOT", i % 9, "a") for i in range(2000)] + [(None, 1, "a"), (None, 2, None)]
    prices = prices_of(spark, rows)
    daily = daily_tickers(prices, numbered(no_numbers(prices), prices)).persist()
    for by in (["ingest_date"], ["source"], ["ingest_date", "source"], []):
        assert counts(merged_counts(daily, by), by) == exact(prices, by)
    daily.unpersist()


def test_numbers_last_and_stay_dense(spark):
    first = prices_of(spark, [(f"T{i}", 0, "a") for i in range(100)])
    later = prices_of(spark, [(f"T{i}", 1, "a") for i in range(50, 400)])
    old = {r.ticker: (r.shard, r.number) for r in numbered(no_numbers(first), first).collect()}
    numbers = numbered(numbered(no_numbers(first), first), later)
    new = {r.ticker: (r.shard, r.number) for r in numbers.collect()}
    assert len(new) == numbers.count() == 400 and old.items() <= new.items()
    assert len(set(new.values())) == 400
    for shard in {s for s, _ in new.values()}:
        held = sorted(n for s, n in new.values() if s == shard)
        assert held == list(range(1, len(held) + 1))


def test_more_tickers_than_a_bitmap_holds(spark):
    many = spark.range(40_000).select(
        F.concat(F.lit("T"), "id").alias("ticker"), F.lit(0).alias("shard"), (F.col("id") + 1).alias("number")
    )
    prices = many.select("ticker", F.lit(DAY).alias("ingested_at"), F.lit("a").alias("source"))
    daily = daily_tickers(prices, many)
    assert daily.count() == 2
    assert counts(merged_counts(daily, ["source"]), ["source"]) == {("a",): (40_000, 40_000)}


def test_empty(spark):
    prices = prices_of(spark, [])
    daily = daily_tickers(prices, numbered(no_numbers(prices), prices))
    assert merged_counts(daily, ["source"]).count() == 0
