"""Exact distinct ticker counts that merge from day to day, by bitmaps.

`count_distinct` can't be added up: a ticker of two days counts once. Here each ticker
gets a lasting number, and a day's tickers are a set of bits. Daily rows are written once,
and any span of days or sources is the OR of their bitmaps, so a report over a year reads
its daily rows, not its bars.

Tickers are numbered within SHARDS hash shards, so numbering needs no single task, and bits
stay dense. A bitmap holds 32,768 numbers of one shard (4 KB).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 32

NUMBERS = "ticker string, shard int, number bigint"
DAILY = (
    "ingest_date date, source string, shard int, slot bigint, tickers binary, records bigint"
)


def no_numbers(prices: DataFrame) -> DataFrame:
    return prices.sparkSession.createDataFrame([], NUMBERS)


def numbered(numbers: DataFrame, prices: DataFrame) -> DataFrame:
    """The given numbers, unchanged, and one for every ticker of the bars that has none yet.

    A NULL ticker gets none. One writer at a time, as for every table.
    """
    shard = F.pmod(F.xxhash64("ticker"), F.lit(SHARDS)).cast("int")
    fresh = (
        prices.select("ticker").where(F.col("ticker").isNotNull()).distinct()
        .join(numbers.select("ticker"), "ticker", "left_anti")
        .withColumn("shard", shard)
    )
    used = numbers.groupBy("shard").agg(F.max("number").alias("used"))  # at most SHARDS rows
    # a shard's window holds its share of the symbols, not of the bars
    position = F.row_number().over(Window.partitionBy("shard").orderBy("ticker"))
    added = fresh.withColumn("position", position).join(F.broadcast(used), "shard", "left")
    number = F.coalesce("used", F.lit(0)) + F.col("position")
    return numbers.select("ticker", "shard", "number").unionByName(
        added.select("ticker", "shard", number.cast("bigint").alias("number"))
    )


def daily_tickers(prices: DataFrame, numbers: DataFrame) -> DataFrame:
    """Of each ingest day, source and bitmap slot: its tickers as bits, and how many bars.

    Bars are counted per ticker first, so a hot ticker meets its number once. Bars without
    a ticker are counted in a row without bits.
    """
    per_ticker = prices.groupBy(
        F.to_date("ingested_at").alias("ingest_date"), "source", "ticker"
    ).agg(F.count(F.lit(1)).alias("records"))
    rows = per_ticker.join(numbers, "ticker", "left")
    return rows.groupBy(
        "ingest_date", "source", "shard", F.bitmap_bucket_number("number").alias("slot")
    ).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("tickers"),
        F.sum("records").alias("records"),
    )


def merged_counts(
    daily: DataFrame, by: list[str], records: str = "records", tickers: str = "tickers"
) -> DataFrame:
    """Bars and exact distinct tickers of each group of daily rows."""
    slots = daily.groupBy(*by, "shard", "slot").agg(
        F.bitmap_or_agg("tickers").alias("bits"), F.sum("records").alias("bars")
    )
    seen = F.when(F.col("shard").isNull(), F.lit(0)).otherwise(F.bitmap_count("bits"))
    return slots.groupBy(*by).agg(
        F.sum("bars").alias(records), F.sum(seen).cast("bigint").alias(tickers)
    )
