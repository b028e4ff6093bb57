"""Price, universe, portfolio and audit tables derived from the order tables.

The given tables hold no bars. Each order line is taken as a tick: traded at its
ship date, in a symbol chosen per binding, at a price near 100. Every derivation
covers its whole tables.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.risk import risk_metrics
from barloom.schemas import BAR_COLUMNS

LISTED_ON = date(2024, 1, 1)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tick_price() -> Column:
    """90.0 to 109.1 for every line."""
    return F.lit(100.0) * (F.lit(1.0) + F.col("l_tax") - F.col("l_discount")) + (
        F.col("l_extendedprice") / 100000.0
    )


def supplier_symbol(key: str = "l_suppkey", prefix: str = "S") -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), 6, "0"))


def _ticks(lines: DataFrame, ticker: Column) -> DataFrame:
    return lines.select(
        ticker.alias("ticker"),
        F.col("l_shipdate").cast("date").alias("date"),
        "l_orderkey",
        "l_linenumber",
        tick_price().alias("px"),
        "l_quantity",
        "l_returnflag",
    )


def bars_from_ticks(ticks: DataFrame) -> DataFrame:
    """Daily bars; partial aggregates collapse a hot ticker before the shuffle.

    (order, line) repeats, so price is the last part of the order of ticks.
    """
    moment = F.struct("l_orderkey", "l_linenumber", "px")
    return ticks.groupBy("ticker", "date").agg(
        F.min(moment)["px"].alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.max(moment)["px"].alias("close"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
        F.max("l_returnflag").alias("flag"),
    )


def _priced(bars: DataFrame) -> DataFrame:
    source = (
        F.when(F.col("flag") == "A", "s3").when(F.col("flag") == "N", "volume").otherwise("auto_loader")
    )
    evening = F.col("date").cast("timestamp") + F.expr("INTERVAL 18 HOURS")
    return bars.select(*BAR_COLUMNS, evening.alias("ingested_at"), source.alias("source"))


def prices_supplier(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return _priced(bars_from_ticks(_ticks(lines, supplier_symbol())))


def _with_parts(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    lines = table(spark, folder, "lineitem")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def prices_brand(spark: SparkSession, folder: str) -> DataFrame:
    return _priced(bars_from_ticks(_ticks(_with_parts(spark, folder), F.upper("p_brand"))))


def prices_type(spark: SparkSession, folder: str) -> DataFrame:
    return _priced(bars_from_ticks(_ticks(_with_parts(spark, folder), F.col("p_type"))))


def last_ship_date(spark: SparkSession, folder: str) -> Column:
    """The last bar date of every price binding, as a scalar subquery."""
    return table(spark, folder, "lineitem").agg(F.max("l_shipdate").cast("date")).scalar()


def scoring_time(spark: SparkSession, folder: str) -> Column:
    """20 hours after the last ingest."""
    return last_ship_date(spark, folder).cast("timestamp") + F.expr("INTERVAL 38 HOURS")


def bars(prices: DataFrame) -> DataFrame:
    return prices.select(*BAR_COLUMNS)


# -- table versions ------------------------------------------------------------


def version_1(spark: SparkSession, folder: str) -> DataFrame:
    """Bars while only the finished lines had arrived."""
    lines = table(spark, folder, "lineitem").where(F.col("l_linestatus") == "F")
    return bars(bars_from_ticks(_ticks(lines, supplier_symbol())))


def version_2(spark: SparkSession, folder: str) -> DataFrame:
    """Bars once the open lines had arrived too."""
    return bars(prices_supplier(spark, folder))


def version_3(spark: SparkSession, folder: str) -> DataFrame:
    """Bars after returned lines were taken out."""
    lines = table(spark, folder, "lineitem").where(F.col("l_returnflag") != "R")
    return bars(bars_from_ticks(_ticks(lines, supplier_symbol())))


def late_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A batch that brings most keys twice."""
    return version_2(spark, folder).unionByName(version_3(spark, folder))


# -- raw rows with defects -------------------------------------------------------


def raw_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """Every tick as a raw price row: odd spelling, missing cells, swapped and negative values."""
    symbol = supplier_symbol()
    px = tick_price()
    spelled = (
        F.when(F.col("l_tax") >= 0.075, F.lit(" "))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("  "), F.lower(symbol), F.lit(" ")))
        .otherwise(symbol)
    )
    return table(spark, folder, "lineitem").select(
        spelled.alias("ticker"),
        F.when(F.col("l_quantity") < 50, F.col("l_shipdate").cast("date")).alias("date"),
        px.alias("open"),
        (px + F.col("l_tax") - F.lit(0.005)).alias("high"),
        px.alias("low"),
        F.when(F.col("l_discount") < 0.095, px).alias("close"),
        (F.col("l_quantity") - 2).cast("bigint").alias("volume"),
        "l_returnflag",
    )


# -- universes --------------------------------------------------------------------


def universe_supplier(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    # nation and region have 25 and 5 rows at every scale
    return (
        table(spark, folder, "supplier")
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            supplier_symbol("s_suppkey").alias("ticker"),
            F.col("s_name").alias("company_name"),
            F.col("r_name").alias("sector"),
            (F.col("s_acctbal") >= 0).alias("active"),
            F.lit(LISTED_ON).cast("timestamp").alias("added_at"),
        )
    )


def universe_brand(spark: SparkSession, folder: str) -> DataFrame:
    """Brands; active while they make the largest size."""
    return (
        table(spark, folder, "part")
        .groupBy(F.upper("p_brand").alias("ticker"))
        .agg(F.max("p_brand").alias("company_name"), (F.max("p_size") == 50).alias("active"))
        .select(
            "ticker",
            "company_name",
            F.lit("GOODS").alias("sector"),
            "active",
            F.lit(LISTED_ON).cast("timestamp").alias("added_at"),
        )
    )


def unlisted_symbols(spark: SparkSession, folder: str) -> DataFrame:
    """One tracked symbol per nation that never trades."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return nation.join(
        F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        F.col("n_name").alias("ticker"),
        F.col("n_name").alias("company_name"),
        F.col("r_name").alias("sector"),
        F.lit(True).alias("active"),
        F.lit(LISTED_ON).cast("timestamp").alias("added_at"),
    )


def listed_now(spark: SparkSession, folder: str) -> DataFrame:
    """A newer constituent list: indebted suppliers gone, regions renamed, nations added."""
    kept = universe_supplier(spark, folder).where("active").withColumn(
        "sector", F.lower("sector")
    )
    return kept.unionByName(unlisted_symbols(spark, folder)).withColumn(
        "added_at", F.lit(date(2025, 1, 1)).cast("timestamp")
    )


def symbol_lists(spark: SparkSession, folder: str) -> DataFrame:
    """One untidy comma-separated list per supplier: its own, its nation's and its region's name."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        table(spark, folder, "supplier")
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("list_id"),
            F.concat(
                F.lower("s_name"), F.lit(" , "), F.lower("n_name"), F.lit(",,"), F.lower("r_name"), F.lit(",")
            ).alias("symbols"),
        )
    )


# -- portfolios --------------------------------------------------------------------


def supplier_books(spark: SparkSession, folder: str) -> DataFrame:
    """A portfolio per supplier: the quantity it shipped of every part type."""
    return (
        _with_parts(spark, folder)
        .groupBy(supplier_symbol(prefix="P").alias("portfolio"), F.col("p_type").alias("ticker"))
        .agg(F.sum("l_quantity").alias("weight"))
    )


def returned_books(spark: SparkSession, folder: str) -> DataFrame:
    """The same portfolios by returned quantities only."""
    returned = _with_parts(spark, folder).where(F.col("l_returnflag") == "R")
    return returned.groupBy(
        supplier_symbol(prefix="P").alias("portfolio"), F.col("p_type").alias("ticker")
    ).agg(F.sum("l_quantity").alias("weight"))


def order_symbol(key: str) -> Column:
    return F.concat(F.lit("O"), F.col(key).cast("string"))


def order_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every order asks for a portfolio of its lines' part types; an order without lines is empty."""
    lines = _with_parts(spark, folder).select(
        "l_orderkey",
        F.concat(F.lit(" "), F.lower("p_type")).alias("ticker"),
        (F.col("l_quantity") - 1.0).alias("weight"),
    )
    orders = table(spark, folder, "orders").select("o_orderkey")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        order_symbol("o_orderkey").alias("portfolio"), "ticker", "weight"
    )


def order_portfolios(spark: SparkSession, folder: str) -> DataFrame:
    """Portfolios stored already: those of the finished orders."""
    done = table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    return done.select(order_symbol("o_orderkey").alias("portfolio"))


# -- stored metrics ------------------------------------------------------------------


def stored_metrics(
    spark: SparkSession, folder: str, risk_free_rate: float = 0.02
) -> DataFrame:
    """A snapshot per ticker and year, all years in one pass, as the metrics table stores them."""
    prices = prices_supplier(spark, folder)
    yearly = prices.withColumn("ticker", F.concat_ws("@", "ticker", F.year("date")))
    sets = risk_metrics(yearly, risk_free_rate=risk_free_rate, digits=None)
    return sets.withColumns(
        {
            "ticker": F.regexp_replace("ticker", "@[0-9]{4}$", ""),
            "computed_at": F.date_add("window_end", 1).cast("timestamp"),
            "computation_duration_ms": F.lit(None).cast("bigint"),
        }
    )


# -- audit ------------------------------------------------------------------------------


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as an audited run."""
    urgency = F.substring("o_orderpriority", 1, 1)
    kind = (
        F.when(urgency <= "2", "ingest").when(urgency == "3", "metrics").otherwise("quality_check")
    )
    status = (
        F.when(F.col("o_orderstatus") == "O", "running")
        .when(F.col("o_orderstatus") == "F", "succeeded")
        .otherwise("failed")
    )
    ended = F.col("o_orderstatus") != "O"
    start = F.col("o_orderdate").cast("timestamp")
    seconds = F.floor(F.col("o_totalprice") / 1000).cast("int")
    asked = F.when(urgency == "1", "list").otherwise("universe")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        kind.alias("run_type"),
        status.alias("status"),
        start.alias("started_at"),
        F.when(ended, start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).alias("finished_at"),
        F.col("o_custkey").alias("rows_processed"),
        F.lit(0).cast("bigint").alias("rows_failed"),
        F.when(ended, F.split("o_orderpriority", "-")).alias("tickers_processed"),
        F.when(F.col("o_orderstatus") == "P", "source unavailable").alias("error_message"),
        F.to_json(
            F.struct(asked.alias("ticker_source"), F.col("o_custkey").alias("ticker_count"))
        ).alias("parameters"),
    )


def last_run_date(spark: SparkSession, folder: str) -> Column:
    return table(spark, folder, "orders").agg(F.max("o_orderdate").cast("date")).scalar()
