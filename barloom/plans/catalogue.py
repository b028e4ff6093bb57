"""Named queries: each binds an operator to the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import (
    audit,
    changes,
    distinct_counts,
    latest,
    metric_state,
    mutate,
    portfolio,
    quality,
    returns,
    risk,
    rolling,
    universe,
    validate,
)
from barloom.plans import bindings as b
from barloom.plans import reports
from barloom.schemas import BAR_COLUMNS, BAR_KEY, METRIC_COLUMNS, METRIC_KEY, SCORE_KEY
from barloom.session import scratch_path
from barloom.sources import files, wide
from barloom.sources.portfolios import PortfolioStore
from barloom.sources.upserts import read_stored
from barloom.streaming.incremental import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]

TICKER = "S000003"
BOOK = "P000003"
CLOSED_BOOK = "P000002"
WINDOW_DAYS = 365
DENSE = 50  # bars a ticker needs in the window to be eligible
YEAR = (date(2000, 1, 1), date(2000, 12, 31))
INGEST_START = datetime(2001, 6, 1)

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _on_supplier(name: str, operator, **options) -> None:
    QUERIES[name] = lambda s, d: operator(b.prices_supplier(s, d), **options)


# -- scans --------------------------------------------------------------------


def _as_csv(s: SparkSession, rows: DataFrame) -> str:
    path = scratch_path(s, "csv")
    files.write_csv(rows, path)
    return path


@query
def scan_csv(s, d):
    return files.scan_csv(s, _as_csv(s, b.bars(b.prices_supplier(s, d))))


@query
def scan_csv_inferred(s, d):
    return files.scan_csv_inferred(s, _as_csv(s, b.bars(b.prices_supplier(s, d))))


@query
def stream_incremental_ingest(s, d):
    rows = b.bars(b.prices_supplier(s, d))
    inbox, table = scratch_path(s, "inbox"), scratch_path(s, "prices")
    checkpoint = scratch_path(s, "checkpoint")
    files.write_csv(rows.where(F.col("date") < "1999-01-01"), inbox)
    ingest_new_files(s, inbox, table, checkpoint)
    files.write_csv(rows.where(F.col("date") >= "1999-01-01"), inbox, mode="append")
    ingest_new_files(s, inbox, table, checkpoint)
    return read_stored(s, table).select(*BAR_COLUMNS)


def _wide_brands(s, d) -> DataFrame:
    prices = b.prices_brand(s, d)
    # a wide frame has a column per ticker, so its tickers have to be known to lay it out
    names = b.table(s, d, "part").select(F.upper("p_brand").alias("ticker")).distinct()
    brands = [r["ticker"] for r in names.orderBy("ticker").collect()]
    cells = [
        F.max(F.when(F.col("ticker") == t, F.col(f))).alias(wide.wide_column(t, f))
        for t in brands
        for f in wide.FIELDS
    ]
    return prices.groupBy("date").agg(*cells)


@query
def tidy_wide_bars(s, d):
    return wide.tidy_wide_bars(_wide_brands(s, d))


@query
def tidy_no_data(s, d):
    asked = b.unlisted_symbols(s, d).select("ticker").unionByName(
        b.universe_brand(s, d).select("ticker")
    )
    return wide.tidy_no_data(asked, b.prices_brand(s, d))


@query
def union_by_name(s, d):
    rows = b.bars(b.prices_supplier(s, d))
    early = rows.where(F.col("date") < "1997-01-01")
    middle = rows.where((F.col("date") >= "1997-01-01") & (F.col("date") < "2000-01-01"))
    late = rows.where(F.col("date") >= "2000-01-01")
    return files.union_by_name(
        [early, middle.select(*reversed(BAR_COLUMNS)), late.select(*sorted(BAR_COLUMNS))]
    )


@query
def parse_ticker_list(s, d):
    return universe.parse_ticker_list(b.symbol_lists(s, d))


@query
def active_universe(s, d):
    return universe.active_universe(b.universe_supplier(s, d))


@query
def tickers_by_prefix(s, d):
    return returns.tickers_by_prefix(b.prices_supplier(s, d), "s00000")


# -- validation -----------------------------------------------------------------


@query
def normalize_validate(s, d):
    raw = b.raw_dirty(s, d)
    at = F.lit(datetime(2002, 1, 1)).cast("timestamp")
    return validate.stamp(validate.validate(raw), "s3", at)


@query
def validate_service_profile(s, d):
    return validate.validate(b.raw_dirty(s, d), profile="service")


@query
def validation_counts(s, d):
    raw = b.raw_dirty(s, d)
    return validate.validation_counts(raw, "full").unionByName(
        validate.validation_counts(raw, "service")
    )


@query
def validate_ticker_filter(s, d):
    return validate.ticker_filter_counts(b.raw_dirty(s, d), TICKER.lower())


@query
def constraint_violations(s, d):
    prices = validate.constraint_violations(b.raw_dirty(s, d), validate.PRICE_CONSTRAINTS)
    weights = portfolio.request_legs(b.order_requests(s, d)).withColumn(
        "weight", F.col("weight") / 40.0
    )
    return prices.unionByName(
        validate.constraint_violations(weights, validate.HOLDING_CONSTRAINTS)
    )


@query
def price_range(s, d):
    rows = returns.price_range(b.prices_supplier(s, d), TICKER.lower(), *YEAR)
    return rows.select(*BAR_COLUMNS)


@query
def trailing_window(s, d):
    return returns.trailing_window(b.prices_supplier(s, d), WINDOW_DAYS, b.last_ship_date(s, d))


@query
def eligible_tickers(s, d):
    recent = returns.trailing_window(b.prices_supplier(s, d), WINDOW_DAYS, b.last_ship_date(s, d))
    return returns.eligible_tickers(recent, DENSE)


@query
def eligible_prices(s, d):
    recent = returns.trailing_window(b.prices_supplier(s, d), WINDOW_DAYS, b.last_ship_date(s, d))
    return returns.eligible_prices(recent, DENSE)


@query
def scoped_prices(s, d):
    rows = b.prices_supplier(s, d).select("ticker", "date", "close")
    return universe.scoped_prices(rows, b.universe_supplier(s, d))


@query
def scoped_prices_fallback(s, d):
    nobody = b.universe_supplier(s, d).withColumn("active", F.lit(False))
    scoped = universe.scoped_prices(b.prices_supplier(s, d), nobody)
    return scoped.groupBy("ticker").agg(F.count(F.lit(1)).alias("rows"))


# -- returns and risk -----------------------------------------------------------

_on_supplier("daily_returns", returns.daily_returns)
_on_supplier("annualized_volatility", risk.annualized_volatility)
_on_supplier("historical_var", risk.historical_var)
_on_supplier("parametric_var", risk.parametric_var)
_on_supplier("conditional_var", risk.conditional_var)
_on_supplier("sharpe_ratio", risk.sharpe_ratio)
_on_supplier("sharpe_ratio_pop", risk.sharpe_ratio, ddof=0)
_on_supplier("max_drawdown", risk.max_drawdown)
_on_supplier("max_drawdown_from_returns", risk.max_drawdown_from_returns)
_on_supplier("drawdown_series", returns.drawdown_series)
_on_supplier("risk_metrics", risk.risk_metrics)
_on_supplier("risk_metrics_window", risk.risk_metrics_window, start=YEAR[0], end=YEAR[1])
_on_supplier("return_stats", risk.return_stats)
_on_supplier("rolling_vol_var", rolling.rolling_vol_var)


@query
def risk_metrics_incremental(s, d):
    """The states of all but the last three days, stored, then advanced by each of those days."""
    prices = b.prices_supplier(s, d).select("ticker", "date", "close")
    last = b.last_ship_date(s, d)

    def stored(state: DataFrame) -> DataFrame:
        path = scratch_path(s, "metric-state")
        state.write.parquet(path)
        return s.read.schema(metric_state.STATE).parquet(path)

    state = stored(metric_state.metric_state(prices.where(F.col("date") <= F.date_sub(last, 3))))
    for back in (2, 1, 0):
        day = prices.where(F.col("date") == F.date_sub(last, back))
        state = stored(metric_state.advance(state, day))
    return metric_state.metrics_from_state(metric_state.rebuild(state, prices))


@query
def risk_metrics_trailing(s, d):
    return risk.risk_metrics_trailing(b.prices_supplier(s, d), anchor=b.last_ship_date(s, d))


@query
def risk_metrics_grouped_map(s, d):
    return risk.risk_metrics_grouped_map(b.prices_supplier(s, d), anchor=b.last_ship_date(s, d))


@query
def rolling_metrics(s, d):
    rounded = {c: F.round(c, 6) for c in ("rolling_vol_21d", "rolling_mean_21d")}
    return _rolling(s, d).withColumns(rounded)


@query
def return_series(s, d):
    series = risk.return_series(b.prices_supplier(s, d))
    dates = F.transform("dates", lambda x: F.date_format(x, "yyyy-MM-dd"))
    values = F.transform("values", lambda x: F.format_string("%.6f", x))
    return series.select(
        "ticker",
        F.array_join(dates, ",").alias("dates"),
        F.array_join(values, ",").alias("values"),
    )


@query
def date_gaps(s, d):
    return returns.date_gaps(b.prices_brand(s, d))


@query
def price_zscore_outliers(s, d):
    scored = rolling.price_zscore_outliers(b.prices_brand(s, d))
    return scored.withColumn("z_score", F.round("z_score", 6))


# -- stored metrics -----------------------------------------------------------------


def _snapshot(rows: DataFrame) -> DataFrame:
    measures = [F.round(c, 6).alias(c) for c in METRIC_COLUMNS]
    return rows.select(*METRIC_KEY, *measures)


@query
def latest_metrics(s, d):
    return _snapshot(latest.latest_metrics(b.stored_metrics(s, d)))


@query
def latest_metrics_by_computed_at(s, d):
    return _snapshot(latest.latest_metrics_by_computed_at(b.stored_metrics(s, d)))


@query
def current_risk_metrics(s, d):
    return reports.current_risk_metrics(b.stored_metrics(s, d))


@query
def volatility_top25(s, d):
    return reports.volatility_top(b.stored_metrics(s, d), 25)


@query
def fattest_tails(s, d):
    return reports.fattest_tails(b.stored_metrics(s, d), 25)


@query
def metrics_summary(s, d):
    return reports.metrics_summary(b.stored_metrics(s, d)).drop("computation_duration_ms")


@query
def risk_return_scatter(s, d):
    return reports.risk_return_scatter(b.stored_metrics(s, d), b.universe_supplier(s, d))


@query
def upsert_metrics(s, d):
    year = F.year("window_end")
    stored = b.stored_metrics(s, d).where(year <= 2000)
    batch = b.stored_metrics(s, d, risk_free_rate=0.05).where(year >= 2000)
    merged = mutate.upsert(
        stored, batch, METRIC_KEY, ["computed_at"], set_cols=[*METRIC_COLUMNS, "computed_at"]
    )
    return _snapshot(merged)


# -- rolling reports ----------------------------------------------------------------


def _rolling(s, d) -> DataFrame:
    return rolling.rolling_metrics(b.prices_supplier(s, d))


@query
def sector_rolling_vol(s, d):
    return reports.sector_rolling_vol(
        _rolling(s, d), b.universe_supplier(s, d), b.last_ship_date(s, d)
    )


@query
def rolling_single_ticker(s, d):
    return reports.rolling_single_ticker(_rolling(s, d), TICKER, b.last_ship_date(s, d))


@query
def return_distribution(s, d):
    return reports.return_distribution(_rolling(s, d), TICKER, b.last_ship_date(s, d))


# -- quality ----------------------------------------------------------------------------


def _scope(s, d) -> DataFrame:
    return universe.scoped_prices(b.prices_brand(s, d), b.universe_brand(s, d))


def _scores(s, d) -> DataFrame:
    return quality.quality_scores(_scope(s, d), b.last_ship_date(s, d), b.scoring_time(s, d))


def _scores_history(s, d, days: int) -> DataFrame:
    return quality.quality_history(_scope(s, d), b.last_ship_date(s, d), days)


@query
def quality_freshness(s, d):
    return quality.quality_freshness(_scope(s, d), b.last_ship_date(s, d), b.scoring_time(s, d))


@query
def quality_completeness(s, d):
    return quality.quality_completeness(_scope(s, d), b.last_ship_date(s, d))


@query
def quality_outliers(s, d):
    return quality.quality_outliers(_scope(s, d), b.last_ship_date(s, d))


@query
def quality_gaps(s, d):
    return quality.quality_gaps(_scope(s, d), b.last_ship_date(s, d))


@query
def quality_scores_all(s, d):
    return _scores(s, d).select("check_date", "ticker", "check_name", "score")


@query
def quality_details(s, d):
    return _scores(s, d)


@query
def quality_summary(s, d):
    return quality.quality_summary(_scores(s, d), b.last_ship_date(s, d))


@query
def quality_count(s, d):
    return quality.quality_count(_scores(s, d), b.last_ship_date(s, d))


@query
def quality_heatmap_worst(s, d):
    prices = universe.scoped_prices(b.prices_supplier(s, d), b.universe_supplier(s, d))
    scores = quality.quality_scores(prices, b.last_ship_date(s, d), b.scoring_time(s, d))
    worst = quality.quality_heatmap_worst(scores, b.last_ship_date(s, d), worst=40)
    return worst.select("ticker", "check_name", "score", "details")


@query
def quality_trend(s, d):
    return quality.quality_trend(_scores_history(s, d, 30), b.last_ship_date(s, d))


@query
def tickers_needing_attention(s, d):
    failing = quality.tickers_needing_attention(_scores(s, d), b.last_ship_date(s, d), 100)
    return failing.select("ticker", "check_name", "score", "details", "checked_at")


@query
def upsert_scores(s, d):
    stored = _scores_history(s, d, 2)
    today = stored.where(F.col("check_date") == b.last_ship_date(s, d))
    again = today.withColumn("score", F.col("score") / 2)
    merged = mutate.upsert(stored, again, SCORE_KEY, ["checked_at"])
    return merged.select(*SCORE_KEY, "score")


# -- mutations and changes -----------------------------------------------------------------


@query
def insert_ignore(s, d):
    return mutate.insert_ignore(b.version_1(s, d), b.late_batch(s, d), BAR_KEY, ["volume"])


@query
def insert_ignore_count(s, d):
    return mutate.insert_ignore_count(b.version_1(s, d), b.late_batch(s, d), BAR_KEY)


@query
def upsert_prices(s, d):
    return mutate.upsert(b.version_1(s, d), b.late_batch(s, d), BAR_KEY, ["volume"])


@query
def merge_universe(s, d):
    return mutate.merge_universe(b.universe_supplier(s, d), b.listed_now(s, d))


def _feed(s, d) -> DataFrame:
    one, two, three = b.version_1(s, d), b.version_2(s, d), b.version_3(s, d)
    first = changes.snapshot_diff(one, two, BAR_KEY, 2, datetime(2002, 1, 2))
    second = changes.snapshot_diff(two, three, BAR_KEY, 3, datetime(2002, 1, 3))
    return first.unionByName(second)


@query
def change_feed(s, d):
    feed = changes.snapshot_diff(
        b.version_1(s, d), b.version_2(s, d), BAR_KEY, 2, datetime(2002, 1, 2)
    )
    kind = F.col("_change_type").alias("change_type")
    return feed.select(kind, "ticker", "date", "close", "volume")


@query
def newest_changes(s, d):
    newest = changes.newest_changes(_feed(s, d), datetime(2002, 1, 1), 100)
    return newest.select(
        F.col("_change_type").alias("change_type"),
        F.col("_commit_version").alias("version"),
        "ticker",
        "date",
        "close",
        "volume",
    )


@query
def change_volume(s, d):
    return changes.change_volume(_feed(s, d)).select(
        F.col("_commit_version").alias("version"),
        F.col("_change_type").alias("change_type"),
        "changes",
    )


# -- audit --------------------------------------------------------------------------------------


@query
def reap_orphan_runs(s, d):
    reaped = audit.reap_orphan_runs(b.runs(s, d), "ingest")
    return reaped.select("run_id", "run_type", "status", "finished_at", "error_message")


@query
def complete_run(s, d):
    prices = b.prices_supplier(s, d)
    rows = prices.agg(F.count(F.lit(1))).scalar()
    started = audit.register_run(
        b.runs(s, d), "new", "metrics", datetime(2002, 1, 1), {"ticker_source": "universe"}
    )
    done = audit.complete_run(started, "new", datetime(2002, 1, 1, 0, 5), rows, prices)
    return done.select(
        "run_id",
        "status",
        "rows_processed",
        "rows_failed",
        F.array_join("tickers_processed", ",").alias("tickers"),
    )


@query
def run_parameters(s, d):
    return audit.run_parameters(b.runs(s, d))


@query
def run_readback(s, d):
    return audit.run_readback(b.prices_supplier(s, d), "s3", INGEST_START)


@query
def run_history(s, d):
    return audit.run_history(b.runs(s, d), b.last_run_date(s, d))


@query
def run_success_rate(s, d):
    return audit.run_success_rate(b.runs(s, d), b.last_run_date(s, d))


@query
def last_runs(s, d):
    return audit.last_runs(b.runs(s, d), b.last_run_date(s, d))


# -- coverage ---------------------------------------------------------------------------------------

_on_supplier("ingest_summary", reports.ingest_summary)
_on_supplier("source_distribution", reports.source_distribution)
_on_supplier("list_tickers", universe.list_tickers)
_on_supplier("list_tickers_page", universe.list_tickers_page, limit=10, offset=5)
_on_supplier("price_page", universe.price_page, ticker=TICKER, limit=100, offset=50)


@query
def stale_tickers(s, d):
    return reports.stale_tickers(b.prices_supplier(s, d), b.last_ship_date(s, d))


def _tracked(s, d) -> DataFrame:
    return b.universe_supplier(s, d).unionByName(b.unlisted_symbols(s, d))


@query
def coverage_summary(s, d):
    return reports.coverage_summary(b.prices_supplier(s, d), _tracked(s, d), b.last_ship_date(s, d))


@query
def coverage_gaps(s, d):
    return reports.coverage_gaps(
        b.prices_supplier(s, d), _tracked(s, d), b.scoring_time(s, d), b.last_ship_date(s, d)
    )


@query
def ingestion_volume(s, d):
    return reports.ingestion_volume(b.prices_supplier(s, d), b.last_ship_date(s, d))


@query
def universe_by_sector(s, d):
    return universe.universe_by_sector(b.universe_supplier(s, d))


# -- portfolios -----------------------------------------------------------------------------------------


@query
def portfolio_normalize(s, d):
    made = portfolio.create_portfolios(b.order_portfolios(s, d), b.order_requests(s, d))
    return made.withColumn("weight", F.round("weight", 6))


@query
def portfolio_conflicts(s, d):
    return portfolio.portfolio_conflicts(b.order_portfolios(s, d), b.order_requests(s, d))


@query
def portfolio_replace(s, d):
    held = portfolio.normalize_weights(b.supplier_books(s, d))
    new = b.returned_books(s, d).where(F.col("portfolio") == BOOK)
    return portfolio.replace_holdings(held, new).withColumn("weight", F.round("weight", 6))


@query
def portfolio_delete(s, d):
    held = portfolio.normalize_weights(b.supplier_books(s, d))
    names = held.select("portfolio").distinct()
    doomed = names.where(F.col("portfolio") == BOOK)
    _, left = portfolio.delete_portfolios(names, held, doomed)
    return left.withColumn("weight", F.round("weight", 6))


@query
def portfolio_list(s, d):
    held = b.supplier_books(s, d)
    page = portfolio.portfolio_list(held.select("portfolio").distinct(), held, limit=10, offset=5)
    legs = F.transform(
        "holdings", lambda x: F.concat(x["ticker"], F.lit(":"), x["weight"].cast("bigint").cast("string"))
    )
    return page.select("portfolio", F.array_join(legs, ",").alias("holdings"))


def _stored_books(s, d) -> PortfolioStore:
    """Books created from shipments, one replaced by what was returned, one deleted."""
    books = PortfolioStore(s, scratch_path(s, "portfolios"))
    books.create(b.supplier_books(s, d), datetime(2024, 1, 1))
    books.replace(b.returned_books(s, d).where(F.col("portfolio") == BOOK), datetime(2024, 1, 2))
    books.delete(books.holdings().where(F.col("portfolio") == CLOSED_BOOK))
    return books


def _minutes(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm").alias(column)


@query
def portfolio_stored(s, d):
    books = _stored_books(s, d)
    named = books.portfolios().select(F.col("name").alias("portfolio"), "created_at", "updated_at")
    return books.holdings().join(named, "portfolio").select(
        "portfolio", _minutes("created_at"), _minutes("updated_at"), "ticker", F.round("weight", 6).alias("weight")
    )


@query
def portfolio_stored_page(s, d):
    page = _stored_books(s, d).page(limit=10, offset=1)
    tickers = F.array_join(F.transform("holdings", lambda x: x["ticker"]), ",")
    return page.select("name", _minutes("created_at"), _minutes("updated_at"), tickers.alias("tickers"))


@query
def portfolio_aligned_returns(s, d):
    aligned = portfolio.aligned_returns(b.prices_type(s, d), b.supplier_books(s, d))
    return aligned.withColumn("portfolio_return", F.round("portfolio_return", 6))


@query
def portfolio_cumulative(s, d):
    grown = portfolio.portfolio_growth(b.prices_type(s, d), b.supplier_books(s, d))
    return grown.withColumn("cumulative", F.round("cumulative", 6))


@query
def portfolio_risk(s, d):
    return portfolio.portfolio_risk(b.prices_type(s, d), b.supplier_books(s, d))


@query
def portfolio_risk_positional(s, d):
    return portfolio.portfolio_risk(b.prices_type(s, d), b.supplier_books(s, d), align="position")


# -- distinct counts from daily bitmaps --------------------------------------------


def _daily_tickers(s, d) -> DataFrame:
    """Daily rows of two batches of bars, stored; the second batch extends the numbers."""
    prices, last = b.prices_supplier(s, d), b.last_ship_date(s, d)
    early = F.col("ingested_at") < F.date_sub(last, 15).cast("timestamp")
    numbers, daily = distinct_counts.no_numbers(prices), scratch_path(s, "daily-tickers")
    for batch in (prices.where(early), prices.where(~early)):
        path = scratch_path(s, "ticker-numbers")
        distinct_counts.numbered(numbers, batch).write.parquet(path)
        numbers = s.read.schema(distinct_counts.NUMBERS).parquet(path)
        distinct_counts.daily_tickers(batch, numbers).write.mode("append").parquet(daily)
    return s.read.schema(distinct_counts.DAILY).parquet(daily)


@query
def source_distribution_daily(s, d):
    return reports.source_distribution_daily(_daily_tickers(s, d))


@query
def ingestion_volume_daily(s, d):
    return reports.ingestion_volume_daily(_daily_tickers(s, d), b.last_ship_date(s, d))
