"""One DuckDB statement per query key."""

from __future__ import annotations

from oracles.ctes import (
    BARS,
    CTES,
    LAST_DATE,
    METRICS,
    SCORING_TIME,
    metrics_of,
    portfolio_risk_of,
    r,
    scores_of,
    YEARS,
    stored_year,
    supplier,
    with_ctes,
    z_of,
)

TICKER = "S000003"
BOOK = "P000003"
CLOSED_BOOK = "P000002"
UPDATED = f"CASE portfolio WHEN '{BOOK}' THEN '2024-01-02 00:00' ELSE '2024-01-01 00:00' END"
LEFT_BOOKS = f"""(SELECT * FROM books WHERE portfolio NOT IN ('{BOOK}', '{CLOSED_BOOK}') UNION ALL
                  SELECT * FROM returned WHERE portfolio = '{BOOK}')"""
KEYS = "ticker, window_start, window_end"
ROUNDED = ", ".join(f"{r(m)} AS {m}" for m in METRICS)
RETURNS_FRAME = "SELECT ticker, close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS r FROM prices_s"


def metric_set(source: str, **options) -> str:
    return f"SELECT {KEYS}, {ROUNDED} FROM ({metrics_of(source, **options)})"


def gaps_within(days: int) -> str:
    return f"""
        SELECT ticker, gap FROM (
            SELECT ticker, date - lag(date) OVER (PARTITION BY ticker ORDER BY date) AS gap
            FROM scope WHERE date >= {LAST_DATE} - {days}) WHERE gap IS NOT NULL"""


def back(days: int) -> str:
    as_of = f"({LAST_DATE} - {days})"
    known = f"(SELECT * FROM scope WHERE date <= {as_of})"
    return scores_of(known, as_of, f"(CAST({as_of} AS TIMESTAMP) + INTERVAL 38 HOUR)")


bars = with_ctes(f"SELECT {BARS} FROM prices_s", "prices_s")
brand_bars = with_ctes(f"SELECT {BARS} FROM prices_b", "prices_b")
trailing = with_ctes(
    metric_set("recent", std="stddev_pop", drawdown="returns", min_points=30), "recent"
)


def settled(direction: str) -> str:
    """One row per key of the batch."""
    order = ", ".join(f"{c} {direction}" for c in ("volume", "open", "high", "low", "close"))
    return f"""
        SELECT {BARS} FROM batch
        QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY {order}) = 1"""


DETAILS = {
    "freshness": f"""
        SELECT s.check_date, s.ticker, s.check_name, s.score, h.hours_since_ingest,
               h.last_ingested, h.latest_date
        FROM scores s JOIN (
            SELECT ticker, date_sub('hour', max(ingested_at), {SCORING_TIME}) AS hours_since_ingest,
                   max(ingested_at) AS last_ingested, max(date) AS latest_date
            FROM scope GROUP BY ticker) h ON h.ticker = s.ticker
        WHERE check_name = 'freshness'""",
    "completeness": f"""
        SELECT s.check_date, s.ticker, s.check_name, s.score, total_days, gaps_detected,
               max_gap_days, {r('total_days / (150.0 / 7)', 3)} AS coverage_ratio
        FROM scores s JOIN (
            SELECT ticker, count(*) AS total_days, count(*) FILTER (gap > 3) AS gaps_detected,
                   CAST(max(gap) AS INTEGER) AS max_gap_days
            FROM ({gaps_within(30)}) GROUP BY ticker) d ON d.ticker = s.ticker
        WHERE check_name = 'completeness'""",
    "outliers": f"""
        SELECT s.check_date, s.ticker, s.check_name, s.score, outlier_count, total_points,
               {r('outlier_count / total_points', 4)} AS outlier_rate,
               {r('top', 2)} AS max_z_score
        FROM scores s JOIN (
            SELECT ticker, count(*) FILTER (z > 3) AS outlier_count, count(*) AS total_points,
                   max(z) AS top
            FROM ({z_of('scope', LAST_DATE)}) GROUP BY ticker) d ON d.ticker = s.ticker
        WHERE check_name = 'outliers'""",
    "gaps": f"""
        SELECT s.check_date, s.ticker, s.check_name, s.score, large_gaps, total_transitions,
               widest_gap_days
        FROM scores s JOIN (
            SELECT ticker, count(*) FILTER (gap > 5) AS large_gaps, count(*) AS total_transitions,
                   CAST(max(gap) AS INTEGER) AS widest_gap_days
            FROM ({gaps_within(180)}) GROUP BY ticker) d ON d.ticker = s.ticker
        WHERE check_name = 'gaps'""",
}


STATEMENTS: dict[str, str] = {
    # scans
    "scan_csv": bars,
    "scan_csv_inferred": bars,
    "stream_incremental_ingest": bars,
    "union_by_name": bars,
    "tidy_wide_bars": brand_bars,
    "tidy_no_data": with_ctes("SELECT DISTINCT ticker FROM unlisted", "unlisted"),
    "parse_ticker_list": """
        SELECT s_suppkey AS list_id, upper(name) AS ticker FROM (
            SELECT s_suppkey, unnest([s_name, n_name, r_name]) AS name
            FROM supplier JOIN nation ON s_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey)""",
    "active_universe": with_ctes("SELECT ticker FROM universe_s WHERE active", "universe_s"),
    "tickers_by_prefix": with_ctes(
        "SELECT DISTINCT ticker FROM prices_s WHERE ticker LIKE 'S00000%'", "prices_s"
    ),
    # validation
    "normalize_validate": with_ctes(
        f"SELECT {BARS}, TIMESTAMP '2002-01-01' AS ingested_at, 's3' AS source FROM checked WHERE ok_full",
        "checked",
    ),
    "validate_service_profile": with_ctes(f"SELECT {BARS} FROM checked WHERE ok_service", "checked"),
    "validation_counts": with_ctes(
        " UNION ALL ".join(
            f"""SELECT '{p}' AS profile, count(*) AS total_raw,
                       count(*) FILTER (ok_{p}) AS total_valid,
                       count(*) FILTER (NOT ok_{p}) AS failures FROM checked"""
            for p in ("full", "service")
        ),
        "checked",
    ),
    "validate_ticker_filter": with_ctes(
        f"""SELECT count(*) AS total_raw, count(*) FILTER (NOT ok_service) AS failures,
                   count(*) FILTER (ok_service AND ticker = '{TICKER}') AS kept_rows FROM checked""",
        "checked",
    ),
    "constraint_violations": with_ctes(
        """
        SELECT 'valid_price_range' AS constraint_name,
               count(*) FILTER (NOT coalesce(high >= low AND low > 0, false)) AS violations FROM raw
        UNION ALL
        SELECT 'valid_volume', count(*) FILTER (NOT coalesce(volume >= 0, false)) FROM raw
        UNION ALL
        SELECT 'valid_weight',
               count(*) FILTER (NOT coalesce(weight / 40.0 > 0 AND weight / 40.0 <= 1, false))
        FROM requests WHERE ticker IS NOT NULL""",
        "raw",
        "requests",
    ),
    "price_range": with_ctes(
        f"""SELECT {BARS} FROM prices_s WHERE ticker = '{TICKER}'
            AND date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'""",
        "prices_s",
    ),
    "trailing_window": with_ctes("SELECT * FROM recent", "recent"),
    "eligible_tickers": with_ctes("SELECT * FROM dense", "dense"),
    "eligible_prices": with_ctes(
        "SELECT recent.* FROM recent SEMI JOIN dense ON dense.ticker = recent.ticker", "dense"
    ),
    "scoped_prices": with_ctes(
        """SELECT p.ticker, date, close FROM prices_s p
           SEMI JOIN (SELECT ticker FROM universe_s WHERE active) u ON u.ticker = p.ticker""",
        "prices_s",
        "universe_s",
    ),
    "scoped_prices_fallback": with_ctes(
        "SELECT ticker, count(*) AS rows FROM prices_s GROUP BY ticker", "prices_s"
    ),
    # returns and risk
    "daily_returns": with_ctes("SELECT * FROM returns_s", "returns_s"),
    "annualized_volatility": with_ctes(
        f"""SELECT ticker, {r('stddev_samp(r) * sqrt(252)')} AS annualized_volatility
            FROM ({RETURNS_FRAME}) GROUP BY ticker HAVING count(r) > 1""",
        "prices_s",
    ),
    "historical_var": with_ctes(
        f"""SELECT ticker, {r('0.0 - quantile_cont(r, 0.05)')} AS var_95,
                   {r('0.0 - quantile_cont(r, 0.01)')} AS var_99
            FROM ({RETURNS_FRAME}) GROUP BY ticker""",
        "prices_s",
    ),
    "parametric_var": with_ctes(
        f"""SELECT ticker,
                   {r("0.0 - (avg(r) + CAST('-1.6448536269514726' AS DOUBLE) * stddev_samp(r))")} AS parametric_var_95,
                   {r("0.0 - (avg(r) + CAST('-2.3263478740408408' AS DOUBLE) * stddev_samp(r))")} AS parametric_var_99
            FROM ({RETURNS_FRAME}) GROUP BY ticker""",
        "prices_s",
    ),
    **{
        key: with_ctes(f"SELECT ticker, {columns} FROM ({metrics_of('prices_s', **options)})", "prices_s")
        for key, columns, options in (
            ("conditional_var", f"{r('cvar_95')} AS cvar_95, {r('cvar_99')} AS cvar_99", {}),
            ("sharpe_ratio", f"{r('sharpe_ratio')} AS sharpe_ratio", {}),
            ("sharpe_ratio_pop", f"{r('sharpe_ratio')} AS sharpe_ratio", {"std": "stddev_pop"}),
            ("max_drawdown", f"{r('max_drawdown')} AS max_drawdown", {}),
            (
                "max_drawdown_from_returns",
                f"{r('max_drawdown')} AS max_drawdown",
                {"drawdown": "returns"},
            ),
        )
    },
    "drawdown_series": with_ctes(
        """SELECT ticker, date, close, running_max, (running_max - close) / running_max AS drawdown
           FROM (SELECT ticker, date, close,
                        max(close) OVER (PARTITION BY ticker ORDER BY date) AS running_max
                 FROM prices_s)""",
        "prices_s",
    ),
    "risk_metrics": with_ctes(metric_set("prices_s"), "prices_s"),
    "risk_metrics_incremental": with_ctes(metric_set("prices_s"), "prices_s"),
    "risk_metrics_trailing": trailing,
    "risk_metrics_grouped_map": trailing,
    "risk_metrics_window": with_ctes(
        metric_set("(SELECT * FROM prices_s WHERE year(date) = 2000)"), "prices_s"
    ),
    "return_stats": with_ctes(
        f"""SELECT ticker, count(r) AS count, {r('avg(r)')} AS mean, {r('stddev_samp(r)')} AS std,
                   {r('min(r)')} AS min, {r('max(r)')} AS max
            FROM ({RETURNS_FRAME}) GROUP BY ticker HAVING count(*) >= 3""",
        "prices_s",
    ),
    "return_series": with_ctes(
        f"""SELECT ticker, string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date) AS dates,
                   string_agg(printf('%.6f', {r('daily_return')}), ',' ORDER BY date) AS values
            FROM returns_s GROUP BY ticker HAVING count(*) >= 2""",
        "returns_s",
    ),
    "rolling_metrics": with_ctes(
        f"""SELECT ticker, date, close, daily_return, {r('rolling_vol_21d')} AS rolling_vol_21d,
                   {r('rolling_mean_21d')} AS rolling_mean_21d FROM rolling""",
        "rolling",
    ),
    "rolling_vol_var": with_ctes(
        f"""
        SELECT ticker, date,
               CASE WHEN n >= 21 THEN {r('sd * sqrt(252)')} END AS annualized_volatility,
               CASE WHEN n >= 21 THEN {r('0.0 - q')} END AS var_95
        FROM (SELECT ticker, date, stddev_samp(daily_return) OVER w AS sd,
                     quantile_cont(daily_return, 0.05) OVER w AS q,
                     row_number() OVER (PARTITION BY ticker ORDER BY date) AS n,
                     count(*) OVER (PARTITION BY ticker) AS total
              FROM returns_s
              WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW))
        WHERE total >= 21""",
        "returns_s",
    ),
    "date_gaps": with_ctes(
        """SELECT ticker, date, prev_date, CAST(date - prev_date AS INTEGER) AS gap_days
           FROM (SELECT ticker, date, lag(date) OVER (PARTITION BY ticker ORDER BY date) AS prev_date
                 FROM prices_b) WHERE prev_date IS NOT NULL""",
        "prices_b",
    ),
    "price_zscore_outliers": with_ctes(
        f"""
        SELECT ticker, date, close, {r('abs((close - m) / sd)')} AS z_score,
               abs((close - m) / sd) > 3 AS is_outlier
        FROM (SELECT ticker, date, close, avg(close) OVER w AS m, stddev_samp(close) OVER w AS sd
              FROM prices_b
              WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
        WHERE sd > 0""",
        "prices_b",
    ),
    # stored metrics
    "latest_metrics": with_ctes(f"SELECT {KEYS}, {ROUNDED} FROM latest", "latest"),
    "latest_metrics_by_computed_at": with_ctes(
        f"""SELECT {KEYS}, {ROUNDED} FROM stored QUALIFY row_number() OVER (
            PARTITION BY ticker ORDER BY computed_at DESC, window_end DESC) = 1""",
        "stored",
    ),
    "current_risk_metrics": with_ctes(
        f"""SELECT {KEYS}, {r('annualized_volatility * 100.0', 2)} AS volatility_pct,
                   {r('var_95 * 100.0', 2)} AS var_95_pct, {r('cvar_95 * 100.0', 2)} AS cvar_95_pct,
                   {r('sharpe_ratio', 3)} AS sharpe_ratio,
                   {r('max_drawdown * 100.0', 2)} AS max_drawdown_pct, computed_at FROM latest""",
        "latest",
    ),
    "volatility_top25": with_ctes(
        f"""SELECT ticker, {r('annualized_volatility * 100.0', 2)} AS volatility_pct,
                   {r('var_95 * 100.0', 2)} AS var_95_pct,
                   {r('max_drawdown * 100.0', 2)} AS max_drawdown_pct
            FROM (SELECT * FROM latest ORDER BY annualized_volatility DESC, ticker LIMIT 25)""",
        "latest",
    ),
    "fattest_tails": with_ctes(
        "SELECT ticker, "
        + ", ".join(f"{r(f'{c} * 100.0', 3)} AS {c}_pct" for c in ("var_95", "cvar_95", "var_99", "cvar_99"))
        + f""", {r('(cvar_99 - var_99) * 100.0', 3)} AS tail_gap_pct
            FROM latest ORDER BY tail_gap_pct DESC, ticker LIMIT 25""",
        "latest",
    ),
    "metrics_summary": with_ctes(
        f"""SELECT {KEYS}, {r('annualized_volatility', 4)} AS volatility, {r('var_95', 4)} AS var_95,
                   {r('cvar_95', 4)} AS cvar_95, {r('sharpe_ratio', 4)} AS sharpe,
                   {r('max_drawdown', 4)} AS max_drawdown FROM latest""",
        "latest",
    ),
    "risk_return_scatter": with_ctes(
        f"""SELECT l.ticker, sector, {r('annualized_volatility', 4)} AS volatility,
                   {r('sharpe_ratio', 4)} AS sharpe_ratio, {r('var_95', 4)} AS var_95
            FROM latest l LEFT JOIN universe_s u ON u.ticker = l.ticker""",
        "latest",
        "universe_s",
    ),
    "upsert_metrics": with_ctes(
        f"""
        SELECT {KEYS}, {ROUNDED} FROM (
            {" UNION ALL ".join(stored_year(y, 0.05 if y >= 2000 else 0.02) for y in YEARS)})""",
        "prices_s",
    ),
    # rolling reports
    "sector_rolling_vol": with_ctes(
        f"""SELECT sector, date, {r('median(rolling_vol_21d) * 100.0', 2)} AS rolling_vol_pct,
                   count(*) AS tickers
            FROM rolling JOIN universe_s ON universe_s.ticker = rolling.ticker
            WHERE date >= {LAST_DATE} - 90 GROUP BY sector, date""",
        "rolling",
        "universe_s",
    ),
    "rolling_single_ticker": with_ctes(
        f"""SELECT ticker, date, {r('rolling_vol_21d * 100.0', 2)} AS rolling_vol_pct,
                   {r('daily_return * 100.0', 3)} AS daily_return_pct
            FROM rolling WHERE ticker = '{TICKER}' AND date >= {LAST_DATE} - 365""",
        "rolling",
    ),
    "return_distribution": with_ctes(
        f"""SELECT ticker, date, {r('daily_return * 100.0', 3)} AS return_pct
            FROM rolling WHERE ticker = '{TICKER}' AND date >= {LAST_DATE} - 365""",
        "rolling",
    ),
    # quality
    **{f"quality_{check}": with_ctes(DETAILS[check], "scores") for check in DETAILS},
    # the JSON text of each check's detail columns, in their order
    "quality_details": with_ctes(
        f"""
        SELECT check_date, ticker, check_name, score, details, {SCORING_TIME} AS checked_at FROM (
            SELECT *, format('{{{{"hours_since_ingest":{{}},"last_ingested":"{{}}","latest_date":"{{}}"}}}}',
                             hours_since_ingest, strftime(last_ingested, '%Y-%m-%dT%H:%M:%S.000Z'),
                             latest_date) AS details
            FROM ({DETAILS["freshness"]})
            UNION ALL BY NAME
            SELECT *, format('{{{{"total_days":{{}},"gaps_detected":{{}},"max_gap_days":{{}},"coverage_ratio":{{}}}}}}',
                             total_days, gaps_detected, max_gap_days,
                             CAST(coverage_ratio AS VARCHAR)) AS details
            FROM ({DETAILS["completeness"]})
            UNION ALL BY NAME
            SELECT *, format('{{{{"outlier_count":{{}},"total_points":{{}},"outlier_rate":{{}},"max_z_score":{{}}}}}}',
                             outlier_count, total_points, CAST(outlier_rate AS VARCHAR),
                             CAST(max_z_score AS VARCHAR)) AS details
            FROM ({DETAILS["outliers"]})
            UNION ALL BY NAME
            SELECT *, format('{{{{"large_gaps":{{}},"total_transitions":{{}},"widest_gap_days":{{}}}}}}',
                             large_gaps, total_transitions, widest_gap_days) AS details
            FROM ({DETAILS["gaps"]}))""",
        "scores",
    ),
    "quality_scores_all": with_ctes("SELECT * FROM scores", "scores"),
    "quality_summary": with_ctes(
        f"""SELECT ticker, {r('avg(score)', 3)} AS overall_health_score,
                   min(score) AS worst_check_score,
                   coalesce(string_agg(check_name, ', ' ORDER BY check_name)
                            FILTER (score < 0.7), '') AS failing_checks
            FROM scores GROUP BY ticker""",
        "scores",
    ),
    "quality_count": with_ctes(
        "SELECT check_date, count(*) AS scores FROM scores GROUP BY check_date", "scores"
    ),
    "quality_trend": with_ctes(
        f"""SELECT check_date, check_name, {r('avg(score)', 3)} AS avg_score,
                   min(score) AS min_score,
                   count(*) FILTER (score < 0.7) AS tickers_below_threshold
            FROM ({' UNION ALL BY NAME '.join(f'SELECT * FROM ({back(n)})' for n in range(30))})
            GROUP BY check_date, check_name""",
        "scope",
    ),
    "upsert_scores": with_ctes(
        f"""SELECT ticker, check_date, check_name, score FROM ({back(1)})
            UNION ALL SELECT ticker, check_date, check_name, score / 2 FROM ({back(0)})""",
        "scope",
    ),
    # mutations and changes
    "insert_ignore": with_ctes(
        f"""SELECT {BARS} FROM v1 UNION ALL
            SELECT * FROM ({settled('ASC')}) n ANTI JOIN v1 ON v1.ticker = n.ticker AND v1.date = n.date""",
        "v1",
        "batch",
    ),
    "insert_ignore_count": with_ctes(
        """SELECT count(*) AS inserted FROM (SELECT DISTINCT ticker, date FROM batch) n
           ANTI JOIN v1 ON v1.ticker = n.ticker AND v1.date = n.date""",
        "v1",
        "batch",
    ),
    "upsert_prices": with_ctes(
        f"""SELECT {BARS} FROM v1 ANTI JOIN batch ON v1.ticker = batch.ticker AND v1.date = batch.date
            UNION ALL SELECT * FROM ({settled('DESC')})""",
        "v1",
        "batch",
    ),
    "merge_universe": with_ctes(
        """SELECT ticker, company_name, CASE WHEN active THEN lower(sector) ELSE sector END AS sector,
                  active, added_at FROM universe_s
           UNION ALL
           SELECT ticker, company_name, sector, true, TIMESTAMP '2025-01-01' FROM unlisted""",
        "universe_s",
        "unlisted",
    ),
    "change_feed": with_ctes(
        "SELECT change_type, ticker, date, close, volume FROM feed WHERE version = 2", "feed"
    ),
    "newest_changes": with_ctes(
        """SELECT change_type, CAST(version AS BIGINT) AS version, ticker, date, close, volume
           FROM feed ORDER BY version DESC, ticker, date, change_type LIMIT 100""",
        "feed",
    ),
    "change_volume": with_ctes(
        """SELECT CAST(version AS BIGINT) AS version, change_type, count(*) AS changes
           FROM feed GROUP BY 1, 2""",
        "feed",
    ),
    # audit
    "reap_orphan_runs": with_ctes(
        """
        SELECT run_id, run_type,
               CASE WHEN run_type = 'ingest' AND status = 'running' THEN 'failed' ELSE status END AS status,
               finished_at,
               CASE WHEN run_type = 'ingest' AND status = 'running'
                    THEN 'Run never reported completion; marked failed by a subsequent run. '
                      || 'Finish time unknown, so finished_at is left NULL.'
                    ELSE error_message END AS error_message
        FROM runs""",
        "runs",
    ),
    "complete_run": with_ctes(
        """
        SELECT run_id, status, rows_processed, rows_failed, array_to_string(tickers, ',') AS tickers
        FROM runs
        UNION ALL
        SELECT 'new', 'succeeded', count(*), 0, string_agg(DISTINCT ticker, ',' ORDER BY ticker)
        FROM prices_s""",
        "runs",
        "prices_s",
    ),
    "run_parameters": with_ctes(
        "SELECT run_type, ticker_source, count(*) AS runs FROM runs GROUP BY 1, 2", "runs"
    ),
    "run_readback": with_ctes(
        """SELECT DISTINCT ticker FROM prices_s
           WHERE source = 's3' AND ingested_at >= TIMESTAMP '2001-06-01'""",
        "prices_s",
    ),
    "run_history": with_ctes(
        """SELECT run_id, CAST(started_at AS DATE) AS run_date, run_type, status, rows_processed,
                  rows_failed, date_sub('second', started_at, finished_at) AS duration_seconds
           FROM runs WHERE started_at >= as_of - 30""",
        "runs",
    ),
    "run_success_rate": with_ctes(
        f"""SELECT {r("count(*) FILTER (status = 'succeeded') * 100.0 / count(*)", 1)} AS success_rate_pct,
                   count(*) AS total_runs, count(*) FILTER (status = 'failed') AS failed_runs
            FROM runs WHERE started_at >= as_of - 7""",
        "runs",
    ),
    "last_runs": with_ctes(
        """SELECT run_id, run_type, status, started_at, finished_at, rows_processed, rows_failed,
                  date_sub('second', started_at, finished_at) AS duration_sec,
                  CAST(len(tickers) AS INTEGER) AS tickers_processed_count, error_message
           FROM runs WHERE started_at >= as_of - 1""",
        "runs",
    ),
    # coverage
    "ingest_summary": with_ctes(
        """SELECT count(*) AS total_rows, count(DISTINCT ticker) AS tickers,
                  min(date) AS earliest_date, max(date) AS latest_date,
                  max(ingested_at) AS last_ingested FROM prices_s""",
        "prices_s",
    ),
    "stale_tickers": with_ctes(
        """SELECT ticker, count(*) AS row_count, min(date) AS earliest_date, max(date) AS latest_date,
                  max(ingested_at) AS last_ingested
           FROM prices_s GROUP BY ticker
           HAVING max(date) < (SELECT max(date) - 4 FROM prices_s)""",
        "prices_s",
    ),
    "source_distribution": with_ctes(
        """SELECT source, count(*) AS record_count, count(DISTINCT ticker) AS ticker_count
           FROM prices_s GROUP BY source""",
        "prices_s",
    ),
    "source_distribution_daily": with_ctes(
        """SELECT source, count(*) AS record_count, count(DISTINCT ticker) AS ticker_count
           FROM prices_s GROUP BY source""",
        "prices_s",
    ),
    "ingestion_volume": with_ctes(
        f"""SELECT CAST(ingested_at AS DATE) AS ingest_date, count(*) AS records_ingested,
                   count(DISTINCT ticker) AS tickers_touched
            FROM prices_s WHERE ingested_at >= {LAST_DATE} - 30 GROUP BY 1""",
        "prices_s",
    ),
    "ingestion_volume_daily": with_ctes(
        f"""SELECT CAST(ingested_at AS DATE) AS ingest_date, count(*) AS records_ingested,
                   count(DISTINCT ticker) AS tickers_touched
            FROM prices_s WHERE ingested_at >= {LAST_DATE} - 30 GROUP BY 1""",
        "prices_s",
    ),
    "coverage_summary": with_ctes(
        f"""
        SELECT (SELECT count(*) FROM tracked WHERE active) AS universe_size,
               count(DISTINCT ticker) AS tickers_with_data,
               count(DISTINCT ticker) FILTER (last < {LAST_DATE} - 4) AS tickers_stale,
               min(first) AS history_starts, CAST(sum(n) AS BIGINT) AS total_rows
        FROM (SELECT ticker, count(*) AS n, min(date) AS first, max(date) AS last
              FROM prices_s GROUP BY ticker)""",
        "tracked",
        "prices_s",
    ),
    "coverage_gaps": with_ctes(
        f"""
        SELECT u.ticker, u.sector, coalesce(n, 0) AS total_records, first AS first_date,
               last AS last_date, CAST({LAST_DATE} - last AS INTEGER) AS days_behind,
               date_sub('hour', ingested, {SCORING_TIME}) AS hours_since_update
        FROM tracked u LEFT JOIN (
            SELECT ticker, count(*) AS n, min(date) AS first, max(date) AS last,
                   max(ingested_at) AS ingested
            FROM prices_s GROUP BY ticker) p ON p.ticker = u.ticker
        WHERE u.active AND (p.ticker IS NULL OR last < {LAST_DATE} - 4)""",
        "tracked",
        "prices_s",
    ),
    "universe_by_sector": with_ctes(
        """SELECT sector, count(*) AS tickers, count(*) FILTER (active) AS active_tickers
           FROM universe_s GROUP BY sector""",
        "universe_s",
    ),
    "list_tickers": with_ctes("SELECT DISTINCT ticker FROM prices_s", "prices_s"),
    "list_tickers_page": with_ctes(
        "SELECT DISTINCT ticker FROM prices_s ORDER BY ticker LIMIT 10 OFFSET 5", "prices_s"
    ),
    "price_page": with_ctes(
        f"""SELECT ticker, count(*) OVER () AS total, date, open, high, low, close, volume
            FROM prices_s WHERE ticker = '{TICKER}' ORDER BY date LIMIT 100 OFFSET 50""",
        "prices_s",
    ),
    # portfolios
    "portfolio_conflicts": with_ctes("SELECT * FROM conflicts", "conflicts"),
    "portfolio_normalize": with_ctes(
        f"""SELECT portfolio, ticker, {r('weight / sum(weight) OVER (PARTITION BY portfolio)')} AS weight
            FROM requests q ANTI JOIN conflicts c ON c.portfolio = q.portfolio""",
        "requests",
        "conflicts",
    ),
    "portfolio_replace": with_ctes(
        f"""SELECT portfolio, ticker, {r('weight / sum(weight) OVER (PARTITION BY portfolio)')} AS weight
            FROM (SELECT * FROM books WHERE portfolio <> '{BOOK}' UNION ALL
                  SELECT * FROM returned WHERE portfolio = '{BOOK}')""",
        "books",
        "returned",
    ),
    "portfolio_delete": with_ctes(
        f"""SELECT portfolio, ticker, {r('weight / sum(weight) OVER (PARTITION BY portfolio)')} AS weight
            FROM books WHERE portfolio <> '{BOOK}'""",
        "books",
    ),
    "portfolio_list": with_ctes(
        """SELECT portfolio, string_agg(ticker || ':' || CAST(CAST(weight AS BIGINT) AS VARCHAR), ','
                                       ORDER BY ticker) AS holdings
           FROM books GROUP BY portfolio ORDER BY portfolio LIMIT 10 OFFSET 5""",
        "books",
    ),
    "portfolio_stored": with_ctes(
        f"""SELECT portfolio, '2024-01-01 00:00' AS created_at, {UPDATED} AS updated_at, ticker,
                   {r('weight / sum(weight) OVER (PARTITION BY portfolio)')} AS weight
            FROM {LEFT_BOOKS}""",
        "books",
        "returned",
    ),
    "portfolio_stored_page": with_ctes(
        f"""SELECT portfolio AS name, '2024-01-01 00:00' AS created_at, {UPDATED} AS updated_at,
                   string_agg(ticker, ',' ORDER BY ticker) AS tickers
            FROM {LEFT_BOOKS} GROUP BY portfolio ORDER BY portfolio LIMIT 10 OFFSET 1""",
        "books",
        "returned",
    ),
    "portfolio_aligned_returns": with_ctes(
        f"SELECT portfolio, slot AS date, {r('pr')} AS portfolio_return FROM days_by_date",
        "days_by_date",
    ),
    "portfolio_cumulative": with_ctes(
        f"""SELECT portfolio, slot AS date,
                   {r('product(1.0 + pr) OVER (PARTITION BY portfolio ORDER BY slot)')} AS cumulative
            FROM days_by_date""",
        "days_by_date",
    ),
    "portfolio_risk": with_ctes(
        f"SELECT * FROM ({portfolio_risk_of('held_by_date', 'days_by_date')})",
        "held_by_date",
        "days_by_date",
    ),
    "portfolio_risk_positional": with_ctes(
        f"SELECT * FROM ({portfolio_risk_of('held_by_position', 'days_by_position')})",
        "held_by_position",
        "days_by_position",
    ),
}

# reports on scores with their details
ON_SUPPLIERS = with_ctes("SELECT * FROM prices_s SEMI JOIN (SELECT ticker FROM universe_s WHERE active) a"
                         " ON a.ticker = prices_s.ticker", "prices_s", "universe_s")
STATEMENTS["quality_heatmap_worst"] = f"""
    WITH detailed AS ({STATEMENTS["quality_details"].replace(CTES["scope"][1], ON_SUPPLIERS)})
    SELECT ticker, check_name, score, details FROM detailed WHERE ticker IN (
        SELECT ticker FROM detailed GROUP BY ticker
        ORDER BY min(score), avg(round(score * 10)), ticker LIMIT 40)"""
STATEMENTS["tickers_needing_attention"] = f"""
    SELECT ticker, check_name, score, details, checked_at FROM ({STATEMENTS["quality_details"]})
    WHERE score < 0.7 ORDER BY score, ticker, check_name LIMIT 100"""
