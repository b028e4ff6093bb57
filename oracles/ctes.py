"""Common table expressions of the check statements, and how they are put together."""

from __future__ import annotations

METRICS = [
    "annualized_volatility", "var_95", "var_99", "cvar_95", "cvar_99", "sharpe_ratio", "max_drawdown",
]
BARS = "ticker, date, open, high, low, close, volume"
LAST_DATE = "(SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)"
SCORING_TIME = f"(CAST({LAST_DATE} AS TIMESTAMP) + INTERVAL 38 HOUR)"


def r(x: str, digits: int = 6) -> str:
    """Rounded, with negative zero turned into zero."""
    return f"(ROUND({x}, {digits}) + 0.0)"


def supplier(key: str = "l_suppkey", prefix: str = "S") -> str:
    return f"'{prefix}' || lpad(CAST({key} AS VARCHAR), 6, '0')"


PX = "100.0 * (1.0 + l_tax - l_discount) + l_extendedprice / 100000.0"


def bars_of(symbol: str, source: str = "lineitem", where: str = "true") -> str:
    return f"""
        SELECT ticker, date,
               min(struct_pack(a := l_orderkey, b := l_linenumber, c := px)).c AS open,
               max(px) AS high, min(px) AS low,
               max(struct_pack(a := l_orderkey, b := l_linenumber, c := px)).c AS close,
               CAST(sum(l_quantity) AS BIGINT) AS volume,
               CAST(date AS TIMESTAMP) + INTERVAL 18 HOUR AS ingested_at,
               CASE max(l_returnflag) WHEN 'A' THEN 's3' WHEN 'N' THEN 'volume'
                    ELSE 'auto_loader' END AS source
        FROM (SELECT {symbol} AS ticker, CAST(l_shipdate AS DATE) AS date, {PX} AS px,
                     l_orderkey, l_linenumber, l_quantity, l_returnflag
              FROM {source} WHERE {where})
        GROUP BY ticker, date"""


def metrics_of(
    source: str,
    rf: float = 0.02,
    std: str = "stddev_samp",
    drawdown: str = "prices",
    min_points: int = 3,
) -> str:
    """The unrounded metric set of every ticker in `source`."""
    later = "close" if drawdown == "prices" else "CASE WHEN prev IS NOT NULL THEN close END"
    first = "min(date)" if drawdown == "prices" else "min(date) FILTER (prev IS NOT NULL)"
    excess = f"(x.r - CAST({rf} AS DOUBLE) / 252)"
    return f"""
        SELECT * FROM (
            SELECT x.ticker, {first} AS window_start, max(date) AS window_end,
                   CASE WHEN stddev_samp(x.r) * sqrt(252) < 1e-10 THEN 0.0
                        ELSE stddev_samp(x.r) * sqrt(252) END AS annualized_volatility,
                   0.0 - any_value(q95) AS var_95, 0.0 - any_value(q99) AS var_99,
                   0.0 - avg(x.r) FILTER (x.r <= q95) AS cvar_95,
                   0.0 - avg(x.r) FILTER (x.r <= q99) AS cvar_99,
                   CASE WHEN {std}({excess}) < 1e-10 THEN 0.0
                        ELSE avg({excess}) / {std}({excess}) * sqrt(252) END AS sharpe_ratio,
                   max((peak - c) / peak) AS max_drawdown
            FROM (SELECT *, {later} AS c,
                         max({later}) OVER (PARTITION BY ticker ORDER BY date) AS peak
                  FROM (SELECT ticker, date, close,
                               lag(close) OVER (PARTITION BY ticker ORDER BY date) AS prev,
                               close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS r
                        FROM {source})) x
            JOIN (SELECT ticker, quantile_cont(r, 0.05) AS q95, quantile_cont(r, 0.01) AS q99
                  FROM (SELECT ticker, close / lag(close)
                               OVER (PARTITION BY ticker ORDER BY date) - 1 AS r FROM {source})
                  GROUP BY ticker) t ON t.ticker = x.ticker
            GROUP BY x.ticker HAVING count(*) >= {min_points})
        WHERE isfinite(annualized_volatility) AND isfinite(sharpe_ratio)"""


# every year that the given lines can be shipped in; a year without lines gives no rows
YEARS = range(1992, 2003)


def stored_year(year: int, rf: float = 0.02) -> str:
    span = f"(SELECT * FROM prices_s WHERE year(date) = {year})"
    return f"""
        SELECT *, CAST(window_end AS TIMESTAMP) + INTERVAL 1 DAY AS computed_at
        FROM ({metrics_of(span, rf)})"""


def scores_of(source: str, as_of: str, at: str) -> str:
    """Four checks, each computed on its own filtered rows."""
    gaps = """SELECT ticker, date, date - lag(date) OVER (PARTITION BY ticker ORDER BY date) AS gap
              FROM {source} WHERE date >= {as_of} - {days}"""
    month = gaps.format(source=source, as_of=as_of, days=30)
    half = gaps.format(source=source, as_of=as_of, days=180)
    return f"""
        SELECT check_date, ticker, check_name, CAST(score AS DOUBLE) AS score FROM (
        SELECT {as_of} AS check_date, ticker, 'freshness' AS check_name,
               CASE WHEN h <= 26 THEN 1.0 WHEN h <= 52 THEN 0.7 WHEN h <= 104 THEN 0.4
                    ELSE 0.1 END AS score
        FROM (SELECT ticker, date_sub('hour', max(ingested_at), {at}) AS h
              FROM {source} GROUP BY ticker)
        UNION ALL BY NAME
        SELECT {as_of} AS check_date, ticker, 'completeness' AS check_name,
               CASE WHEN n / (150.0 / 7) >= 0.95 THEN 1.0 WHEN n / (150.0 / 7) >= 0.85 THEN 0.8
                    WHEN n / (150.0 / 7) >= 0.70 THEN 0.5 ELSE 0.2 END AS score
        FROM (SELECT ticker, count(*) AS n FROM ({month}) WHERE gap IS NOT NULL GROUP BY ticker)
        UNION ALL BY NAME
        SELECT {as_of} AS check_date, ticker, 'outliers' AS check_name,
               CASE WHEN rate = 0 THEN 1.0 WHEN rate < 0.01 THEN 0.9 WHEN rate < 0.03 THEN 0.6
                    ELSE 0.3 END AS score
        FROM (SELECT ticker, count(*) FILTER (z > 3) / count(*) AS rate
              FROM ({z_of(source, as_of)}) GROUP BY ticker)
        UNION ALL BY NAME
        SELECT {as_of} AS check_date, ticker, 'gaps' AS check_name,
               CASE WHEN n = 0 THEN 1.0 WHEN n <= 2 THEN 0.8 WHEN n <= 5 THEN 0.5
                    ELSE 0.2 END AS score
        FROM (SELECT ticker, count(*) FILTER (gap > 5) AS n FROM ({half})
              WHERE gap IS NOT NULL GROUP BY ticker))"""


def z_of(source: str, as_of: str) -> str:
    return f"""
        SELECT ticker, date, abs((close - m) / sd) AS z
        FROM (SELECT ticker, date, close, avg(close) OVER w AS m, stddev_samp(close) OVER w AS sd
              FROM {source} WHERE date >= {as_of} - 225
              WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
        WHERE sd > 0 AND date >= {as_of} - 180"""


def held(slot: str) -> str:
    return f"""
        SELECT b.portfolio, b.ticker, b.weight, x.slot, x.r
        FROM books b JOIN (
            SELECT ticker, r, {slot} AS slot
            FROM (SELECT ticker, date, row_number() OVER w - 1 AS n,
                         close / lag(close) OVER w - 1 AS r
                  FROM prices_t WINDOW w AS (PARTITION BY ticker ORDER BY date))
            WHERE r IS NOT NULL) x ON x.ticker = b.ticker"""


def days_of(held_name: str) -> str:
    return f"""
        SELECT h.portfolio, h.slot, sum(h.weight * h.r) / sum(h.weight) AS pr
        FROM {held_name} h
        JOIN (SELECT portfolio, count(*) AS n FROM books GROUP BY portfolio) k
          ON k.portfolio = h.portfolio
        GROUP BY h.portfolio, h.slot HAVING count(*) = any_value(k.n)"""


def portfolio_risk_of(held_name: str, days_name: str) -> str:
    return f"""
        WITH path AS (
            SELECT portfolio, slot, pr,
                   product(1.0 + pr) OVER (PARTITION BY portfolio ORDER BY slot) AS c
            FROM {days_name}),
        peaks AS (
            SELECT *, max(c) OVER (PARTITION BY portfolio ORDER BY slot) AS peak FROM path),
        cuts AS (
            SELECT portfolio, quantile_cont(pr, 0.05) AS q95, quantile_cont(pr, 0.01) AS q99
            FROM {days_name} GROUP BY portfolio),
        legs AS (
            SELECT portfolio, sum(weight * vol) / sum(weight) AS leg_vol
            FROM (SELECT h.portfolio, h.ticker, any_value(h.weight) AS weight,
                         stddev_samp(h.r) * sqrt(252) AS vol
                  FROM {held_name} h SEMI JOIN {days_name} d
                    ON d.portfolio = h.portfolio AND d.slot = h.slot
                  GROUP BY h.portfolio, h.ticker) GROUP BY portfolio),
        sets AS (
            SELECT p.portfolio, stddev_samp(pr) * sqrt(252) AS vol,
                   0.0 - any_value(q95) AS v95, 0.0 - any_value(q99) AS v99,
                   0.0 - avg(pr) FILTER (pr <= q95) AS c95, 0.0 - avg(pr) FILTER (pr <= q99) AS c99,
                   avg(pr - CAST(0.02 AS DOUBLE) / 252) / stddev_samp(pr) * sqrt(252) AS sharpe,
                   max((peak - c) / peak) AS dd
            FROM peaks p JOIN cuts ON cuts.portfolio = p.portfolio
            GROUP BY p.portfolio HAVING count(*) >= 3)
        SELECT s.portfolio, {r('vol')} AS annualized_volatility, {r('v95')} AS var_95,
               {r('v99')} AS var_99, {r('c95')} AS cvar_95, {r('c99')} AS cvar_99,
               {r('sharpe')} AS sharpe_ratio, {r('dd')} AS max_drawdown,
               {r('leg_vol / vol', 4)} AS diversification_ratio
        FROM sets s JOIN legs ON legs.portfolio = s.portfolio"""


# name: (names it reads, text)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "prices_s": ((), bars_of(supplier())),
    "parted": ((), "SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey"),
    "prices_b": (("parted",), bars_of("upper(p_brand)", "parted")),
    "prices_t": (("parted",), bars_of("p_type", "parted")),
    "v1": ((), bars_of(supplier(), where="l_linestatus = 'F'")),
    "v3": ((), bars_of(supplier(), where="l_returnflag <> 'R'")),
    "batch": (("prices_s", "v3"), f"SELECT {BARS} FROM prices_s UNION ALL SELECT {BARS} FROM v3"),
    "raw": (
        (),
        f"""
        SELECT upper(trim(CASE WHEN l_tax >= 0.075 THEN ' '
                    WHEN l_returnflag = 'R' THEN '  ' || lower({supplier()}) || ' '
                    ELSE {supplier()} END)) AS ticker,
               CASE WHEN l_quantity < 50 THEN CAST(l_shipdate AS DATE) END AS date,
               {PX} AS open, ({PX}) + l_tax - 0.005 AS high, {PX} AS low,
               CASE WHEN l_discount < 0.095 THEN {PX} END AS close,
               CAST(l_quantity - 2 AS BIGINT) AS volume
        FROM lineitem""",
    ),
    "checked": (
        ("raw",),
        """
        SELECT *, coalesce(ticker <> '' AND date IS NOT NULL AND close > 0 AND high >= low
                           AND volume >= 0, false) AS ok_full,
               coalesce(volume >= 0 AND high >= low AND ticker IS NOT NULL AND date IS NOT NULL
                        AND open IS NOT NULL AND close IS NOT NULL, false) AS ok_service
        FROM raw""",
    ),
    "universe_s": (
        (),
        f"""
        SELECT {supplier('s_suppkey')} AS ticker, s_name AS company_name, r_name AS sector,
               s_acctbal >= 0 AS active, TIMESTAMP '2024-01-01' AS added_at
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    ),
    "unlisted": (
        (),
        """
        SELECT n_name AS ticker, n_name AS company_name, r_name AS sector, true AS active,
               TIMESTAMP '2024-01-01' AS added_at
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "tracked": (
        ("universe_s", "unlisted"),
        "SELECT * FROM universe_s UNION ALL SELECT * FROM unlisted",
    ),
    "returns_s": (
        ("prices_s",),
        """
        SELECT * FROM (
            SELECT ticker, date, close, lag(close) OVER w AS prev_close,
                   close / lag(close) OVER w - 1 AS daily_return
            FROM prices_s WINDOW w AS (PARTITION BY ticker ORDER BY date))
        WHERE prev_close IS NOT NULL""",
    ),
    "recent": (
        ("prices_s",),
        "SELECT ticker, date, close FROM prices_s WHERE date > (SELECT max(date) - 365 FROM prices_s)",
    ),
    "dense": (
        ("recent",),
        "SELECT ticker, count(*) AS num_days FROM recent GROUP BY ticker HAVING count(*) >= 50",
    ),
    "rolling": (
        ("prices_s",),
        """
        SELECT ticker, date, close, daily_return, rolling_vol_21d, rolling_mean_21d
        FROM (SELECT *, stddev_samp(daily_return) OVER w * sqrt(252) AS rolling_vol_21d,
                     avg(daily_return) OVER w AS rolling_mean_21d,
                     row_number() OVER (PARTITION BY ticker ORDER BY date) AS n
              FROM (SELECT ticker, date, close,
                           close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1
                           AS daily_return
                    FROM prices_s)
              WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW))
        WHERE n > 21""",
    ),
    "stored": (
        ("prices_s",),
        " UNION ALL ".join(stored_year(y) for y in YEARS),
    ),
    "latest": (
        ("stored",),
        """
        SELECT * FROM stored QUALIFY row_number() OVER (
            PARTITION BY ticker ORDER BY window_end DESC, computed_at DESC) = 1""",
    ),
    "scope": (
        ("prices_b",),
        """
        SELECT * FROM prices_b SEMI JOIN (
            SELECT upper(p_brand) AS ticker FROM part GROUP BY 1 HAVING max(p_size) = 50
        ) active ON active.ticker = prices_b.ticker""",
    ),
    "scores": (("scope",), scores_of("scope", LAST_DATE, SCORING_TIME)),
    "feed": (
        ("prices_s", "v1", "v3"),
        " UNION ALL ".join(
            f"""
            SELECT {version} AS version, u.change_type, u.row.ticker AS ticker, u.row.date AS date,
                   u.row.close AS close, u.row.volume AS volume
            FROM (SELECT unnest(CASE
                    WHEN o.ticker IS NULL THEN [{{'change_type': 'insert', 'row': n}}]
                    WHEN n.ticker IS NULL THEN [{{'change_type': 'delete', 'row': o}}]
                    WHEN o.open <> n.open OR o.high <> n.high OR o.low <> n.low
                      OR o.close <> n.close OR o.volume <> n.volume
                    THEN [{{'change_type': 'update_preimage', 'row': o}},
                          {{'change_type': 'update_postimage', 'row': n}}]
                    ELSE [] END) AS u
                  FROM (SELECT {BARS} FROM {old}) o FULL JOIN (SELECT {BARS} FROM {new}) n
                    ON o.ticker = n.ticker AND o.date = n.date)"""
            for version, old, new in ((2, "v1", "prices_s"), (3, "prices_s", "v3"))
        ),
    ),
    "runs": (
        (),
        """
        SELECT CAST(o_orderkey AS VARCHAR) AS run_id,
               CASE WHEN o_orderpriority[1] <= '2' THEN 'ingest'
                    WHEN o_orderpriority[1] = '3' THEN 'metrics' ELSE 'quality_check' END AS run_type,
               CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'F' THEN 'succeeded'
                    ELSE 'failed' END AS status,
               o_orderdate AS started_at,
               CASE WHEN o_orderstatus <> 'O'
                    THEN o_orderdate + to_seconds(CAST(floor(o_totalprice / 1000) AS BIGINT))
                    END AS finished_at,
               o_custkey AS rows_processed, CAST(0 AS BIGINT) AS rows_failed,
               CASE WHEN o_orderstatus <> 'O' THEN string_split(o_orderpriority, '-') END AS tickers,
               CASE WHEN o_orderstatus = 'P' THEN 'source unavailable' END AS error_message,
               CASE WHEN o_orderpriority[1] = '1' THEN 'list' ELSE 'universe' END AS ticker_source,
               (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) AS as_of
        FROM orders""",
    ),
    "books": (
        ("parted",),
        f"""
        SELECT {supplier(prefix='P')} AS portfolio, p_type AS ticker, sum(l_quantity) AS weight
        FROM parted GROUP BY 1, 2""",
    ),
    "returned": (
        ("parted",),
        f"""
        SELECT {supplier(prefix='P')} AS portfolio, p_type AS ticker, sum(l_quantity) AS weight
        FROM parted WHERE l_returnflag = 'R' GROUP BY 1, 2""",
    ),
    "requests": (
        ("parted",),
        """
        SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS portfolio, p_type AS ticker,
               l_quantity - 1.0 AS weight
        FROM orders LEFT JOIN parted ON l_orderkey = o_orderkey""",
    ),
    "conflicts": (
        ("requests",),
        """
        SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS portfolio, 'exists' AS reason
        FROM orders WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT DISTINCT portfolio, 'duplicate_ticker' FROM requests
        WHERE ticker IS NOT NULL GROUP BY portfolio, ticker HAVING count(*) > 1
        UNION ALL
        SELECT DISTINCT portfolio, 'bad_weight' FROM requests WHERE weight <= 0
        UNION ALL
        SELECT portfolio, 'empty' FROM requests GROUP BY portfolio HAVING count(ticker) = 0""",
    ),
    "held_by_date": (("books", "prices_t"), held("date")),
    "held_by_position": (("books", "prices_t"), held("n")),
    "days_by_date": (("held_by_date",), days_of("held_by_date")),
    "days_by_position": (("held_by_position",), days_of("held_by_position")),
}


def with_ctes(body: str, *needs: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for dependency in CTES[name][0]:
            add(dependency)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    texts = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in order)
    return f"WITH {texts}\n{body}" if order else body
