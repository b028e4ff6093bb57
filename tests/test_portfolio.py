from __future__ import annotations

import math
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators import portfolio
from barloom.operators.quantiles import exact_quantile
from barloom.operators.risk import risk_metrics
from barloom.schemas import METRIC_COLUMNS
from barloom.sources.portfolios import PortfolioStore
from conftest import table

HOLDINGS = "portfolio string, ticker string, weight double"


def path(seed, n=40, mu=0.0):
    r = np.random.default_rng(seed).normal(mu, 0.02, n)
    return list(100 * np.cumprod(1 + r))


def expected(series: dict[str, list], weights: dict[str, float], rf=0.02):
    returns = pd.DataFrame({t: pd.Series(v, dtype=float).pct_change().dropna() for t, v in series.items()}).dropna()
    w = np.array([weights[t] for t in returns])
    w = w / w.sum()
    r = returns.to_numpy() @ w
    q95, q99 = np.percentile(r, 5), np.percentile(r, 1)
    growth = np.cumprod(1 + r)
    peak = np.maximum.accumulate(growth)
    vol = r.std(ddof=1) * math.sqrt(252)
    legs = np.array([returns[t].std() for t in returns]) * math.sqrt(252)
    return [
        vol, -q95, -q99, -r[r <= q95].mean(), -r[r <= q99].mean(),
        (r.mean() - rf / 252) / r.std(ddof=1) * math.sqrt(252), ((peak - growth) / peak).max(), w @ legs / vol,
    ]


def measures(row):
    return [row[m] for m in [*METRIC_COLUMNS, "diversification_ratio"]]


def test_risk_matches_numpy_and_weights_only_count_relatively(closes, spark):
    series = {"A": path(1), "B": path(2), "C": path(3)}
    held = spark.createDataFrame(
        [("p", "A", 0.5), ("p", "B", 0.3), ("q", "A", 5.0), ("q", "B", 3.0), ("s", "C", 1.0), ("x", "Z", 1.0)],
        HOLDINGS,
    )
    got = {r.portfolio: r for r in portfolio.portfolio_risk(closes(**series), held).collect()}
    assert set(got) == {"p", "q", "s"}
    want = expected({t: series[t] for t in "AB"}, {"A": 0.5, "B": 0.3})
    assert measures(got["p"]) == pytest.approx(want, abs=6e-5)
    assert measures(got["p"]) == measures(got["q"])
    assert got["s"].diversification_ratio == 1.0
    alone = risk_metrics(closes(C=series["C"])).first()
    assert got["s"].annualized_volatility == alone.annualized_volatility
    assert got["p"].diversification_ratio > 1.0


def test_risk_does_not_depend_on_buckets(closes, spark, monkeypatch):
    prices = closes(A=path(1), B=path(2))
    held = spark.createDataFrame([(f"p{i}", t, 1.0 + i) for i in range(6) for t in "AB"], HOLDINGS)
    plain = sorted(portfolio.portfolio_risk(prices, held, align="position").collect())
    monkeypatch.setattr(portfolio, "BUCKET_SLOTS", 2)
    assert sorted(portfolio.portfolio_risk(prices, held, align="position").collect()) == plain
    by_date = portfolio.portfolio_risk(prices, held)
    assert sorted(by_date.collect()) == plain and len(plain) == 6


def test_building_the_plan_runs_no_job(closes, spark):
    prices = closes(A=path(1), B=path(2))
    held = spark.createDataFrame([("p", "A", 1.0), ("p", "B", 2.0)], HOLDINGS)
    spark.sparkContext.setJobGroup("planning", "planning")
    portfolio.portfolio_risk(prices, held)
    portfolio.replace_holdings(held, held)
    portfolio.create_portfolios(held, held)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("", "")
    assert list(jobs) == []


def test_alignment_by_date_drops_incomplete_days_and_by_position_does_not(closes, spark):
    a, b = path(4, 12), path(5, 12)
    ragged = [None, None, *b[2:]]
    held = spark.createDataFrame([("p", "A", 1.0), ("p", "B", 1.0), ("p", "none", 9.0)], HOLDINGS)
    prices = closes(A=a, B=ragged)
    by_date = table(portfolio.aligned_returns(prices, held), "date")
    assert len(by_date) == 9 and by_date[0]["date"].day == 4
    by_position = table(portfolio.aligned_returns(prices, held, "position"), "position")
    assert [r["position"] for r in by_position] == list(range(1, 10))
    first = (a[1] / a[0] - 1 + b[3] / b[2] - 1) / 2
    assert by_position[0]["portfolio_return"] == pytest.approx(first)
    got = portfolio.portfolio_risk(prices, held, align="position").first()
    assert measures(got) == pytest.approx(expected({"A": a, "B": b[2:]}, {"A": 1, "B": 1}), abs=6e-5)
    grown = table(portfolio.cumulative_returns(portfolio.aligned_returns(prices, held)), "date")
    assert grown[-1]["cumulative"] == pytest.approx(np.prod([1 + r["portfolio_return"] for r in by_date]))


def test_too_few_common_days_and_no_common_day(closes, spark):
    prices = closes(A=[1, 2, 3, None, None, None], B=[None, None, None, 1, 2, 3], C=[1, 2, 3])
    held = spark.createDataFrame([("p", "A", 1.0), ("p", "B", 1.0), ("q", "C", 1.0)], HOLDINGS)
    assert portfolio.portfolio_risk(prices, held).isEmpty()  # none, and two returns
    assert portfolio.aligned_returns(prices, held).where("portfolio = 'p'").isEmpty()


def test_portfolio_requests(spark):
    requests = spark.createDataFrame(
        [
            ("ok", " aapl ", 2.0), ("ok", "MSFT", 6.0), ("stored", "A", 1.0), ("twice", "a", 1.0),
            ("twice", "A ", 1.0), ("bad", "A", 0.0), ("bad", "B", None), ("nothing", None, None), ("n" * 101, "A", 1.0),
        ],
        HOLDINGS,
    )
    existing = spark.createDataFrame([("stored",)], "portfolio string")
    reasons = {(r.portfolio[:9], r.reason) for r in portfolio.portfolio_conflicts(existing, requests).collect()}
    assert reasons == {
        ("stored", "exists"), ("twice", "duplicate_ticker"), ("bad", "bad_weight"),
        ("nothing", "empty"), ("n" * 9, "name_too_long"),
    }
    made = table(portfolio.create_portfolios(existing, requests), "ticker")
    assert [(r["portfolio"], r["ticker"], r["weight"]) for r in made] == [("ok", "AAPL", 0.25), ("ok", "MSFT", 0.75)]


def test_replace_delete_and_list(spark):
    held = spark.createDataFrame([("p", "A", 0.5), ("p", "B", 0.5), ("q", "C", 1.0)], HOLDINGS)
    new = spark.createDataFrame([("p", "d", 3.0), ("p", "e", 1.0)], HOLDINGS)
    got = {(r.portfolio, r.ticker): r.weight for r in portfolio.replace_holdings(held, new).collect()}
    assert got == {("p", "D"): 0.75, ("p", "E"): 0.25, ("q", "C"): 1.0}
    names = spark.createDataFrame([("p",), ("q",), ("empty",)], "portfolio string")
    left, legs = portfolio.delete_portfolios(names, held, names.where("portfolio = 'p'"))
    assert left.count() == 2 and {r.portfolio for r in legs.collect()} == {"q"}
    page = portfolio.portfolio_list(names, held, limit=2, offset=0).orderBy("portfolio").collect()
    assert [(r.portfolio, [tuple(h) for h in r.holdings]) for r in page] == [
        ("empty", []), ("p", [("A", 0.5), ("B", 0.5)]),
    ]


def test_refused_replacements_change_nothing(spark):
    held = spark.createDataFrame([("p", "A", 0.5), ("p", "B", 0.5), ("q", "C", 1.0), ("r", "D", 1.0)], HOLDINGS)
    asked = spark.createDataFrame(
        [("p", None, None), ("q", "X", -1.0), ("q", "x", 3.0), ("new", "A", 1.0), ("r", "e", 2.0)], HOLDINGS
    )
    reasons = {tuple(r) for r in portfolio.replacement_conflicts(held, asked).collect()}
    assert reasons == {("p", "empty"), ("q", "bad_weight"), ("q", "duplicate_ticker"), ("new", "unknown")}
    got = {tuple(r) for r in portfolio.replace_holdings(held, asked).collect()}
    assert got == {("p", "A", 0.5), ("p", "B", 0.5), ("q", "C", 1.0), ("r", "E", 1.0)}


# -- groups -----------------------------------------------------------------------


def test_group_totals_with_two_thousand_hot_keys(spark):
    rows = spark.range(40_000).select((F.col("id") % 2000).alias("k"), F.col("id").alias("v"))
    got = portfolio.with_group_totals(rows, "k", {"n": F.count(F.lit(1)), "s": F.sum("v")})
    want = {k: (20, sum(range(k, 40_000, 2000))) for k in range(2000)}
    assert got.count() == 40_000
    assert {r.k: (r.n, r.s) for r in got.select("k", "n", "s").distinct().collect()} == want


@pytest.mark.parametrize("q", [0.0, 0.01, 0.5, 0.95, 1.0])
def test_exact_quantile_equals_percentile(spark, q):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("k"),
        F.when(F.col("id") % 5 == 0, 0.25).otherwise(F.rand(3) * 2 - 1).alias("v"),
    ).unionByName(spark.createDataFrame([("one", -1.5), ("two", 1.0), ("two", 4.0), ("none", None)], "k string, v double"))
    rows = rows.persist()
    got = {r.k: (r.n, r.quantile) for r in exact_quantile(rows, ["k"], "v", q).collect()}
    want = {
        r.k: (r.n, r.p)
        for r in rows.where("v is not null").groupBy("k").agg(F.count("v").alias("n"), F.percentile("v", F.lit(q)).alias("p")).collect()
    }
    rows.unpersist()
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-12)


@pytest.fixture
def books(spark, tmp_path):
    return PortfolioStore(spark, str(tmp_path / "books"))


def listed(store):
    return {
        r.name: (r.created_at.day, r.updated_at.day, {h.ticker: h.weight for h in r.holdings})
        for r in store.page().collect()
    }


def test_stored_portfolios(spark, books):
    wanted = lambda *rows: spark.createDataFrame(rows, HOLDINGS)
    assert books.page().count() == 0 and books.holdings().count() == 0
    books.create(wanted(("p", " a", 1.0), ("p", "B", 3.0), ("q", "A", 2.0), ("r", None, None)), datetime(2024, 1, 1))
    assert listed(books) == {"p": (1, 1, {"A": 0.25, "B": 0.75}), "q": (1, 1, {"A": 1.0})}
    again = wanted(("p", "C", 1.0), ("s", "C", 2.0))
    assert [tuple(r) for r in books.conflicts(again).collect()] == [("p", "exists")]
    books.create(again, datetime(2024, 1, 2))
    assert listed(books)["p"] == (1, 1, {"A": 0.25, "B": 0.75}) and listed(books)["s"] == (2, 2, {"C": 1.0})
    ids = {r.name: r.portfolio_id for r in books.portfolios().collect()}
    books.replace(wanted(("q", "X", 1.0), ("q", "Y", 1.0), ("nobody", "X", 1.0), ("s", "X", -1.0)), datetime(2024, 1, 3))
    assert listed(books)["q"] == (1, 3, {"X": 0.5, "Y": 0.5}) and listed(books)["s"] == (2, 2, {"C": 1.0})
    assert {r.name: r.portfolio_id for r in books.portfolios().collect()} == ids and len(set(ids.values())) == 3
    books.delete(spark.createDataFrame([("p",), ("p",), ("nobody",)], "portfolio string"))
    assert set(listed(books)) == {"q", "s"}
    assert {r.portfolio for r in books.holdings().collect()} == {"q", "s"}
    assert [r.name for r in books.page(limit=1, offset=1).collect()] == ["s"]


def test_a_commit_that_dies_changes_neither_table(spark, books, tmp_path):
    for day in (1, 2, 3):
        books.create(spark.createDataFrame([(f"p{day}", "A", 1.0)], HOLDINGS), datetime(2024, 1, day))
    seen = books.holdings()
    broken = spark.createDataFrame([("p9", "A", 1.0)], HOLDINGS)
    with pytest.raises(Exception):
        books._commit(broken, lambda rows, write: write(rows).select("no such column"))
    assert set(listed(books)) == {"p1", "p2", "p3"} and books.holdings().count() == 3
    books.create(spark.createDataFrame([("p4", "A", 1.0)], HOLDINGS), datetime(2024, 1, 4))
    assert seen.count() == 3  # the version before is still there, dead and older ones are not
    assert len(list((tmp_path / "books").iterdir())) == 2


# -- blocks of portfolios ----------------------------------------------------------


def test_growth_in_blocks_equals_growth_of_aligned_returns(closes, spark):
    prices = closes(A=path(1, 12), B=[None, *path(2, 8), None, 5.0, 6.0], C=path(3, 12))
    prices = prices.unionByName(prices.where("ticker = 'C' and day(date) = 5"))  # a bar twice
    held = spark.createDataFrame(
        [(f"p{i}", t, 1.0 + i) for i in range(9) for t in "ABC"[: 1 + i % 3]], HOLDINGS
    )
    grown = table(portfolio.portfolio_growth(prices, held), "portfolio", "date")
    path_of = portfolio.cumulative_returns(portfolio.aligned_returns(prices, held))
    assert grown == table(path_of, "portfolio", "date") and len({r["portfolio"] for r in grown}) == 9


def test_no_day_and_no_holdings_returns_are_shuffled(closes, spark):
    held = spark.createDataFrame([("p", "A", 1.0), ("p", "B", 2.0)], HOLDINGS)
    grown = portfolio.portfolio_growth(closes(A=path(1), B=path(2)), held)
    tree = grown._jdf.queryExecution().executedPlan().toString()
    above, below = tree.split("Generate", 1)
    assert "Exchange" not in above  # days stay in their block
    # the one shuffle below takes packed years once per block: legs go beside them, without any
    shuffled, legs = below.split("Union", 1)
    assert shuffled.count("Exchange") == 1 and "null AS year" in legs.splitlines()[1]
