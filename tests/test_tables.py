from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barloom.operators import audit, changes, mutate, universe, validate
from barloom.schemas import BAR_KEY, UNIVERSE
from conftest import table


def keyed(frame):
    return {(r.ticker, r.date.day): (r.close, r.volume) for r in frame.collect()}


# -- mutations ---------------------------------------------------------------


def test_insert_ignore_keeps_stored_rows_and_the_first_of_the_batch(bars):
    stored = bars([("A", 0, 10, 1), ("A", 1, 11, 1)])
    batch = bars([("A", 1, 99, 1), ("A", 2, 12, 7), ("A", 2, 13, 5)])
    assert mutate.insert_ignore_count(stored, batch, BAR_KEY).first().inserted == 1
    got = mutate.insert_ignore(stored, batch, BAR_KEY, ["volume"])
    assert keyed(got) == {("A", 1): (10.0, 1), ("A", 2): (11.0, 1), ("A", 3): (13.0, 5)}
    again = mutate.insert_ignore(got, batch, BAR_KEY, ["volume"])
    assert keyed(again) == keyed(got)
    assert mutate.insert_ignore_count(got, batch.where("false"), BAR_KEY).first().inserted == 0


def test_upsert_overwrites_and_is_idempotent(bars):
    stored = bars([("A", 0, 10, 1), ("B", 0, 20, 1)])
    batch = bars([("A", 0, 11, 2), ("A", 0, 12, 3), ("C", 0, 30, 1)])
    got = mutate.upsert(stored, batch, BAR_KEY, ["volume"])
    assert keyed(got) == {("A", 1): (12.0, 3), ("B", 1): (20.0, 1), ("C", 1): (30.0, 1)}
    assert keyed(mutate.upsert(got, batch, BAR_KEY, ["volume"])) == keyed(got)


def test_upsert_of_chosen_columns_keeps_the_others(spark):
    stored = spark.createDataFrame([(1, 0.25, 7)], "k int, vol double, ms int")
    batch = spark.createDataFrame([(1, 0.42, 9), (2, 0.1, 8)], "k int, vol double, ms int")
    got = mutate.upsert(stored, batch, ["k"], ["vol"], set_cols=["vol"])
    assert table(got, "k") == [{"k": 1, "vol": 0.42, "ms": 7}, {"k": 2, "vol": 0.1, "ms": 8}]


def test_equal_ranks_are_settled_the_same_way_every_time(bars):
    rows = bars([("A", 0, c, 1) for c in range(10, 60)])
    picks = {keyed(mutate.first_per_key(rows.repartition(n), BAR_KEY, ["volume"]))[("A", 1)] for n in (1, 3, 8)}
    assert picks == {(10.0, 1)}


def test_merge_universe_three_clauses(spark):
    def at(day):
        return datetime(2024, 1, day)

    stored = spark.createDataFrame(
        [("A", "Old", "x", False, at(1)), ("B", "Bee", "y", True, at(2))], UNIVERSE
    )
    listed = spark.createDataFrame(
        [("A", "New", "z", False, at(9)), ("C", "Sea", "w", True, at(9))], UNIVERSE
    )
    got = {r.ticker: (r.company_name, r.sector, r.active, r.added_at) for r in mutate.merge_universe(stored, listed).collect()}
    assert got == {
        "A": ("New", "z", True, at(1)),
        "B": ("Bee", "y", False, at(2)),
        "C": ("Sea", "w", True, at(9)),
    }


def test_change_feed_replays(bars):
    old = bars([("A", 0, 1, 1), ("A", 1, 2, 1), ("B", 0, 3, 1)])
    new = bars([("A", 0, 1, 1), ("A", 1, 5, 1), ("C", 0, 4, 1)])
    feed = changes.snapshot_diff(old, new, BAR_KEY, 4, datetime(2024, 2, 1))
    kinds = sorted((r["_change_type"], r.ticker, r.close) for r in feed.collect())
    assert kinds == [
        ("delete", "B", 3.0), ("insert", "C", 4.0),
        ("update_postimage", "A", 5.0), ("update_preimage", "A", 2.0),
    ]
    assert keyed(changes.apply_changes(old, feed, BAR_KEY)) == keyed(new)
    volume = {r["_change_type"]: r.changes for r in changes.change_volume(feed).collect()}
    assert volume == {"delete": 1, "insert": 1, "update_preimage": 1, "update_postimage": 1}
    assert changes.newest_changes(feed, datetime(2024, 3, 1)).isEmpty()
    assert changes.newest_changes(feed, datetime(2024, 1, 1), 3).count() == 3


def test_null_to_value_is_a_change(spark):
    old = spark.createDataFrame([(1, None), (2, None)], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    feed = changes.snapshot_diff(old, new, ["k"], 1)
    assert [r["_change_type"] for r in feed.orderBy("_change_type").collect()] == [
        "update_postimage", "update_preimage",
    ]


# -- validation --------------------------------------------------------------


@pytest.fixture
def raw(spark):
    d = date(2024, 1, 2)
    return spark.createDataFrame(
        [
            ("  msft ", d, 1.0, 2.0, 1.0, 1.5, 10),
            ("A", d, 1.0, 1.0, 2.0, 1.5, 10),  # high below low
            ("A", None, 1.0, 2.0, 1.0, 1.5, 10),
            ("A", d, 1.0, 2.0, 1.0, 0.0, 10),  # close not positive
            ("A", d, 1.0, 2.0, 1.0, 1.5, -1),
            (" ", d, 1.0, 2.0, 1.0, 1.5, 0),  # no ticker
            (None, d, 1.0, 2.0, 1.0, 1.5, 0),
            ("A", d, 1.0, None, 1.0, 1.5, 0),
            ("B", d, 1.0, 2.0, 0.0, 1.5, 0),  # low not positive
        ],
        "ticker string, date date, open double, high double, low double, close double, volume bigint",
    )


def test_profiles_and_counts(raw):
    full = sorted(r.ticker for r in validate.validate(raw).collect())
    assert full == ["B", "MSFT"]
    assert sorted(r.ticker for r in validate.validate(raw, "service").collect()) == ["", "A", "B", "MSFT"]
    assert [r.ticker for r in validate.validate(raw, strict_low=True).collect()] == ["MSFT"]
    counts = validate.validation_counts(raw).first()
    assert (counts.total_raw, counts.total_valid, counts.failures) == (9, 2, 7)
    none = validate.validation_counts(raw.where("false")).first()
    assert (none.total_raw, none.total_valid, none.failures) == (0, 0, 0)


def test_ticker_filter_does_not_hide_failures(raw):
    counts = validate.ticker_filter_counts(raw, "msft", profile="full").first()
    assert (counts.total_raw, counts.failures, counts.kept_rows) == (9, 7, 1)
    assert validate.validate(raw, ticker="msft").count() == 1


def test_constraints(raw):
    got = {r.constraint_name: r.violations for r in validate.constraint_violations(raw, validate.PRICE_CONSTRAINTS).collect()}
    assert got == {"valid_price_range": 3, "valid_volume": 1}
    with pytest.raises(Exception, match="valid_volume"):
        validate.require_constraints(raw, {"valid_volume": "volume >= 0"}).collect()
    assert validate.require_constraints(raw, {"named": "open = 1.0"}).count() == 9


def test_adding_a_constraint_twice():
    defined, state = validate.add_constraint({}, "Valid_Volume", "volume >= 0")
    assert state == "added"
    assert validate.add_constraint(defined, "valid_volume", " volume >= 0") == (defined, "present")
    assert validate.add_constraint(defined, "valid_volume", "volume > 0") == (defined, "differs")


def test_text_cells_are_typed(spark):
    text = spark.createDataFrame(
        [("A", "2024-01-02", "1", "2", "1", "1.5", "10.0"), ("A", "bad", "x", "2", "1", "1.5", "10.5")],
        "ticker string, date string, open string, high string, low string, close string, volume string",
    )
    good, bad = validate.typed_prices(text).orderBy(F.desc_nulls_last("date")).collect()
    assert (good.date, good.close, good.volume) == (date(2024, 1, 2), 1.5, 10)
    assert (bad.date, bad.open, bad.volume) == (None, None, None)


# -- universe and audit --------------------------------------------------------


def test_universe_scope(closes, spark):
    prices = closes(A=[1, 2], B=[3])
    listed = spark.createDataFrame([("A", True), ("B", False)], "ticker string, active boolean")
    nobody = listed.withColumn("active", F.lit(False))
    assert universe.scoped_prices(prices, listed).count() == 2
    with pytest.warns(UserWarning):
        assert universe.scoped_prices(prices, nobody).count() == 3
    assert universe.scoped_prices(prices, None).count() == 3
    with pytest.raises(ValueError):
        universe.active_universe(nobody)
    assert universe.active_universe(nobody, required=False).isEmpty()


def test_symbol_lists(spark):
    lists = spark.createDataFrame([(1, "aapl, msft,,"), (2, " , ")], "list_id int, symbols string")
    got = [(r.list_id, r.ticker) for r in universe.parse_ticker_list(lists).orderBy("ticker").collect()]
    assert got == [(1, "AAPL"), (1, "MSFT")]


def test_price_page(bars):
    rows = bars([("A", d, d + 1, 1) for d in range(10)] + [("B", 0, 1, 1)])
    page = table(universe.price_page(rows, "a", limit=3, offset=8), "date")
    assert [(r["date"].day, r["total"]) for r in page] == [(9, 10), (10, 10)]
    assert universe.price_page(rows, "zz").isEmpty()
    with pytest.raises(ValueError):
        universe.list_tickers_page(rows, limit=0)


@pytest.fixture
def runs(spark):
    start = datetime(2024, 1, 10, 6)
    empty = spark.createDataFrame([], audit.RUNS)
    one = audit.register_run(empty, "r1", "ingest", start, {"ticker_source": "list", "lookback_days": 5})
    return audit.register_run(one, "r2", "metrics", start, {"ticker_source": "universe"})


def test_reap_leaves_the_finish_time_open(runs):
    got = {r.run_id: r for r in audit.reap_orphan_runs(runs, "ingest").collect()}
    assert got["r1"].status == "failed" and got["r1"].finished_at is None
    assert got["r1"].error_message.startswith("Run never reported completion")
    assert got["r2"].status == "running" and got["r2"].error_message is None


def test_complete_run(runs, closes):
    done = audit.complete_run(runs, "r1", datetime(2024, 1, 10, 6, 2), 7, closes(B=[1], A=[1, 2]), 3)
    got = {r.run_id: r for r in done.collect()}
    assert got["r1"].tickers_processed == ["A", "B"]
    assert (got["r1"].status, got["r1"].rows_processed, got["r1"].rows_failed) == ("succeeded", 7, 3)
    assert got["r2"].status == "running"
    many = runs.sparkSession.range(150_000).selectExpr("'T' || id AS ticker")
    whole = audit.complete_run(runs, "r1", datetime(2024, 1, 10), 7, many)
    assert whole.where("run_id = 'r1'").selectExpr("size(tickers_processed)").first()[0] == 150_000
    listed = audit.run_tickers("r1", datetime(2024, 1, 10), closes(B=[1], A=[1, 2]))
    assert sorted(r.ticker for r in listed.collect()) == ["A", "B"]
    history = {r.run_id: r.duration_seconds for r in audit.run_history(done, date(2024, 1, 10)).collect()}
    assert history == {"r1": 120, "r2": None}
    rate = audit.run_success_rate(done, date(2024, 1, 10)).first()
    assert (rate.success_rate_pct, rate.total_runs, rate.failed_runs) == (50.0, 2, 0)
    assert audit.run_success_rate(done.where("false"), date(2024, 1, 10)).first().success_rate_pct is None
    asked = {(r.run_type, r.ticker_source, r.runs) for r in audit.run_parameters(runs).collect()}
    assert asked == {("ingest", "list", 1), ("metrics", "universe", 1)}


# -- what a batch costs ------------------------------------------------------------


def test_insert_ignore_count_joins_nothing_and_null_keys_match_nothing(spark):
    kind = "k string, d int"
    stored = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], kind)
    batch = spark.createDataFrame([("a", 1), ("c", 1), ("c", 1), (None, 3), (None, 3), ("b", None)], kind)
    counted = mutate.insert_ignore_count(stored, batch, ["k", "d"])
    assert counted.first().inserted == 3  # (c, 1), (NULL, 3), (b, NULL)
    assert mutate.insert_ignore_count(stored, batch.limit(0), ["k", "d"]).first().inserted == 0
    tree = counted._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in tree and "Sort" not in tree


def test_upsert_computes_its_batch_once_and_keeps_what_does_not_match(spark):
    kind = "k string, v int"
    stored = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("b", 4), (None, 5), (None, 5)], kind)
    batch = spark.createDataFrame([("a", 7), ("a", 9), ("c", 8), (None, 6)], kind)
    merged = mutate.upsert(stored, batch, ["k"], ["v"])
    got = sorted((str(r.k), r.v) for r in merged.collect())
    assert got == [("None", 5), ("None", 5), ("None", 6), ("a", 9), ("b", 3), ("b", 4), ("c", 8)]
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
