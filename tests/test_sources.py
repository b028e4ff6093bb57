from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barloom.operators import validate
from barloom.plans import daily
from barloom.schemas import BARS, METRIC_TABLE, PRICE_TABLE, RUN_TABLE, RUN_TICKER_TABLE, SCORE_TABLE
from barloom.sources import files, wide
from barloom.sources.upserts import forget, read_stored, store
from barloom.streaming.incremental import ingest_new_files
from conftest import table

HEADER = "ticker,date,open,high,low,close,volume\n"
TWO_TICKERS = HEADER + "".join(
    f"{t},2024-01-{d:02d},{p + d},{p + d + 2},{p + d - 1},{p + d + 1},{1000 * d}\n"
    for t, p in (("AAPL", 180), ("MSFT", 370))
    for d in (2, 3, 4, 5, 8)
)
DIRTY = HEADER + (
    "AAPL,2024-01-02,185.0,187.0,184.0,186.0,1000\n"
    "AAPL,2024-01-03,186.0,180.0,184.0,186.0,1000\n"
    "AAPL,invalid-date,186.0,188.0,184.0,186.0,1000\n"
)


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()

    def put(name, text):
        (folder / name).write_text(text)
        return str(folder)

    return put


def test_scan_csv_reads_only_csv_files_of_the_folder(spark, inbox, tmp_path):
    inbox("a.csv", TWO_TICKERS)
    inbox("note.txt", "not prices\n")
    folder = inbox("b.csv", HEADER + "x,2024-02-01,1,2,1,1.5,oops\n")
    got = files.scan_csv(spark, folder)
    assert got.schema == BARS and got.count() == 11
    bad = got.where("ticker = 'x'").first()
    assert (bad.date, bad.volume) == (date(2024, 2, 1), None)
    missing = files.scan_csv(spark, str(tmp_path / "missing"))
    assert missing.schema == BARS and missing.isEmpty()


def test_inferred_scan_ends_in_the_same_types(spark, inbox):
    folder = inbox("a.csv", TWO_TICKERS)
    inferred = files.scan_csv_inferred(spark, folder)
    assert inferred.dtypes == files.scan_csv(spark, folder).dtypes
    assert sorted(inferred.collect()) == sorted(files.scan_csv(spark, folder).collect())


def test_union_by_name(spark):
    parts = [spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([("b", 2)], "v string, k int")]
    assert table(files.union_by_name(parts), "k") == [{"k": 1, "v": "a"}, {"k": 2, "v": "b"}]


def test_tidy_wide_frame(spark):
    cells = {"date": "2024-01-02"}
    for t, base in (("a", 1.0), ("B", 2.0), ("GONE", None), ("PART", 3.0)):
        cells |= {wide.wide_column(t, f): base for f in wide.FIELDS}
    cells[wide.wide_column("PART", "volume")] = None
    frame = spark.createDataFrame([tuple(cells.values())], ", ".join(
        f"`{c}` {'string' if c == 'date' else 'double'}" for c in cells
    ))
    got = wide.tidy_wide_bars(frame)
    assert got.dtypes == [(f.name, f.dataType.simpleString()) for f in BARS.fields]
    assert [(r.ticker, r.close, r.volume) for r in got.orderBy("ticker").collect()] == [("A", 1.0, 1), ("B", 2.0, 2)]
    asked = spark.createDataFrame([("gone",), ("part",), ("a",)], "ticker string")
    assert {r.ticker for r in wide.tidy_no_data(asked, got).collect()} == {"GONE", "PART"}


def test_store_is_idempotent_and_rewrites_only_touched_months(spark, bars, tmp_path):
    path = str(tmp_path / "prices")

    def stamped(rows, source="s3"):
        return validate.stamp(bars(rows), source, datetime(2024, 1, 1))

    store(spark, path, stamped([("A", 0, 10, 1), ("A", 40, 11, 1), ("B", 0, 5, 1)]), ["volume"])
    february = sorted(p.name for p in (tmp_path / "prices" / "month=2024-02").glob("*.parquet"))
    batch = stamped([("A", 0, 12, 1), ("A", 0, 13, 2), ("C", 1, 7, 1)], "volume")
    for _ in range(2):
        store(spark, path, batch, ["volume"])
        got = {(r.ticker, r.date): (r.close, r.source) for r in read_stored(spark, path).collect()}
        assert got == {
            ("A", date(2024, 1, 1)): (13.0, "volume"), ("B", date(2024, 1, 1)): (5.0, "s3"),
            ("A", date(2024, 2, 10)): (11.0, "s3"), ("C", date(2024, 1, 2)): (7.0, "volume"),
        }
    assert february == sorted(p.name for p in (tmp_path / "prices" / "month=2024-02").glob("*.parquet"))
    store(spark, path, stamped([("A", 0, 99, 1), ("D", 0, 1, 1)]), ["volume"], policy="insert_ignore")
    kept = {r.ticker: r.close for r in read_stored(spark, path).where("date = '2024-01-01'").collect()}
    assert kept == {"A": 13.0, "B": 5.0, "D": 1.0}


def test_a_repeated_batch_reuses_its_finished_stage(spark, bars, tmp_path):
    path, staging = str(tmp_path / "prices"), str(tmp_path / "stage")
    first = validate.stamp(bars([("A", 0, 10, 1)]), "s3", datetime(2024, 1, 1))
    store(spark, path, first, ["volume"], staging=staging)
    other = validate.stamp(bars([("A", 0, 77, 1)]), "s3", datetime(2024, 1, 1))
    store(spark, path, other, ["volume"], staging=staging)
    assert [r.close for r in read_stored(spark, path).collect()] == [10.0]


def test_a_stored_batch_is_not_stored_again(spark, bars, tmp_path):
    path, staging = str(tmp_path / "prices"), str(tmp_path / "stage")
    row = lambda close: validate.stamp(bars([("A", 0, close, 1)]), "s3", datetime(2024, 1, 1))
    store(spark, path, row(10), ["volume"], staging=staging)
    store(spark, path, row(20), ["volume"])
    store(spark, path, row(10), ["volume"], staging=staging)  # the repeated batch
    assert [r.close for r in read_stored(spark, path).collect()] == [20.0]


@pytest.mark.parametrize("broken", [{"low": -5.0}, {"low": 0.0}, {"volume": -1}])
def test_rows_that_break_a_constraint_are_refused(spark, bars, tmp_path, broken):
    path = str(tmp_path / "prices")
    good = validate.stamp(bars([("A", 0, 10, 1)]), "s3", datetime(2024, 1, 1))
    store(spark, path, good, ["volume"])
    bad = good.withColumns({c: F.lit(v) for c, v in broken.items()})
    with pytest.raises(Exception, match="constraint .* violated"):
        store(spark, path, good.unionByName(bad), ["volume"], constraints=validate.PRICE_CONSTRAINTS)
    assert [(r.low, r.volume) for r in read_stored(spark, path).collect()] == [(9.0, 1)]


def test_a_recreated_checkpoint_meets_no_old_stage(spark, inbox, tmp_path):
    prices, checkpoint = str(tmp_path / "prices"), tmp_path / "checkpoint"
    folder = inbox("a.csv", HEADER + "A,2024-01-02,1,9,1,1.0,10\n")
    assert ingest_new_files(spark, folder, prices, str(checkpoint)) == 1
    again = tmp_path / "recreated"  # batch 0 of another query, over the same folder
    inbox("b.csv", HEADER + "B,2024-01-02,1,9,1,3.0,10\n")
    assert ingest_new_files(spark, folder, prices, str(again)) == 1
    assert {r.ticker: r.close for r in read_stored(spark, prices).collect()} == {"A": 1.0, "B": 3.0}
    assert (checkpoint / "staged").exists() and (again / "staged").exists()


def test_stream_ingests_each_file_once(spark, inbox, tmp_path):
    prices, checkpoint = str(tmp_path / "prices"), str(tmp_path / "checkpoint")
    folder = inbox("a.csv", TWO_TICKERS)
    assert ingest_new_files(spark, folder, prices, checkpoint) == 1
    assert ingest_new_files(spark, folder, prices, checkpoint) == 0
    inbox("dirty.csv", DIRTY)
    inbox("later.csv", HEADER + "aapl ,2024-02-01,1,2,1,1.5,10\n")
    assert ingest_new_files(spark, folder, prices, checkpoint, max_files=1) == 2
    got = {(r.ticker, r.date): r for r in read_stored(spark, prices).collect()}
    assert len(got) == 11
    assert got[("AAPL", date(2024, 1, 2))].close == 186.0  # corrected by the later file
    assert got[("AAPL", date(2024, 2, 1))].source == "auto_loader"


def test_disk_beside_the_table_is_constant(spark, inbox, tmp_path):
    prices, checkpoint = str(tmp_path / "prices"), tmp_path / "checkpoint"
    for i in range(20):
        folder = inbox(f"f{i:02}.csv", HEADER + f"A,2024-01-{i % 5 + 1:02},1,99,1,{i + 1}.0,10\n")
    assert ingest_new_files(spark, folder, prices, str(checkpoint), max_files=1) == 20
    (query,) = (checkpoint / "staged").iterdir()
    assert [p.name for p in query.iterdir()] == ["19-state"]
    assert read_stored(spark, prices).count() == 5
    # a batch whose commit was lost comes again: it is known by its mark and changes nothing
    before = sorted(map(tuple, read_stored(spark, prices).collect()))
    for commit in (checkpoint / "commits").glob("*19*"):
        commit.unlink()
    files_before = sorted(p.name for p in (tmp_path / "prices").rglob("*.parquet"))
    assert ingest_new_files(spark, folder, prices, str(checkpoint), max_files=1) == 1
    assert sorted(map(tuple, read_stored(spark, prices).collect())) == before
    assert sorted(p.name for p in (tmp_path / "prices").rglob("*.parquet")) == files_before


def test_a_stored_batch_leaves_nothing_staged(spark, bars, tmp_path):
    rows = validate.stamp(bars([("A", 0, 10, 1)]), "s3", datetime(2024, 1, 1))
    staging = tmp_path / "stage"
    store(spark, str(tmp_path / "prices"), rows, ["volume"], staging=str(staging))
    assert sorted(p.name for p in tmp_path.glob("stage*")) == ["stage-state"]
    forget(spark, str(staging))
    assert not list(tmp_path.glob("stage*"))


def test_ingest_counts(spark, inbox, tmp_path):
    tables = daily.Tables(spark, str(tmp_path / "tables"))
    raw = files.scan_csv(spark, inbox("a.csv", TWO_TICKERS))
    first = daily.run_ingest(tables, raw, "s3", "r1", datetime(2024, 1, 9), policy="insert_ignore")
    again = daily.run_ingest(tables, raw, "s3", "r2", datetime(2024, 1, 10), policy="insert_ignore")
    assert (first["inserted"], again["inserted"]) == (10, 0)


def test_dirty_ingest(spark, inbox, tmp_path):
    tables = daily.Tables(spark, str(tmp_path / "tables"))
    raw = files.scan_csv(spark, inbox("a.csv", DIRTY))
    got = daily.run_ingest(tables, raw, "s3", "r1", datetime(2024, 1, 9), profile="service")
    assert got == {"valid": 1, "failures": 2, "inserted": 1}


def test_daily_run(spark, inbox, tmp_path):
    tables = daily.Tables(spark, str(tmp_path / "tables"))
    raw = files.scan_csv(spark, inbox("a.csv", TWO_TICKERS))
    dead = daily.audit.register_run(tables.read(RUN_TABLE), "dead", "ingest", datetime(2024, 1, 1), {})
    tables.write(RUN_TABLE, dead, ["started_at"])
    now = datetime(2024, 1, 9, 8)
    daily.run_ingest(tables, raw, "s3", "r1", now, ticker="msft")
    assert {r.ticker for r in tables.read(PRICE_TABLE).collect()} == {"MSFT"}
    daily.run_ingest(tables, raw, "s3", "r2", now)
    active = spark.createDataFrame([("AAPL", True)], "ticker string, active boolean")
    assert daily.run_quality(tables, "r3", date(2024, 1, 9), now, active) == 4
    assert daily.run_metrics(tables, "r4", now, min_price_points=3) == 2
    assert daily.run_metrics(tables, "r5", now, min_price_points=3) == 2
    assert tables.read(METRIC_TABLE).count() == 2 and tables.read(SCORE_TABLE).count() == 4
    runs = {r.run_id: r for r in tables.read(RUN_TABLE).collect()}
    assert {k: r.status for k, r in runs.items()} == {"dead": "failed", **{f"r{i}": "succeeded" for i in range(1, 6)}}
    assert runs["r1"].tickers_processed == ["MSFT"] and runs["r1"].rows_processed == 10
    assert runs["r3"].tickers_processed == ["AAPL"]
    assert runs["dead"].finished_at is None
    listed = tables.read(RUN_TICKER_TABLE).where("run_id = 'r2'")
    assert {r.ticker for r in listed.collect()} == {"AAPL", "MSFT"}


def test_clustered_layout_splits_a_hot_ticker(spark, tmp_path):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, "HOT").otherwise(F.concat(F.lit("T"), F.col("id"))).alias("ticker"),
        F.date_add(F.lit(date(2000, 1, 1)), F.col("id").cast("int")).alias("date"),
    )
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # these few rows would all be merged into one file
    files.write_table(rows, str(tmp_path / "t"))
    spark.conf.set(merging, "true")
    stored = spark.read.parquet(str(tmp_path / "t"))
    hot = stored.where("ticker = 'HOT'").select(F.input_file_name().alias("f")).distinct()
    assert hot.count() > 1 and stored.count() == 5000
