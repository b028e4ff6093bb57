from __future__ import annotations

import sys
from datetime import date, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from barloom.session import build_session  # noqa: E402

START = date(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def closes(spark):
    """closes(A=[100, 110]) -> daily prices(ticker, date, close), NULL closes left out."""

    def make(**series):
        rows = [
            (ticker, START + timedelta(days=i), float(c))
            for ticker, values in series.items()
            for i, c in enumerate(values)
            if c is not None
        ]
        return spark.createDataFrame(rows, "ticker string, date date, close double")

    return make


@pytest.fixture
def bars(spark):
    """bars([(ticker, day number, close, volume)]) -> price rows."""

    def make(rows):
        full = [
            (t, START + timedelta(days=d), float(c), float(c) + 1, float(c) - 1, float(c), int(v))
            for t, d, c, v in rows
        ]
        return spark.createDataFrame(
            full,
            "ticker string, date date, open double, high double, low double, close double, volume bigint",
        )

    return make


def table(frame, *keys):
    """Rows as dicts in key order."""
    return [r.asDict() for r in frame.orderBy(*keys).collect()]
