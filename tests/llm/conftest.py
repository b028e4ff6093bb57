from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrame

# Names that operators use for columns of their own.
CLASHING = ["row", "doc", "spans", "whole", "key", "fp", "fingerprint", "score", "best", "digest", "value"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{name} string" for name in CLASHING
)
LONG = " ".join(f"word{i % 977} and more." for i in range(20_000))
TEXTS = {
    1: "The quick brown fox jumps over the lazy dog. It was a fine day.\nThen it rained, and all went home.",
    2: "",
    3: None,
    4: " \t\n ",
    5: "1234 5678 !!! ---",
    6: "The quick brown fox jumps over the lazy dog. It was a fine day.\nThen it rained, and all went home.",
    7: LONG,
    8: "é" * 60 + "日本語 text\0with \r\n odd   spaces ▁ and <s> </s> <|endoftext|>",
    9: "x" * 3000,
    None: "A text without an id, but with words of its own in it.",
}


@pytest.fixture(scope="session")
def documents(spark):
    """documents([(doc_id, text[, lang])]) -> the table, with columns of clashing names."""

    def make(rows) -> DataFrame:
        full = [
            (row[0], row[1], row[2] if len(row) > 2 else "en", "s", len(row[1] or ""), *(["?"] * len(CLASHING)))
            for row in rows
        ]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and very long texts, ties, repeated rows, repeated ids."""
    rows = list(TEXTS.items())
    return [*rows, rows[0], (6, "another text under the same id"), (None, None)]


@pytest.fixture(scope="session")
def odd(documents, odd_rows):
    return documents(odd_rows).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([])


@pytest.fixture
def rng():
    return random.Random(20)


def rows_of(frame: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=repr)
