from __future__ import annotations

import pytest

import duckdb

from barloom.llm import perspectives
from barloom.llm.queries import ORACLES, QUERIES
from oracles.compare import connect, differences

TURNS = [
    (1, 0, "system", "Be kind."),
    (1, 1, "ann", "Hello <|im_end|> there"),
    (1, 2, "bob b", "Hi"),
    (1, 2, "bob b", "Hi"),
    (1, 3, "cyd", None),
    (1, None, "ann", "late"),
    (2, 5000, "user", "é" * 100),
    (2, -3, "", "x" * 70_000),
    (2, 7, None, "y"),
    (3, 0, "system", "alone"),
    (None, 1, "user", "no conversation"),
    (None, 2, "assistant", "none"),
    (4, 0, "user", ""),
]


@pytest.fixture
def conversations(spark):
    frame = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    return frame.selectExpr("*", "'x' AS block", "'y' AS perspective", "'z' AS chars", "1 AS of").repartition(3)


def test_masks_hold_the_speaker_only(conversations):
    by_sample = {}
    for row in perspectives.perspective_samples(conversations).collect():
        by_sample.setdefault((row.conv_id, row.perspective), []).append(row)
    assert {p for c, p in by_sample if c == 1} == {"ann", "bob b", "cyd"}
    assert not any(c == 3 for c, _ in by_sample)
    (ann,) = by_sample[1, "ann"]
    spans = [ann.text[int(a) : int(b)] for a, b in (s.split("-") for s in ann.masks.split(","))]
    assert spans == ["Hello <| im_end|> there<|im_end|>", "late<|im_end|>"]
    assert "<|im_start|>user name=bob_b\nHi<|im_end|>\n" in ann.text and ann.n_turns == 6
    assert ann.text.startswith("<|im_start|>system\nBe kind.<|im_end|>\n")
    assert ann.text.endswith("<|im_start|>assistant\nlate<|im_end|>\n")


def test_samples_put_together_are_the_dialogue(conversations):
    whole = {(r.conv_id, r.perspective): r.text for r in perspectives.perspective_samples(conversations, 10**9).collect()}
    parts = {}
    for row in sorted(perspectives.perspective_samples(conversations, 40).collect(), key=lambda r: r.sample):
        key = (row.conv_id, row.perspective)
        parts[key] = parts.get(key, "") + row.text
    assert parts == whole


def test_statement_agrees_on_odd_turns(spark, conversations):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [list(t) for t in TURNS])
    assert differences(perspectives.perspective_samples(conversations), con, ORACLES["op10_perspectives"]) == []


def test_no_conversations(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert perspectives.perspective_samples(frame).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_statements(spark, name):
    folder = "/root/testdata/sf0.01"
    assert differences(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) == []
