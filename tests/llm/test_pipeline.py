"""The pipeline's stages on given documents, and on odd ones."""

from __future__ import annotations

import pytest

import corpus_pipeline
from barloom.llm.base import stored

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def passed(spark):
    """The table after each stage over the smallest given documents."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], FOLDER), name))
    return out


def test_run_is_the_stages_in_turn(spark, passed):
    found = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, passed[-1].collect()))


def test_stages_keep_the_columns(passed):
    assert all(frame.columns == passed[0].columns for frame in passed[:-1])


def test_each_stage_decides(spark, passed):
    given, spoken, single, cut, clean, encoded = (f.toPandas().set_index("doc_id") for f in passed)
    assert set(spoken.index) == set(given.index)  # all given texts are in a language
    assert single.text.is_unique and set(single.text) == set(spoken.text)
    assert set(cut.index) == set(single.index) and (cut.n_chars == cut.text.str.len()).all()
    assert cut.text.str.len().sum() < single.text.str.len().sum()
    leaking = set(cut.index) - set(clean.index)
    items = [r.text.lower() for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert leaking == {i for i, t in cut.text.items() if any(x in t.lower() for x in items)} and leaking
    assert set(encoded.index) == set(clean.index) and (encoded.n_tokens == encoded.ids.str.len()).all()


def test_odd_documents_pass(spark, odd, nothing):
    docs, empty = odd, nothing
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), f"odd-{name}")
        empty = stored(stage(spark, empty, FOLDER), f"empty-{name}")
    assert empty.count() == 0
    assert {r.doc_id for r in docs.collect()} >= {1, 7}
