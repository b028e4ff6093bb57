from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from barloom.llm import merkle


def chain(rows):
    """Row -> expected edited text, by plain Python; rows have distinct ids."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts = [t or "" for _, t in order]
    out = {}
    for i, (doc_id, _) in enumerate(order):
        text, following = texts[i], texts[(i + 1) % len(texts)]
        half = len(text) // 2
        out[doc_id] = (len(text), text[: len(text) - half] + following[:half])
    return out


def check(frame, rows):
    found = {r.doc_id: r for r in merkle.edit_and_compare(frame).collect()}
    expected = chain(rows)
    assert set(found) == set(expected)
    for doc_id, (chars, edited) in expected.items():
        row = found[doc_id]
        assert (row.n_chars, row.edited_sha256) == (chars, hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    return found


def test_edits_and_next_documents(documents, odd_rows):
    rows = list({doc_id: (doc_id, text) for doc_id, text in odd_rows[:10]}.values())
    found = check(documents(rows).repartition(4), rows)
    assert found[1].fingerprint == found[6].fingerprint != found[7].fingerprint
    assert found[2].fingerprint == found[3].fingerprint  # empty and NULL


def test_many_ranges(spark, documents, rng):
    clause = lambda: " ".join(str(rng.randrange(1000)) for _ in range(5)) + rng.choice([", ", ". ", ".\n"])
    rows = [(rng.randrange(10**12), "".join(clause() for _ in range(20))) for _ in range(300)]
    found = check(documents(rows).repartition(7), rows)
    assert sum(r.near_edited > r.near_next for r in found.values()) > 280


def test_one_document_and_none(documents, nothing):
    rows = [(5, "Only one. Document.")]
    check(documents(rows), rows)
    assert merkle.edit_and_compare(nothing).count() == 0


def test_repeated_ids(documents):
    rows = [(3, "aaaa"), (2, "zz next"), (2, "yy next"), (1, "cc"), (3, "aaaa")]
    found = merkle.edit_and_compare(documents(rows)).collect()
    assert len(found) == 5
    of_three = {r.edited_sha256 for r in found if r.doc_id == 3}
    assert of_three == {hashlib.sha256(b"aayy").hexdigest()}  # the smallest text of id 2


def test_branches_locate_edits(spark):
    left = "First paragraph, with two clauses.\nSecond one.\n\nThird one, in section two."
    frame = spark.createDataFrame([(left, left.replace("Second", "Changed")), (left, left)], "a string, b string")
    prints = merkle.with_fingerprint(merkle.with_fingerprint(frame, "a", "fa"), "b", "fb")
    rows = prints.select(
        merkle.edited_paragraphs(F.col("fa"), F.col("fb")).alias("changed"),
        merkle.likeness(F.col("fa"), F.col("fb")).alias("near"),
        (F.col("fa") == F.col("fb")).alias("same"),
    ).collect()
    assert rows[0].changed == [1] and 0 < rows[0].near < 1 and not rows[0].same
    assert rows[1].changed == [] and rows[1].near == 1.0 and rows[1].same


def test_no_python_in_the_plan(odd):
    plan = merkle.edit_and_compare(odd)._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("Python", "Pandas", "Arrow"))
