from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from barloom.llm import divergence
from tests.llm.conftest import CLASHING, rows_of


def expected(rows, least=30, top=50):
    """By the definition, with every term of every group."""
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        key = (lang or "", source or "")
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered)
        counts[key].update(found)
        held[key[0]].update(set(found))
    out = []
    for lang in held:
        kept = [t for t, n in held[lang].items() if n >= least]
        groups = {s: c for (g, s), c in counts.items() if g == lang}

        def shares(count, kept=kept):
            of = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (of + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(q[t] - p[s][t], t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -v, n) for n, (v, item) in enumerate(items, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def frame(spark):
    def make(rows):
        kinds = "text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASHING)
        return spark.createDataFrame([(*r, *["?"] * len(CLASHING)) for r in rows], kinds)

    return make


@pytest.fixture
def rows(rng):
    made = []
    for _ in range(400):
        lang, source = rng.choice(["en", "en", "fr", None, "xx"]), rng.choice(["a", "b", "B", "ü", "", None, "hot", "hot"])
        pool = [f"w{c}" for c in "abcdefghij"] + ["ÉTÉ", "été", "the", "THE"]
        text = " ".join(rng.choice(pool[: 5 + len(source or "xy")]) for _ in range(rng.randrange(60)))
        made.append((rng.choice([text, text, text, text + " 5the_wa", "", None]), lang, source))
    return [*made, *[made[0]] * 50, ("rare words only", "en", "lonely"), (None, "en", "textless"), ("a", "zz", "one")]


@pytest.mark.parametrize("block", [7, 200, divergence.BLOCK_POSTINGS])
def test_against_the_definition(frame, rows, block):
    found = divergence.divergence(frame(rows).repartition(5), least_docs=5, top=4, block_postings=block)
    assert rows_of(found) == sorted(expected(rows, 5, 4), key=repr)


def test_small_tables_of_terms_and_sources(frame, rows, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 10)
    shares = frame([("x", "en", "a")]).limit(0)
    assert rows_of(divergence.divergence(shares)) == []
    import pyarrow as pa

    table = pa.table(
        {
            "lang": ["en"] * 6,
            "term": ["s", "s", "t", "t", "t", "u"],
            "source": ["a", "b", "a", "b", "c", "c"],
            "p": [9, 4, 7, 8, 30, 2],
            "b": [1, 2, 1, 2, 3, 3],
        }
    )
    pairs = Counter()
    for batch in divergence._corrected(iter(table.to_batches(max_chunksize=2))):
        for r in batch.to_pylist():
            pairs[r["a"], r["b"]] += r["both"]
    base = {"a": 1, "b": 2, "c": 3}
    wanted = Counter()
    for term in "stu":
        has = {r["source"]: r["p"] for r in table.to_pylist() if r["term"] == term}
        for a in has:
            for b in has:
                if a < b:
                    one, two = base[a], base[b]
                    wanted[a, b] += (
                        abs(has[a] - has[b]) - abs(has[a] - two) - abs(has[b] - one) + abs(one - two)
                    )
    assert pairs == wanted


def test_runs_are_sorted_and_whole():
    block = divergence.Block()
    added = sum(block.add(l, s, t) for l, s, t in [("en", "b", "x y x"), ("en", "a", "y Z"), ("de", "a", "")])
    rows = [tuple(r.values()) for b in block.run() for r in b.to_pylist()]
    assert added == 4 and rows == [
        ("en", "x", "b", 2, 1),
        ("en", "y", "a", 1, 1),
        ("en", "y", "b", 1, 1),
        ("en", "z", "a", 1, 1),
    ]


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 10)
    text = b"abc " * 9 + b"x" * 50 + b" end"
    parts = list(divergence._slices(text))
    assert b"".join(parts) == text
    assert sum((divergence._TERM.findall(p) for p in parts), []) == divergence._TERM.findall(text)


def test_odd_rows(odd):
    found = divergence.divergence(odd)
    wanted = [(r.text, r.lang, r.source) for r in odd.collect()]
    assert rows_of(found) == sorted(expected(wanted), key=repr)
    assert rows_of(divergence.divergence(odd, least_docs=1, top=3)) == sorted(expected(wanted, 1, 3), key=repr)


def test_large_counts_do_not_overflow(spark):
    counts = spark.createDataFrame([(10**15, 3 * 10**15, 7)], "n long, of long, kept long")
    row = counts.select(divergence._share(F.col("n"), F.col("of"), F.col("kept")).alias("p")).first()
    assert row.p == 1 + 10**9 * (10**15 + 5) // (3 * 10**15 + 35)
