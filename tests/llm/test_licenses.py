from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from barloom.llm import licenses
from barloom.llm.licenses import TEMPLATES, Template

NOTICES = {
    20: "Released under the MIT License.\nAnd the mit-LICENSE again, MIT\nlicense",
    21: "Licensed under the Apache License, Version 2.0.",
    22: "licensed under teh Apache License, Version 2.0",  # one word differs
    23: "Permission is hereby granted, free of money, to any person obtaining a copy of this software",
    24: "General Public License. This work is licensed under the GNU General Public License, version 3.",
    25: "license mit general public apache",  # the words alone
    26: "under the GNU General Public License, version 3, was it",  # begins inside the passage
    27: "ſMIT License; éMIT License; K",
    28: "mit license " * 3000,
    29: "under CC BY-NC 4.0",
}


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(text, templates=TEMPLATES):
    """All places of all templates, by trying every one."""
    found, held = set(), words(text)
    for t in templates:
        for start in range(-len(t.words), len(held)):
            same = {
                j for j, w in enumerate(t.words) if 0 <= start + j < len(held) and held[start + j] == w
            }
            if len(same) >= t.least and same >= set(t.required):
                found.add((t.label, t.base, start, len(t.words), len(same)))
    return found


def check(frame, rows, templates=TEMPLATES):
    got = sorted(
        ((r.doc_id, r.n_words, {tuple(m) for m in r.matches}) for r in licenses.with_matches(frame, templates).collect()),
        key=repr,
    )
    assert got == sorted(((d, len(words(t)), expected(t, templates)) for d, t in rows), key=repr)


def test_every_place_of_every_template(documents, odd_rows, rng):
    rows = [*((d, t) for d, t in odd_rows if len(t or "") < 50_000), *NOTICES.items()]
    pool = sorted({w for t in TEMPLATES for w in t.words})
    for number in range(100, 160):
        passage = list(rng.choice(TEMPLATES).words)
        for _ in range(rng.randrange(4)):
            passage[rng.randrange(len(passage))] = rng.choice(pool)
        rows.append((number, " ".join([*rng.choices(pool, k=9), *passage, *rng.choices(pool, k=9)])))
    check(documents(rows).repartition(5), rows)


def test_digest(documents):
    found = {r.doc_id: r for r in licenses.license_scan(documents(list(NOTICES.items()))).collect()}
    assert (found[20].n_base, found[20].first_word, found[20].last_word) == (3, 3, 10)
    assert (found[20].base_labels, found[20].labels) == ("mit", "mit")
    assert found[21].labels == "apache,apache-2.0" and found[22].labels == "apache,apache-2.0"
    assert found[22].score < found[21].score < 1
    assert found[23].labels == ""  # a key phrase is broken
    assert found[24].n_base == 2 and found[24].labels == "gpl,gpl-3.0"
    assert found[25].n_base == 0 and found[25].first_word is None and found[25].score == 0
    assert found[26].labels == "gpl,gpl-3.0"
    assert found[27].n_base == 0
    assert (found[28].n_base, found[28].last_word) == (3000, 5998)
    assert found[29].base_labels == "" and found[29].labels == "cc-by-nc-4.0"


def test_own_templates_and_places(documents):
    own = [Template("x", "one two three four five", ("two three",))]
    rows = [(1, "one two three four nine one two three four five"), (2, None), (2, "one one"), (None, "two three")]
    check(documents(rows), rows, own)
    places = licenses.license_places(documents(rows), own).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.matched) for r in places] == [(1, 0, 4), (1, 5, 5)]
    with pytest.raises(ValueError):
        licenses.with_matches(documents(rows), [Template("x", "é", ())])
    with pytest.raises(ValueError):
        licenses.with_matches(documents(rows), [])


def test_rarest_words_are_indexed(documents):
    own = [Template("x", "alpha beta gamma", ("alpha beta gamma",), share=1.0)]
    frame = documents([(n, "alpha gamma") for n in range(5)] + [(9, "alpha beta gamma")])
    counts = licenses.document_frequencies(frame, ["alpha", "beta", "gamma"])
    assert counts == {"alpha": 6, "beta": 1, "gamma": 6}
    assert licenses.rare_postings(own, counts) == {"alpha": [(0, 0)], "beta": [(0, 1)]}


def test_nothing_and_no_python(nothing, odd):
    assert licenses.license_scan(nothing).collect() == []
    plan = licenses.license_scan(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow|Exchange", plan.split("== Physical Plan ==")[1].split("InMemoryRelation")[0])
    assert licenses.license_scan(odd.where(F.lit(True))).count() == odd.count()
