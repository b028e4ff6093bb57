"""License scans: a positional index of rare license words, in SQL functions.

Templates are license notices and passages, as words. A place matches a template if at
least `share` of the template's words stand there, each at its own position, and all words
of the template's key phrases are among them. The index holds postings (template,
position) of each template's rarest words only, rarest by their document frequency in
the files at hand. A file's words are looked up in it: a posting at position p that
is found at word i proposes the start i - p, and only starts that enough rare words
agree on are compared with the whole template.

No match is lost by that: where at most m of a template's words may differ, its m + a
rarest words are indexed and a of them have to agree.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The one non-ASCII character whose lower case is an ASCII letter; it stays as it is.
KELVIN, NOT_ASCII = "K", "ĸ"
AGREE = 2
MOST_TEMPLATE_WORDS = 100_000


def _plain_words(text: str) -> tuple[str, ...]:
    return tuple("".join(c if c.isalnum() else " " for c in text.lower()).split())


@dataclass(frozen=True)
class Template:
    """A passage, the label it stands for and the phrases that must be in it unchanged."""

    label: str
    text: str
    phrases: tuple[str, ...]
    base: bool = False
    share: float = 0.8

    @cached_property
    def words(self) -> tuple[str, ...]:
        return _plain_words(self.text)

    @property
    def least(self) -> int:
        """Words that have to be in their places."""
        return ceil(self.share * len(self.words) - 1e-9)

    @property
    def agree(self) -> int:
        """Rare words that have to propose a start."""
        return max(1, min(AGREE, self.least))

    @property
    def rare(self) -> int:
        """Postings: as many as may be missing, and those that have to agree."""
        return len(self.words) - self.least + self.agree

    @cached_property
    def required(self) -> tuple[int, ...]:
        """Positions of the key phrases' words."""
        found: set[int] = set()
        for phrase in self.phrases:
            wanted = _plain_words(phrase)
            starts = [
                s for s in range(len(self.words)) if wanted and self.words[s : s + len(wanted)] == wanted
            ]
            if not starts:
                raise ValueError(f"key phrase not in its template: {phrase!r}")
            found.update(range(starts[0], starts[0] + len(wanted)))
        return tuple(sorted(found))


def _phrase(label: str, text: str) -> Template:
    return Template(label, text, (text,), base=True, share=1.0)


# The three base phrases, then wording of public licenses and notices.
TEMPLATES: tuple[Template, ...] = (
    _phrase("mit", "mit license"),
    _phrase("apache", "apache license"),
    _phrase("gpl", "general public license"),
    Template("mit", "released under the MIT License", ("mit license",)),
    Template("mit", "licensed under the MIT License", ("mit license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files",
        ("free of charge", "associated documentation files"),
    ),
    Template("apache-2.0", "licensed under the Apache License, Version 2.0", ("apache license version 2",)),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy"
        " of the License at http://www.apache.org/licenses/LICENSE-2.0",
        ("in compliance with the license", "apache org licenses"),
    ),
    Template(
        "gpl-3.0", "licensed under the GNU General Public License, version 3", ("general public license version 3",)
    ),
    Template(
        "gpl-2.0", "licensed under the GNU General Public License, version 2", ("general public license version 2",)
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation",
        ("general public license", "free software foundation"),
    ),
    Template(
        "lgpl", "under the terms of the GNU Lesser General Public License", ("lesser general public license",)
    ),
    Template(
        "agpl", "under the terms of the GNU Affero General Public License", ("affero general public license",)
    ),
    Template(
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license",),
    ),
    Template(
        "epl-2.0",
        "made available under the terms of the Eclipse Public License 2.0",
        ("eclipse public license",),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
        ("source and binary forms", "following conditions"),
    ),
    Template(
        "bsd-3-clause",
        "may be used to endorse or promote products derived from this software without specific"
        " prior written permission",
        ("endorse or promote", "prior written permission"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted",
        ("with or without fee",),
    ),
    Template(
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event"
        " will the authors be held liable for any damages",
        ("provided as is", "held liable"),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ("free and unencumbered", "public domain"),
    ),
    Template("cc0-1.0", "CC0 1.0 Universal Public Domain Dedication", ("public domain dedication",)),
    Template("cc-by-4.0", "licensed under CC BY 4.0", ("cc by 4",)),
    Template("cc-by-sa-4.0", "licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-nc-4.0", "licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template(
        "cc-by-4.0",
        "licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution 4",),
    ),
    Template("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
)


def _checked(templates: Sequence[Template]) -> list[Template]:
    """The templates, all usable and together of bounded size: they travel in the plan."""
    kept = list(templates)
    for template in kept:
        if not template.words or not all(w.isascii() for w in template.words):
            raise ValueError(f"a template needs words of ASCII letters and digits: {template.text!r}")
        if not 0 < template.share <= 1:
            raise ValueError("share must be in (0, 1]")
    if not kept or sum(len(t.words) for t in kept) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates must have 1 to {MOST_TEMPLATE_WORDS} words in all")
    return kept


def words_of(text: Column) -> Column:
    """The words of a text: runs of ASCII letters, digits and non-ASCII characters, A-Z in
    lower case. NULL counts as empty. Non-ASCII letters may come in lower case, too."""
    whole = F.coalesce(text, F.lit(""))
    lowered = F.lower(F.replace(whole, F.lit(KELVIN), F.lit(NOT_ASCII)))
    # an empty part stands before a separator at the start, and after one at the end
    return F.array_remove(F.split(lowered, BETWEEN), "")


def document_frequencies(documents: DataFrame, words: Sequence[str]) -> dict[str, int]:
    """In how many of all rows each given word stands; one number a word, of a bounded list."""
    held = F.array_intersect(words_of(F.col("text")), F.lit(sorted(set(words))))
    counted = documents.select(F.explode(held).alias("word")).groupBy("word").count()
    return {row["word"]: row["count"] for row in counted.collect()}


def rare_postings(
    templates: Sequence[Template], frequencies: dict[str, int]
) -> dict[str, list[tuple[int, int]]]:
    """word -> (template, position): the postings of each template's rarest words, earlier
    positions first among equally rare ones."""
    postings: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(templates):
        places = sorted(
            range(len(template.words)), key=lambda p: (frequencies.get(template.words[p], 0), p)
        )
        for place in sorted(places[: template.rare]):
            postings.setdefault(template.words[place], []).append((number, place))
    return postings


def _constant(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def with_matches(documents: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """doc_id, n_words and matches, one row per input row.

    `matches` is an array of (label, base, start, length, matched): every place, by its
    first word (from 0; negative where the text begins inside the passage), at which a
    template matches, in order of template and start. NULL and empty texts have no words
    and no matches; NULL ids, repeated rows and ids are kept; an empty table gives no rows;
    other columns are ignored. Everything happens within a row, so neither hot groups nor
    many copies matter. One count over all rows, of the templates' words, comes first.
    """
    templates = _checked(templates)
    vocabulary = {w for t in templates for w in t.words}
    postings = rare_postings(templates, document_frequencies(documents, sorted(vocabulary)))

    # folded into constants by the optimizer
    label = _constant([t.label for t in templates], "array<string>")
    base = _constant([t.base for t in templates], "array<boolean>")
    least = _constant([t.least for t in templates], "array<int>")
    agree = _constant([t.agree for t in templates], "array<int>")
    texts = _constant([t.words for t in templates], "array<array<string>>")
    required = _constant([t.required for t in templates], "array<array<int>>")
    index = _constant(
        {w: [{"t": t, "p": p} for t, p in ps] for w, ps in postings.items()},
        "map<string, array<struct<t:int, p:int>>>",
    )

    words = F.col("words")
    numbers = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1))
    rare = F.filter(numbers, lambda i: F.get(words, i).isin(sorted(postings)))
    proposed = F.flatten(
        F.transform(
            "rare",
            lambda i: F.transform(
                F.try_element_at(index, F.get(words, i)),
                lambda p: F.struct(p["t"].alias("t"), (i - p["p"]).alias("start")),
            ),
        )
    )
    # equal proposals stand together; the first of `agree` equal ones is a candidate
    agreed = F.filter(
        "proposals",
        lambda at, k: (F.get("proposals", k + F.get(agree, at["t"]) - 1) == at)
        & ~F.coalesce(F.get("proposals", k - 1) == at, F.lit(False)),
    )

    def compared(at: Column) -> Column:
        text = F.get(texts, at["t"])
        places = F.sequence(F.lit(0), F.size(text) - 1)
        in_place = lambda j: F.get(words, at["start"] + j).eqNullSafe(F.get(text, j))
        return F.struct(
            F.get(label, at["t"]).alias("label"),
            F.get(base, at["t"]).alias("base"),
            at["start"].alias("start"),
            F.size(text).alias("length"),
            F.size(F.filter(places, in_place)).alias("matched"),
            F.get(least, at["t"]).alias("least"),
            F.forall(F.get(required, at["t"]), in_place).alias("phrases"),
        )

    kept = F.filter("compared", lambda m: (m["matched"] >= m["least"]) & m["phrases"])
    fields = ("label", "base", "start", "length", "matched")
    places = F.transform(kept, lambda m: F.struct(*[m[f].alias(f) for f in fields]))
    return (
        documents.select("doc_id", words_of(F.col("text")).alias("words"))
        .withColumn("rare", F.coalesce(rare, F.array().cast("array<int>")))
        .withColumn("proposals", F.array_sort(proposed))
        .withColumn("compared", F.transform(agreed, compared))
        .select("doc_id", F.size(words).cast("long").alias("n_words"), places.alias("matches"))
    )


def license_places(documents: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per match: doc_id, label, base, start, length, matched; words from 0."""
    return with_matches(documents, templates).select("doc_id", F.inline("matches"))


def license_scan(documents: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    n_base counts the places of the base phrases, first_word and last_word are the smallest
    and largest of their starts (NULL without any). Labels are distinct, sorted, joined by
    commas. score is the best match's share of words in place, times 1 - 2^-words: a whole
    passage is surer than a phrase of two words; 0 without matches. Odd input: as in
    `with_matches`.
    """
    of_base = F.filter("matches", lambda m: m["base"])
    starts = F.transform("of_base", lambda m: m["start"].cast("long"))
    joined = lambda ms: F.concat_ws(",", F.array_sort(F.array_distinct(F.col(ms)["label"])))
    sure = F.transform(
        "matches",
        lambda m: m["matched"] / m["length"] * (1 - F.pow(F.lit(0.5), m["matched"].cast("double"))),
    )
    return (
        with_matches(documents, templates)
        .withColumn("of_base", of_base)
        .select(
            "doc_id",
            "n_words",
            F.size("of_base").cast("long").alias("n_base"),
            F.array_min(starts).alias("first_word"),
            F.array_max(starts).alias("last_word"),
            joined("of_base").alias("base_labels"),
            joined("matches").alias("labels"),
            F.coalesce(F.array_max(sure), F.lit(0.0)).alias("score"),
        )
    )


def oracle_sql(templates: Sequence[Template] = TEMPLATES) -> str:
    """DuckDB statement for `license_scan`, by comparing every place with every template."""
    rows = [
        f"({number}, {place}, '{word}', {str(place in template.required).lower()})"
        for number, template in enumerate(templates)
        for place, word in enumerate(template.words)
    ]
    heads = [
        f"({n}, '{t.label}', {str(t.base).lower()}, {len(t.words)}, {t.least}, {len(t.required)})"
        for n, t in enumerate(templates)
    ]
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
        WITH heads(t, label, base, length, least, n_required) AS (VALUES {", ".join(heads)}),
        postings(t, place, word, required) AS (VALUES {", ".join(rows)}),
        files AS (
            SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD}') AS words
            FROM documents
        ), tokens AS (
            SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS number FROM files
        ), found AS (
            SELECT doc_id, t, number - place AS start, count(*) AS matched,
                   count(*) FILTER (WHERE required) AS phrases
            FROM tokens JOIN postings USING (word) GROUP BY ALL
        ), matches AS (
            SELECT doc_id, label, base, start,
                   CAST(matched AS DOUBLE) / length * (1 - pow(0.5, matched)) AS sure
            FROM found JOIN heads USING (t) WHERE matched >= least AND phrases = n_required
        ), scanned AS (
            SELECT doc_id, count(*) FILTER (WHERE base) AS n_base,
                   min(start) FILTER (WHERE base) AS first_word,
                   max(start) FILTER (WHERE base) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(sure) AS sure
            FROM matches GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
               CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
               coalesce(sure, 0.0) AS score
        FROM files LEFT JOIN scanned USING (doc_id)
    """
