"""Divergence of sources within a language, from term frequencies of a single-pass index.

Each task builds postings (language, term, source) -> (count, documents) in memory until
a block is full, and spills the block as a run sorted by term. Runs go to hash shards of
(language, term); in each shard Spark's external sorter merges the sorted runs with its
priority queue, and a stream over the merged rows adds up equal postings.

Two sources' distance is a sum over all kept terms. All terms that neither has cost one
product, those that one of them has come from the histogram of its own values, and only
the terms that both have are streamed for a correction of the pair.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.base import prepared, stored

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_NO_TERM = re.compile(rb"[^a-z\x80-\xff]")
# Bytes of a text whose terms are listed at once.
SLICE = 1 << 20
# Postings of a block in memory, about 200 bytes each.
BLOCK_POSTINGS = 250_000
SPILL_ROWS = 50_000
# Cells of the tables of terms by sources that corrections are computed from.
CELLS = 2_000_000
SCALE = 1_000_000_000
SALTS = 16

RUN = pa.schema(
    [
        ("lang", pa.string()),
        ("term", pa.string()),
        ("source", pa.string()),
        ("n", pa.int64()),
        ("docs", pa.int64()),
    ]
)
RUN_SQL = "lang string, term string, source string, n long, docs long"
FREQUENCY_SQL = "lang string, term string, source string, n long, total long, leads boolean"
CORRECTION_SQL = "lang string, a string, b string, both long"


def _slices(text: bytes) -> Iterator[bytes]:
    """Parts of a text of about SLICE bytes that cut no term."""
    start = 0
    while start < len(text):
        end = start + SLICE
        if end < len(text):
            gap = _NO_TERM.search(text, end)
            end = gap.start() if gap else len(text)
        yield text[start:end]
        start = end


class Block:
    """Postings of some documents, in memory."""

    def __init__(self) -> None:
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.documents: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def add(self, lang: str, source: str, text: str) -> int:
        """Counts a document's terms; how many postings that has added."""
        counts = self.counts[lang, source]
        before, seen = len(counts), set()
        for part in _slices(text.encode().lower()):  # bytes: A-Z only
            terms = _TERM.findall(part)
            counts.update(terms)
            seen.update(terms)
        self.documents[lang, source].update(seen)
        return len(counts) - before

    def run(self) -> Iterator[pa.RecordBatch]:
        """The postings in order of language, term and source."""
        parts = []
        for (lang, source), counts in self.counts.items():
            docs = self.documents[lang, source]
            size = len(counts)
            columns = [
                pa.repeat(pa.scalar(lang), size),
                pa.array(list(counts), type=pa.binary()).cast(pa.string()),
                pa.repeat(pa.scalar(source), size),
                pa.array(list(counts.values()), type=pa.int64()),
                pa.array([docs[t] for t in counts], type=pa.int64()),
            ]
            parts.append(pa.Table.from_arrays(columns, schema=RUN))
        if parts:
            whole = pa.concat_tables(parts)
            order = pc.sort_indices(whole, [(c, "ascending") for c in ("lang", "term", "source")])
            yield from whole.take(order).combine_chunks().to_batches(max_chunksize=SPILL_ROWS)


def _runs(block_postings: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = Block(), 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held += block.add(lang, source, text)
                if held >= block_postings:
                    yield from block.run()
                    block, held = Block(), 0
        yield from block.run()

    return run


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where rows begin that differ from the row before in some column."""
    changed = np.zeros(len(columns[0]), dtype=bool)
    changed[:1] = True
    for column in columns:
        changed[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(changed)


def _by_term(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The sorted rows in tables that hold all rows of each of their terms."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        langs, terms = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "term"))
        last = int(_starts(langs, terms)[-1])
        head = waiting[-1] if waiting else batch
        same = (
            last == 0
            and head.column("term")[head.num_rows - 1].as_py() == terms[0]
            and head.column("lang")[head.num_rows - 1].as_py() == langs[0]
        )
        if same:
            waiting.append(batch)
            continue
        yield pa.Table.from_batches([*waiting, batch.slice(0, last)], schema=batch.schema)
        waiting = [batch.slice(last)]
    if waiting:
        yield pa.Table.from_batches(waiting)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up equal postings of a shard's merged runs; one posting waits for the next batch."""
    last: list[pa.Array] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if last:
            batch = pa.Table.from_batches(
                [pa.RecordBatch.from_arrays(last, schema=RUN), batch.select(RUN.names).cast(RUN)]
            ).combine_chunks()
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "term", "source")]
        posting = _starts(*keys)
        sums = [
            np.add.reduceat(batch.column(c).to_numpy(zero_copy_only=False), posting) for c in ("n", "docs")
        ]
        columns = [
            pa.array(c, type=f.type)
            for c, f in zip([*(k[posting] for k in keys), *sums], RUN, strict=True)
        ]
        yield pa.RecordBatch.from_arrays([c.slice(0, len(c) - 1) for c in columns], schema=RUN)
        last = [c.slice(len(c) - 1) for c in columns]
    if last:
        yield pa.RecordBatch.from_arrays(last, schema=RUN)


def _merged(least_docs: int):
    """Frequencies of a shard; terms of too few documents go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_term(_added(batches)):
            if not rows.num_rows:
                continue
            lang, term = (rows.column(c).to_numpy() for c in ("lang", "term"))
            first = _starts(lang, term)
            sizes = np.diff(np.append(first, len(lang)))
            docs, n = (np.add.reduceat(rows.column(c).to_numpy(), first) for c in ("docs", "n"))
            leads = np.zeros(len(lang), dtype=bool)
            leads[first] = True
            found = rows.select(["lang", "term", "source", "n"])
            found = found.append_column("total", pa.array(np.repeat(n, sizes)))
            found = found.append_column("leads", pa.array(leads))
            yield from found.filter(pa.array(np.repeat(docs >= least_docs, sizes))).to_batches()

    return run


def term_frequencies(
    documents: DataFrame, least_docs: int = 30, block_postings: int = BLOCK_POSTINGS
) -> DataFrame:
    """(lang, term, source, n, total, leads) of every term that at least `least_docs` rows of
    its language have: n times in the source, total in the language; leads marks one row of
    each term. NULL text, lang and source are empty; other columns are ignored."""
    prepared(documents.sparkSession)
    texts = documents.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    runs = texts.mapInArrow(_runs(block_postings), RUN_SQL)
    shards = runs.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return shards.mapInArrow(_merged(least_docs), FREQUENCY_SQL)


def _share(n: Column, of: Column, kept: Column) -> Column:
    """1 + floor(SCALE (n + 5) / (of + 5 kept)), in whole numbers."""
    wide = lambda c: c.cast("decimal(28,0)")
    above = F.lit(SCALE).cast("decimal(10,0)") * (wide(n) + 5)
    below = wide(of) + wide(kept) * 5
    return F.call_function("div", above, below) + F.lit(1).cast("long")


def _corrected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For terms that two sources have: what the sums of both over their own terms get wrong."""
    for rows in _by_term(batches):
        lang = rows.column("lang").to_numpy()
        for start, end in zip(_starts(lang), [*_starts(lang)[1:], len(lang)], strict=True) if len(lang) else ():
            yield from _pairs(lang[start], rows.slice(start, end - start))


def _pairs(lang: str, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    names, source = np.unique(rows.column("source").to_numpy().astype(object), return_inverse=True)
    first = _starts(rows.column("term").to_numpy())
    sizes = np.diff(np.append(first, rows.num_rows))
    term = np.repeat(np.arange(len(first)), sizes)
    p, b = rows.column("p").to_numpy(), rows.column("b").to_numpy()
    empty = np.zeros(len(names), dtype=np.int64)
    empty[source] = b
    at_once = max(1, CELLS // len(names))
    for begin in range(0, len(first), at_once):
        part = (term >= begin) & (term < begin + at_once)
        values = np.zeros((min(at_once, len(first) - begin), len(names)), dtype=np.int64)
        has = np.zeros(values.shape, dtype=bool)
        values[term[part] - begin, source[part]] = p[part]
        has[term[part] - begin, source[part]] = True
        for one in range(len(names) - 1):
            mine = has[:, one]
            others, theirs = values[mine, one + 1 :], has[mine, one + 1 :]
            own, floor, floors = values[mine, one][:, None], empty[one], empty[None, one + 1 :]
            wrong = abs(own - others) - abs(own - floors) - abs(others - floor) + abs(floor - floors)
            sums = np.where(theirs, wrong, 0).sum(axis=0)
            found = np.flatnonzero(theirs.any(axis=0))
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(lang, pa.string()), len(found)),
                        pa.repeat(pa.scalar(names[one], pa.string()), len(found)),
                        pa.array(names[one + 1 :][found], type=pa.string()),
                        pa.array(sums[found], type=pa.int64()),
                    ],
                    names=["lang", "a", "b", "both"],
                )


def _one_sided(own: Column, floor: Column, other: Column) -> Column:
    """Over a source's own terms: how far its values are from the other's floor, less the floors'
    distance. `own` is an array of (p, terms)."""
    apart = F.abs(floor - other)
    return F.aggregate(
        own, F.lit(0).cast("long"), lambda s, x: s + x["terms"] * (F.abs(x["p"] - other) - apart)
    )


def _pair_values(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of sources of a language."""
    by_term = shares.select("lang", "term", "source", "p", "b")
    both = (
        by_term.repartition("lang", "term")
        .sortWithinPartitions("lang", "term", "source")
        .mapInArrow(_corrected, CORRECTION_SQL)
        .groupBy("lang", "a", "b")
        .agg(F.sum("both").alias("both"))
    )
    # distinct values of a source are few: a count c needs c occurrences
    histogram = (
        shares.groupBy("lang", "source", "p")
        .agg(F.count("*").alias("terms"))
        .groupBy("lang", "source")
        .agg(F.collect_list(F.struct("p", "terms")).alias("own"))
    )
    none = F.array().cast("array<struct<p:bigint,terms:bigint>>")
    sides = groups.join(histogram, ["lang", "source"], "left").select(
        "lang", "source", "kept", "b", F.coalesce("own", none).alias("own")
    )
    # a language's pairs are spread over SALTS tasks, or more where Spark splits them
    salt = F.pmod(F.xxhash64("source"), F.lit(SALTS))
    left = sides.select("lang", salt.alias("salt"), F.struct("source", "kept", "b", "own").alias("l"))
    right = sides.select(
        "lang",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"),
        F.struct("source", "b", "own").alias("r"),
    )
    pairs = left.join(right, ["lang", "salt"]).where("l.source < r.source")
    floors = F.col("l.kept") * F.abs(F.col("l.b") - F.col("r.b"))
    alone = _one_sided(F.col("l.own"), F.col("l.b"), F.col("r.b")) + _one_sided(
        F.col("r.own"), F.col("r.b"), F.col("l.b")
    )
    apart = pairs.select(
        "lang",
        F.col("l.source").alias("a"),
        F.col("r.source").alias("b"),
        F.when(F.col("l.kept") > 0, floors + alone).otherwise(F.lit(0).cast("long")).alias("apart"),
    ).join(both, ["lang", "a", "b"], "left")
    value = F.col("apart") + F.coalesce("both", F.lit(0).cast("long"))
    ways = F.array(
        *[F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("a", "b"), ("b", "a"))]
    )
    return apart.select("lang", F.explode(ways).alias("way"), value.alias("value")).select(
        "lang", "way.source", "way.item", "value"
    )


def divergence(
    documents: DataFrame, least_docs: int = 30, top: int = 50, block_postings: int = BLOCK_POSTINGS
) -> DataFrame:
    """(lang, source, part, item, value, rank): how the sources of a language differ.

    Part `pair` ranks all other sources of the language by the sum of the differences of
    shares over all kept terms, part `term` the `top` terms whose share is furthest above the
    language's. A share is 1 + floor(10^9 (count + 5) / (N + 5 V)), N the counts of all V
    terms that the language keeps. Values descend, equal ones by item.

    NULL text, lang and source are empty; a source without terms has pairs, too, of value 0
    if its language keeps no term; repeated rows count repeatedly; an empty table gives no
    rows; other columns are ignored. Terms are pre-aggregated per block, so a frequent one
    has a row per block; what a task holds is one term's sources and their pairs' sums.
    """
    frequencies = stored(term_frequencies(documents, least_docs, block_postings), "frequencies")
    kept = frequencies.groupBy("lang").agg(
        F.sum(F.col("leads").cast("long")).alias("kept"), F.sum("n").alias("lang_n")
    )
    sums = frequencies.groupBy("lang", "source").agg(F.sum("n").alias("source_n"))
    zero = F.lit(0).cast("long")
    groups = (
        documents.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")])
        .distinct()
        .join(sums, ["lang", "source"], "left")
        .join(kept, "lang", "left")
        .select(
            "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("source_n", "kept", "lang_n")]
        )
        .withColumn(
            "b", F.when(F.col("kept") > 0, _share(zero, F.col("source_n"), F.col("kept"))).otherwise(zero)
        )
    )
    groups = stored(groups, "sources")
    shares = stored(
        frequencies.join(groups, ["lang", "source"]).select(
            "lang",
            "source",
            "term",
            "b",
            _share(F.col("n"), F.col("source_n"), F.col("kept")).alias("p"),
            _share(F.col("total"), F.col("lang_n"), F.col("kept")).alias("q"),
        ),
        "shares",
    )
    terms = shares.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(ranked)
    found = ("lang", "source", "part", "item", "value", "rank")
    of_terms = terms.select("*", F.lit("term").alias("part"), rank.alias("rank")).where(F.col("rank") <= top)
    of_pairs = _pair_values(groups, shares).select("*", F.lit("pair").alias("part"), rank.alias("rank"))
    return of_pairs.select(*found).unionByName(of_terms.select(*found))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE_SQL = f"""
    WITH texts AS (
        SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
                   translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{TERM}') AS terms
        FROM documents
    ), kept AS (
        SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM texts)
        GROUP BY ALL HAVING count(*) >= 30
    ), counted AS (
        SELECT lang, source, term, count(*) AS n
        FROM (SELECT lang, source, unnest(terms) AS term FROM texts) GROUP BY ALL
    ), cells AS (
        SELECT lang, source, term, coalesce(n, 0) AS n
        FROM (SELECT DISTINCT lang, source FROM texts) JOIN kept USING (lang)
        LEFT JOIN counted USING (lang, source, term)
    ), shared AS (
        SELECT lang, source, term, n,
               1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER one + 5 * count(*) OVER one) AS p
        FROM cells WINDOW one AS (PARTITION BY lang, source)
    ), of_lang AS (
        SELECT lang, term,
               1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER one + 5 * count(*) OVER one) AS q
        FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL) WINDOW one AS (PARTITION BY lang)
    ), apart AS (
        SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM shared a JOIN shared b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY ALL
    ), pairs AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM (SELECT DISTINCT lang, source FROM texts) a
        JOIN (SELECT DISTINCT lang, source FROM texts) b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
    ), terms AS (
        SELECT lang, source, 'term' AS part, term AS item, p - q AS value
        FROM shared JOIN of_lang USING (lang, term) WHERE n > 0 AND p > q
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
        FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
    )
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR rank <= 50
"""
