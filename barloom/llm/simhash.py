"""SimHash near-duplicates, linked through a multi-index of fingerprint segments.

Two fingerprints that differ in at most `distance` bits differ in at most
distance // segments bits within one of their segments. Every fingerprint stands
in a table under each of its segments; the small Hamming ball around each segment
is looked up there, and what is found is kept if the complete distance is small.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.base import map_batches, prepared, stored
from barloom.llm.components import stars

SEED = 42
BITS = 64
# Shingles whose bits are counted at once: 64 bytes each.
AT_ONCE = 50_000


def fingerprint(text: str, words: int = 3) -> int:
    """Unsigned 64-bit SimHash: bits set in over half of the shingles' hashes; 0 without words."""
    tokens = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not tokens:
        return 0
    last = max(1, len(tokens) - words + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, last, AT_ONCE):
        part = tokens[start : min(start + AT_ONCE, last) + words - 1]
        shifted = [part[i:] for i in range(min(words, len(part)))]
        hashes = [digest(s, SEED) for s in map(b" ".join, zip(*shifted, strict=False))]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    over_half = counts * 2 > last
    return int(np.packbits(over_half, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, of whatever type, and its fingerprint as a signed long, one row per input row;
    NULL text: 0."""
    prepared(documents.sparkSession)

    def compute(columns: dict[str, list]) -> dict[str, list]:
        prints = np.array([fingerprint(t or "", words) for t in columns["text"]], dtype=np.uint64)
        return {"doc_id": columns["doc_id"], "fp": prints.astype(np.int64)}

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_batches(documents.select("doc_id", "text"), compute, f"doc_id {kind}, fp long")


def _masks(width: int, radius: int) -> list[int]:
    """Every way to flip at most `radius` of `width` bits."""
    return [
        sum(1 << bit for bit in flipped)
        for size in range(radius + 1)
        for flipped in combinations(range(width), size)
    ]


def links(prints: DataFrame, distance: int = 3, segments: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of different fingerprints that differ in at most `distance` bits.

    `prints` has one row per fingerprint in column fp. A pair may come once per segment.
    """
    if BITS % segments or segments < 2:
        raise ValueError("segments must divide 64 and be at least 2")
    width = BITS // segments
    values = F.array(
        *[
            F.shiftrightunsigned("fp", width * s).bitwiseAND(F.lit((1 << width) - 1))
            for s in range(segments)
        ]
    )
    indexed = prints.select("fp", F.posexplode(values).alias("segment", "value"))
    key = lambda value: (value * segments + F.col("segment")).alias("key")
    ball = F.array(*[F.lit(m).cast("long") for m in _masks(width, distance // segments)])
    entries = indexed.select(F.col("fp").alias("b"), key(F.col("value")))
    probes = indexed.select("fp", "segment", "value", F.explode(ball).alias("mask")).select(
        F.col("fp").alias("a"), key(F.col("value").bitwiseXOR(F.col("mask")))
    )
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    # the ball multiplies a side that looks small, so it must never be taken for a broadcast
    return probes.join(entries.hint("merge"), "key").where((F.col("a") < F.col("b")) & near).select("a", "b")


def _rooted(firsts: DataFrame, distance: int) -> DataFrame:
    """fp, first and the root of its component, of a table with one row per fingerprint."""
    distinct = stored(firsts, "simhash-distinct")
    star = stars(links(distinct, distance))
    return distinct.join(star, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(documents: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per input row.

    component_id is the smallest doc_id that links reach, the row's own included.
    Copies share a fingerprint and are joined through it, so their number costs no
    pairs. Empty and NULL texts have fingerprint zero and are linked like any other;
    a NULL doc_id takes part without giving its component a name (NULL if no row of
    it has an id); repeated rows give repeated rows; an empty table gives no rows.
    """
    prints = stored(fingerprints(documents, words), "simhash")
    rooted = _rooted(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), distance)
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _rank(documents: DataFrame) -> Column:
    """Orders rows by doc_id, NULLs last, then text by its digest, then the other columns by
    their hash; rows of equal rank are equal. Without NULLs, so that it can be joined."""
    hashed = [F.col(name) for name, kind in documents.dtypes if "map<" not in kind]
    return F.struct(
        F.isnull("doc_id").alias("nameless"),
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"),
        F.coalesce(F.md5("text"), F.lit("")).alias("digest"),
        F.xxhash64(*hashed).alias("others"),
    )


def without_near_duplicates(documents: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """The documents, all columns, but only one row of each component: of the smallest doc_id,
    and of rows that share it the first by `_rank`.

    Each row is judged on its own text, so a doc_id with several texts may keep several. Rows
    without doc_id are no copies of rows that have one, only of each other.
    """
    whole = F.struct(*[documents[c] for c in documents.columns]).alias("whole")
    rows = documents.select(whole, _rank(documents).alias("rank"))
    given = rows.select(F.col("rank").alias("doc_id"), F.col("whole.text").alias("text"))
    prints = fingerprints(given, words)
    first = [F.min(F.when(F.col("doc_id.nameless") == without, F.col("doc_id"))) for without in (False, True)]
    rooted = _rooted(prints.groupBy("fp").agg(F.struct(*first).alias("first")), distance)
    least = [F.min(F.col("first")[f"col{n}"]) for n in (1, 2)]
    kept = rooted.groupBy("root").agg(F.array(*least).alias("both"))
    kept = kept.select(F.explode("both").alias("rank")).where("rank IS NOT NULL")
    return rows.join(kept, "rank", "left_semi").dropDuplicates(["rank"]).select("whole.*")
