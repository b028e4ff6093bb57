"""Document fingerprints: Merkle trees of sections, paragraphs and clauses, in SQL functions.

A text is cut after blank lines into sections, after line breaks into paragraphs and
after the punctuation of clauses into leaves; nothing is left out, so the root covers every
character. The fingerprint is `root:leaves`: the root's SHA-256, then the leaves'
short digests, joined by "," within a paragraph, ";" within a section, "/" between
sections. Roots test equality; where two fingerprints' branches differ, texts differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.base import stored

# Fixed values of the tree.
AFTER_SECTION, AFTER_PARAGRAPH, AFTER_CLAUSE = r"(?<=\n\n)", r"(?<=\n)", r"(?<=[.!?,;:|] )"
LEAF_DIGITS = 8


def _cut(text: Column, where: str) -> Column:
    """The parts of a text, none empty unless the text is."""
    parts = F.split(text, where, -1)
    return F.when(F.length(text) == 0, F.array(text)).otherwise(F.filter(parts, lambda p: p != ""))


def _node(children: Column) -> Column:
    return F.sha2(F.concat_ws("", children), 256)


def tree(text: Column) -> Column:
    """Digests of all leaves: sections of paragraphs of clauses; NULL counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    leaves = lambda p: F.transform(_cut(p, AFTER_CLAUSE), lambda s: F.sha2(s, 256))
    return F.transform(
        _cut(whole, AFTER_SECTION), lambda section: F.transform(_cut(section, AFTER_PARAGRAPH), leaves)
    )


def root(leaves: Column) -> Column:
    return _node(F.transform(leaves, lambda section: _node(F.transform(section, _node))))


def fingerprint_of(leaves: Column) -> Column:
    short = lambda leaf: F.substring(leaf, 1, LEAF_DIGITS)
    paragraph = lambda p: F.concat_ws(",", F.transform(p, short))
    section = lambda s: F.concat_ws(";", F.transform(s, paragraph))
    return F.concat(root(leaves), F.lit(":"), F.concat_ws("/", F.transform(leaves, section)))


def _branches(fingerprint: Column, between: str) -> Column:
    return F.split(F.substring_index(fingerprint, ":", -1), between)


def with_fingerprint(frame: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the fingerprint of a text column; the tree is a column of its own, computed once."""
    leaves = f"{name}_leaves"
    return (
        frame.withColumn(leaves, tree(F.col(text)))
        .withColumn(name, fingerprint_of(F.col(leaves)))
        .drop(leaves)
    )


def likeness(left: Column, right: Column) -> Column:
    """Share of the leaves that two fingerprints have in common: 0 to 1, 1 for equal ones."""
    a = F.array_distinct(_branches(left, "[,;/]"))
    b = F.array_distinct(_branches(right, "[,;/]"))
    common = F.size(F.array_intersect(a, b)) * 2.0 / (F.size(a) + F.size(b))
    return F.when(left == right, F.lit(1.0)).otherwise(common)


def edited_paragraphs(left: Column, right: Column) -> Column:
    """Numbers (from 0) of the left document's paragraphs that the right one does not have."""
    ours, theirs = _branches(left, "[;/]"), _branches(right, "[;/]")
    numbers = F.sequence(F.lit(0), F.size(ours) - 1)
    return F.when(left == right, F.array().cast("array<int>")).otherwise(
        F.filter(numbers, lambda i: ~F.array_contains(theirs, F.element_at(ours, i + 1)))
    )


def predecessors(documents: DataFrame) -> DataFrame:
    """(doc_id, copies, prev_id, prev_chars): per distinct doc_id the document before it in
    descending order, NULL last, and the length of its longest row; before the first
    comes the last. `copies` counts the rows of doc_id.

    Ids are range-partitioned, so each window holds one range; only one row per range
    is ordered across ranges.
    """
    by_id = F.col("doc_id").desc_nulls_last()
    ids = documents.groupBy("doc_id").agg(
        F.count("*").alias("copies"), F.max(F.length("text")).alias("chars")
    )
    ranged = stored(
        ids.repartitionByRange(by_id).withColumn("part", F.spark_partition_id()), "merkle-ids"
    )
    this = F.struct("doc_id", "chars")
    # row_number marks the ends: the id itself may be NULL
    within = Window.partitionBy("part").orderBy(by_id)
    numbered = ranged.select(
        "*",
        F.row_number().over(within).alias("number"),
        F.lag(this).over(within).alias("before"),
    )
    size = ranged.groupBy("part").agg(F.count("*").alias("number"))
    ends = numbered.join(size, ["part", "number"]).select("part", this.alias("end"))
    along = Window.orderBy("part")  # one row per range
    last = F.last("end").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    carried = ends.select("part", F.coalesce(F.lag("end").over(along), last).alias("carried"))
    before = F.when(F.col("number") > 1, F.col("before")).otherwise(F.col("carried"))
    return (
        numbered.join(carried, "part")
        .withColumn("before", before)
        .select(
            "doc_id",
            "copies",
            F.col("before.doc_id").alias("prev_id"),
            F.col("before.chars").alias("prev_chars"),
        )
    )


def _half(chars: Column) -> Column:
    return F.floor(chars / 2).cast("int")


def edit_and_compare(documents: DataFrame) -> DataFrame:
    """Fingerprints of every whole text, of its edited text and of the next document's.

    The next document is that of the next smaller doc_id, NULL last, after the last the
    first (a single document follows itself). The edited text has its last
    floor(n_chars / 2) characters replaced by the next document's first as many, or all
    it has. A NULL text is empty. Rows that repeat a doc_id share their next document;
    of several next rows with one id the smallest text counts. Other columns are
    ignored and an empty table gives no rows.
    """
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = stored(predecessors(texts), "merkle-order")
    printed = with_fingerprint(texts, "text", "fingerprint")
    places = order.select(F.col("doc_id").alias("id"), "copies", "prev_id", "prev_chars")
    placed = printed.join(places, F.col("doc_id").eqNullSafe(F.col("id")))

    # what a document hands to the one before it: as much text as that one's half can take
    handed = F.struct(
        F.expr("left(text, cast(floor(prev_chars / 2) AS int))").alias("head"),
        F.col("fingerprint").alias("next_fingerprint"),
    )
    once = placed.where("copies = 1").select("prev_id", handed.alias("next"))
    repeated = (
        placed.where("copies > 1")
        .groupBy("doc_id", "prev_id")
        .agg(F.min(F.struct("text", handed.alias("next"))).alias("least"))
        .select("prev_id", F.col("least.next").alias("next"))
    )
    following = once.union(repeated)
    both = printed.join(following, F.col("doc_id").eqNullSafe(F.col("prev_id")))
    chars = F.length("text")
    edited = (
        both.withColumn("n_chars", chars.cast("long"))
        .withColumn("half", _half(chars))
        .withColumn(
            "edited",
            F.concat(
                F.expr("left(text, cast(n_chars AS int) - half)"), F.expr("left(next.head, half)")
            ),
        )
    )
    printed_twice = with_fingerprint(edited, "edited", "edited_fingerprint")
    return printed_twice.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next.next_fingerprint")).alias("near_next"),
    )
