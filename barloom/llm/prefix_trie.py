"""Trie of the turns that conversations begin with, its subtree totals by tree contraction.

A node is a sequence of turns, known by the exclusive-or of 128-bit digests of (place,
role, text) over its turns. Totals over subtrees come from a parallel contraction: each
round rakes all leaves into their parents and then takes chain nodes with a single child
out, no two neighbours at once, their weight moving to the child's link. Rounds shrink
the tree by a constant share however deep it is. Going back through the rounds, the
nodes taken out get their totals from the child they were taken out above.

Nodes that one conversation alone passes need no round: they save nothing and have one leaf
below. Of the others, stretches with the same members are one node of the contraction.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.base import prepared, stored

GROUP, LONGEST_SHARED = 5, 9
# Turns of a conversation whose digests are combined in one window.
BLOCK = 4096
# Ids of a node's ends that are written out in one string.
ENDS = 4096
NODE = "struct<high:bigint,low:bigint>"
TOTALS = ("leaves", "saved")
# Rounds that are gone back through in one plan: each has a join, and each join may keep a table in memory.
ROUNDS_AT_ONCE = 4


def _root() -> Column:
    return F.struct(F.lit(0).cast("long").alias("high"), F.lit(0).cast("long").alias("low"))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): each conversation's turns, counted from 0, in order of
    turn (NULL first), role, text; NULL role and text are empty, rows without conv_id go.

    Turns are sorted over all partitions at once, so a long conversation is spread over
    many; only one count per conversation and partition is ordered along it.
    """
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")],
    )
    # equal turns may change places, so any number spreads them
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    spread = turns.withColumn("any", F.monotonically_increasing_id())
    ranged = stored(
        spread.repartitionByRange(*order, "any")
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id()),
        "turns",
    )
    within = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        ranged.groupBy("conv_id", "part")
        .agg(F.count("*").alias("size"))
        .select("conv_id", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    )
    inside = ranged.withColumn("inside", F.row_number().over(within) - 1)
    return inside.join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("base") + F.col("inside")).alias("place"), "role", "text"
    )


def rebuilt_turns(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id, length) and the turns (conv_id, depth from 1, role, text)
    that they have when each begins with the first h turns of conversation c - c % 5, all if
    it has fewer, and goes on with its own after h; h is crc32 of the id in decimal, modulo 9.
    """
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % LONGEST_SHARED
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    sizes = numbered.groupBy("conv_id").agg((F.max("place") + 1).alias("size"))
    named = sizes.select("conv_id", "size", shared.alias("h"), base.alias("of"))
    of = sizes.select(F.col("conv_id").alias("of"), F.col("size").alias("of_size"))
    taken = F.least("h", F.coalesce("of_size", F.lit(0)))
    own = F.greatest(F.col("size") - F.col("h"), F.lit(0))
    plan = named.join(of, "of", "left").select(
        "conv_id", "of", "h", taken.alias("taken"), (taken + own).alias("length")
    )
    heads = numbered.where(F.col("place") < LONGEST_SHARED - 1).withColumnRenamed("conv_id", "of")
    taken_turns = plan.select("conv_id", "of", "taken").join(heads, "of").where("place < taken")
    rest = numbered.join(plan.select("conv_id", "h", "taken"), "conv_id").where("place >= h")
    turns = taken_turns.select("conv_id", (F.col("place") + 1).alias("depth"), "role", "text").union(
        rest.select(
            "conv_id", (F.col("place") - F.col("h") + F.col("taken") + 1).alias("depth"), "role", "text"
        )
    )
    return plan.select("conv_id", "length"), turns


def _half(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 16), 16, -10).cast("long")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, bytes): the node that each turn leads to, and from where."""
    digest = F.md5(
        F.concat_ws(":", F.col("depth"), F.octet_length("role"), F.concat("role", "text")).cast("binary")
    )
    digested = turns.select(
        "conv_id",
        "depth",
        F.floor(F.col("depth") / BLOCK).alias("block"),
        F.octet_length("text").cast("long").alias("bytes"),
        digest.alias("digest"),
    ).select(
        "conv_id", "depth", "block", "bytes", _half(F.col("digest"), 1).alias("high"), _half(F.col("digest"), 17).alias("low")
    )
    within = Window.partitionBy("conv_id", "block").orderBy("depth")
    along = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    halves = ("high", "low")
    blocks = (
        digested.groupBy("conv_id", "block")
        .agg(*[F.bit_xor(h).alias(h) for h in halves])
        .select(
            "conv_id",
            "block",
            *[F.coalesce(F.bit_xor(h).over(along), zero).alias(f"{h}_before") for h in halves],
        )
    )
    inside = digested.select("*", *[F.bit_xor(h).over(within).alias(f"{h}_inside") for h in halves])
    whole = lambda h: F.col(f"{h}_before").bitwiseXOR(F.col(f"{h}_inside"))
    return inside.join(blocks, ["conv_id", "block"]).select(
        "conv_id",
        "depth",
        F.struct(*[whole(h).alias(h) for h in halves]).alias("node"),
        F.struct(*[whole(h).bitwiseXOR(F.col(h)).alias(h) for h in halves]).alias("parent"),
        "bytes",
    )


def _plus(left: str, right: str) -> Column:
    return F.col(left) + F.coalesce(right, F.lit(0).cast("long"))


def subtree_totals(tree: DataFrame) -> DataFrame:
    """(node, leaves, saved): sums over each node's subtree, the node included.

    `tree` has node (unique), parent (NULL for the roots), leaves and saved, the node's own
    amounts. Every round is a table in the shared folder, and so are the totals after every
    ROUNDS_AT_ONCE rounds back; a hub's children are added up by partial aggregation, all joins
    are on the unique node.
    """
    zero = F.lit(0).cast("long")
    children = tree.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n"))
    # link_*: what a node brings its parent besides its own total
    alive = tree.join(children, "node", "left").select(
        "node",
        "parent",
        *TOTALS,
        *[zero.alias(f"link_{t}") for t in TOTALS],
        F.isnull("n").alias("leaf"),
    )
    alive = stored(alive, "trie-0")
    rounds: list[DataFrame] = []
    while alive.where("parent IS NOT NULL").limit(1).count():
        stage = stored(_round(alive, len(rounds)), f"trie-{len(rounds) + 1}")
        rounds.append(stage.where("gone IS NOT NULL"))
        alive = stage.where("gone IS NULL").select(alive.columns)
    totals = alive.select("node", *TOTALS)  # the roots, which hold everything
    for back, gone in enumerate(reversed(rounds), 1):
        raked = gone.where("gone = 'leaf'").select("node", *TOTALS)
        above = gone.where("gone = 'chain'").select(
            F.col("child").alias("node"), F.col("node").alias("above"), *[F.col(t).alias(f"own_{t}") for t in TOTALS]
        )
        # a child has one parent, so each total is handed up once at most
        own = F.struct("node", *TOTALS)
        up = F.struct(F.col("above").alias("node"), *[(F.col(f"own_{t}") + F.col(t)).alias(t) for t in TOTALS])
        handed = totals.join(above, "node", "left").select(
            F.explode(F.when(F.isnull("above"), F.array(own)).otherwise(F.array(own, up))).alias("total")
        )
        totals = handed.select("total.*").union(raked)
        if back % ROUNDS_AT_ONCE == 0:
            totals = stored(totals, f"trie-back-{back}")
    return totals


def node_totals(nodes: DataFrame) -> DataFrame:
    """`nodes` with leaves and saved, the sums over each node's subtree.

    `nodes` has node, parent, conv_id (the smallest member), depth, n_convs, bytes, n_children,
    lone_children (those with one member), parent_conv_id and parent_convs (of its members).
    Nodes with the same smallest member and as many members have the same members, so they
    follow one another, and only the last has other children. Up to BLOCK of them are one
    stretch; the contraction takes stretches, and a node's total is that of its stretch
    without the nodes above.
    """
    zero, lone = F.lit(0).cast("long"), F.col("n_convs") == 1
    stretch = lambda conv, convs, depth: F.struct(
        conv.alias("conv_id"), convs.alias("n_convs"), F.floor(depth / BLOCK).alias("block")
    )
    own_leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("lone_children")).cast("long")
    shared = nodes.where(~lone).select(
        "*",
        stretch(F.col("conv_id"), F.col("n_convs"), F.col("depth")).alias("stretch"),
        own_leaves.alias("own_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("own_saved"),
    )
    above = F.when(
        F.col("parent").isNotNull(), stretch(F.col("parent_conv_id"), F.col("parent_convs"), F.col("depth") - 1)
    )
    tree = shared.groupBy("stretch").agg(
        F.min_by(above, "depth").alias("parent"), *[F.sum(f"own_{t}").alias(t) for t in TOTALS]
    )
    totals = subtree_totals(tree.withColumnRenamed("stretch", "node")).select(
        F.col("node").alias("stretch"), *[F.col(t).alias(f"all_{t}") for t in TOTALS]
    )
    before = Window.partitionBy("stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    passed = shared.select("*", *[F.coalesce(F.sum(f"own_{t}").over(before), zero).alias(f"above_{t}") for t in TOTALS])
    whole = passed.join(totals, "stretch").select(
        *nodes.columns, *[(F.col(f"all_{t}") - F.col(f"above_{t}")).alias(t) for t in TOTALS]
    )
    return whole.union(nodes.where(lone).select("*", F.lit(1).cast("long").alias("leaves"), zero.alias("saved")))


def _round(alive: DataFrame, number: int) -> DataFrame:
    """One rake and one compress. Rows with `gone` have left the tree: as a `leaf`, with its
    total, or from a `chain` above `child`, with what to add to the child's total."""
    of_leaf = lambda t: F.sum(F.when(F.col("leaf"), F.col(t) + F.col(f"link_{t}")))
    below = (
        alive.where("parent IS NOT NULL")
        .groupBy("parent")
        .agg(
            *[of_leaf(t).alias(f"raked_{t}") for t in TOTALS],
            F.count(F.when(~F.col("leaf"), 1)).alias("inner"),
            F.min(F.when(~F.col("leaf"), F.col("node"))).alias("child"),
            # the link of the only inner child; not used where there are more
            *[F.max(F.when(~F.col("leaf"), F.col(f"link_{t}"))).alias(f"child_{t}") for t in TOTALS],
        )
        .withColumnRenamed("parent", "node")
    )
    rank = lambda c: F.xxhash64(F.lit(number), c)
    is_root, is_leaf = F.isnull("parent"), F.col("leaf")
    # taken out: chain nodes that rank above both neighbours, so never two in a row
    chosen = (
        ~is_root
        & ~is_leaf
        & (F.col("inner") == 1)
        & (rank(F.col("node")) > rank(F.col("child")))
        & (rank(F.col("node")) > rank(F.col("parent")))
    )
    raked = alive.join(below, "node", "left").select(
        "node",
        "parent",
        *[_plus(t, f"raked_{t}").alias(t) for t in TOTALS],
        *[f"link_{t}" for t in TOTALS],
        *[f"child_{t}" for t in TOTALS],
        "child",
        (F.coalesce("inner", F.lit(0)) == 0).alias("leaf"),
        F.when(is_leaf & ~is_root, "leaf").when(chosen, "chain").alias("gone"),
    )
    moved = raked.where("gone = 'chain'").select(
        F.col("child").alias("node"),
        F.col("parent").alias("new_parent"),
        *[(F.col(t) + F.col(f"link_{t}")).alias(f"moved_{t}") for t in TOTALS],
    )
    chain = F.col("gone") == "chain"
    # what a chain node's total has besides its child's: its own and what the child's link brings
    own = lambda t: F.when(chain, F.col(t) + F.col(f"child_{t}")).otherwise(F.col(t))
    return raked.join(moved, "node", "left").select(
        "node",
        F.coalesce("new_parent", "parent").alias("parent"),
        *[own(t).alias(t) for t in TOTALS],
        *[_plus(f"link_{t}", f"moved_{t}").alias(f"link_{t}") for t in TOTALS],
        "leaf",
        "gone",
        F.when(chain, F.col("child")).alias("child"),
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's strings, joined by commas; rows come in order of node and place."""
    key, digest = None, None
    done: list[tuple] = []

    def batch() -> pa.RecordBatch:
        nodes = [{"high": h, "low": low} for (h, low), _ in done]
        struct = pa.struct([("high", pa.int64()), ("low", pa.int64())])
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, type=struct), pa.array([d for _, d in done], type=pa.string())],
            names=["node", "ends_sha256"],
        )

    for rows in batches:
        for node, ids in zip(rows.column("node").to_pylist(), rows.column("ids").to_pylist(), strict=True):
            this = (node["high"], node["low"])
            if this != key:
                if digest:
                    done.append((key, digest.hexdigest()))
                key, digest = this, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield batch()
            done = []
    if digest:
        done = [(key, digest.hexdigest())]
        yield batch()


def ends(members: DataFrame) -> DataFrame:
    """(node, ends_sha256): the digest of the ids, ascending, joined by commas, of the
    conversations that end at a node; `members` has node and conv_id, unique per conversation.

    Ids are sorted over all partitions and written out in strings of up to ENDS; the digest
    of a node that many end at only reads those.
    """
    ranged = stored(
        members.repartitionByRange("node", "conv_id").withColumn("part", F.spark_partition_id()), "trie-ends"
    )
    number = F.row_number().over(Window.partitionBy("node", "part").orderBy("conv_id")) - 1
    strings = (
        ranged.select("*", F.floor(number / ENDS).alias("block"))
        .groupBy("node", "part", "block")
        .agg(F.array_sort(F.collect_list("conv_id")).alias("sorted"))
        .select("node", "part", "block", F.array_join(F.col("sorted").cast("array<string>"), ",").alias("ids"))
    )
    return (
        strings.repartition("node")
        .sortWithinPartitions("node", "part", "block")
        .select("node", "ids")
        .mapInArrow(_hashed, f"node {NODE}, ends_sha256 string")
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: conv_id (the smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Members begin with the node's turns, all begin with the textless root. saved_tokens adds
    up, over the subtree, what need not be stored again: (members - 1) times the bytes of the
    last text. Order of turns, NULLs and the rebuilding: see `numbered_turns` and
    `rebuilt_turns`. Repeated rows are repeated turns; conversations without turns left are
    members of the root; other columns are ignored; an empty table gives no rows.
    """
    prepared(conversations.sparkSession)
    members, turns = rebuilt_turns(stored(numbered_turns(conversations), "numbered"))
    members = stored(members, "members")
    placed = stored(prefixes(turns), "prefixes")
    zero = F.lit(0).cast("long")
    root = (
        members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
        .where("n_convs > 0")
        .select(_root().alias("node"), F.lit(None).cast(NODE).alias("parent"), "conv_id", zero.alias("depth"), "n_convs", zero.alias("bytes"))
    )
    nodes = (
        placed.groupBy("node", "parent")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.first("depth").alias("depth"),
            F.count("*").alias("n_convs"),
            F.first("bytes").alias("bytes"),
        )
        .union(root)
    )
    nodes = stored(nodes, "trie-nodes")
    children = (
        nodes.where("parent IS NOT NULL")
        .groupBy(F.col("parent").alias("node"))
        .agg(F.count("*").alias("n_children"), F.count(F.when(F.col("n_convs") == 1, 1)).alias("lone_children"))
    )
    above = nodes.select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_convs").alias("parent_convs")
    )
    counts = ("n_children", "lone_children")
    nodes = nodes.join(children, "node", "left").join(above, "parent", "left")
    nodes = stored(nodes.withColumns({c: F.coalesce(c, zero) for c in counts}), "trie-links")
    last = placed.join(members.where("length > 0"), "conv_id").where("depth = length").select("node", "conv_id")
    turnless = members.where("length = 0").select(_root().alias("node"), "conv_id")
    return (
        node_totals(nodes)
        .join(ends(last.union(turnless)), "node", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


ORACLE_SQL = """
    WITH ordered AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                  coalesce(text, '')) AS place
        FROM conversations WHERE conv_id IS NOT NULL
    ), originals AS (
        SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns FROM ordered GROUP BY ALL
    ), crcs AS (
        -- CRC-32 of the decimal id: eight shifts a byte
        SELECT conv_id, turns, conv_id - conv_id % 5 AS base_id, xor(4294967295, list_reduce(
                   list_concat([4294967295::BIGINT],
                               list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
                   lambda crc, byte: list_reduce(
                       [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                       lambda x, ignored: xor(x >> 1, 3988292384 * (x & 1))))) % 9 AS h
        FROM originals
    ), rebuilt AS (
        SELECT c.conv_id, list_concat(coalesce(o.turns[1:h], []), c.turns[h + 1:]) AS turns
        FROM crcs c LEFT JOIN originals o ON o.conv_id = c.base_id
    ), prefixes AS (
        SELECT conv_id, d AS depth, turns[1:d] AS node, CASE WHEN d > 0 THEN turns[1:d - 1] END AS parent,
               len(turns) = d AS ends_here,
               CASE WHEN d > 0 THEN octet_length(encode(turns[d].text)) ELSE 0 END AS bytes
        FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
    ), nodes AS (
        SELECT node, parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                               FILTER (WHERE ends_here), '')) AS ends_sha256
        FROM prefixes GROUP BY ALL
    ), children AS (
        SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
    ), counted AS (
        SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node)
    ), totals AS (
        SELECT a.node, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves,
               sum((b.n_convs - 1) * b.bytes) AS saved_tokens
        FROM (SELECT *, unnest(range(depth + 1)) AS d FROM counted) b
        JOIN counted a ON a.node = b.node[1:d] GROUP BY ALL
    )
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
           t.n_leaves, CAST(t.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM counted n JOIN totals t ON t.node = n.node LEFT JOIN nodes p ON p.node = n.parent
"""
