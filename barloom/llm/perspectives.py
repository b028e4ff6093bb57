"""Multi-party dialogues seen by each participant: perspective rotation with loss masks.

For every participant the dialogue is rendered once: that speaker's turns are the
assistant's and carry the mask, everybody else is a named user, system turns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the rendering.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"
UNKNOWN = "unknown"
# Turns whose lengths are summed before any ordering.
BLOCK = 1024
SAMPLE_CHARS = 32_768


def _plain(text: Column) -> Column:
    """Text that can't be taken for a marker of the rendering."""
    return F.replace(text, F.lit("<|im_"), F.lit("<| im_"))


def rotated_turns(conversations: DataFrame, system: str = SYSTEM) -> DataFrame:
    """One row per conversation, participant and turn: the rendered segment, its place in
    that participant's rendering, and the masked span (the end marker is trained, too).

    Columns conv_id, perspective, turn, segment, starts, mask_from, mask_to; spans are
    character offsets, masks NULL for others' turns. Turns are ordered by turn (NULL
    last), role, text. A NULL text is empty, a NULL or empty role is `unknown`; rows
    with a NULL conv_id form one conversation; repeated rows are repeated turns. A
    conversation of system turns only has no participant and no rows.
    """
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.when(F.col("role") != "", F.col("role")), F.lit(UNKNOWN)).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit((1 << 62))).alias("block"),
    )
    people = (
        turns.where(F.col("speaker") != system)
        .select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective"))
        .distinct()
    )
    seen = turns.join(people, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")

    own = F.col("speaker") == F.col("perspective")
    name = F.regexp_replace("speaker", "[\\t\\n\\f\\r <>|=]", "_")
    head = (
        F.when(own, F.lit("assistant\n"))
        .when(F.col("speaker") == system, F.lit("system\n"))
        .otherwise(F.concat(F.lit("user name="), name, F.lit("\n")))
    )
    seen = (
        seen.withColumn("head", F.concat(F.lit(OPEN), head))
        .withColumn("segment", F.concat("head", _plain(F.col("text")), F.lit(CLOSE)))
        .withColumn("chars", F.length("segment").cast("long"))
    )
    key = ["conv_id", "perspective"]
    # block totals are aggregated partially; only they are ordered along a whole conversation
    before_block = F.sum("chars").over(
        Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = (
        seen.groupBy(*key, "block")
        .agg(F.sum("chars").alias("chars"))
        .select(
            F.col("conv_id").alias("of"),
            F.col("perspective").alias("by"),
            F.col("block").alias("at"),
            F.coalesce(before_block, F.lit(0)).alias("base"),
        )
    )
    within = (
        Window.partitionBy(*key, "block")
        .orderBy(F.col("turn").asc_nulls_last(), "speaker", "text")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = seen.withColumn("inside", F.coalesce(F.sum("chars").over(within), F.lit(0))).join(
        blocks,
        F.col("conv_id").eqNullSafe(F.col("of"))
        & (F.col("perspective") == F.col("by"))
        & (F.col("block") == F.col("at")),
    )
    starts = F.col("base") + F.col("inside")
    return placed.select(
        "conv_id",
        "perspective",
        "turn",
        "segment",
        starts.alias("starts"),
        F.when(own, starts + F.length("head")).alias("mask_from"),
        F.when(own, starts + F.col("chars") - 1).alias("mask_to"),
    )


def samples(rotated: DataFrame, chars: int = SAMPLE_CHARS) -> DataFrame:
    """Rendered dialogues in samples: conv_id, perspective, sample, n_turns, text, masks.

    A segment belongs to the sample of `chars` characters in which it starts, so a
    group holds `chars` characters and one segment's rest at most, however long a
    conversation is; texts in order of `sample` give the whole rendering. masks is
    `from-to` pairs within the sample's text, joined by commas.
    """
    by_start = F.struct("starts", "segment", "mask_from", "mask_to")
    grouped = rotated.groupBy(
        "conv_id", "perspective", F.floor(F.col("starts") / chars).alias("sample")
    ).agg(F.array_sort(F.collect_list(by_start)).alias("turns"))
    first = F.col("turns")[0]["starts"]
    masked = F.filter("turns", lambda t: t["mask_from"].isNotNull())
    spans = F.transform(
        masked,
        lambda t: F.concat(
            (t["mask_from"] - first).cast("string"), F.lit("-"), (t["mask_to"] - first).cast("string")
        ),
    )
    return grouped.select(
        "conv_id",
        "perspective",
        "sample",
        F.size("turns").cast("long").alias("n_turns"),
        F.concat_ws("", F.transform("turns", lambda t: t["segment"])).alias("text"),
        F.concat_ws(",", spans).alias("masks"),
    )


def perspective_samples(conversations: DataFrame, chars: int = SAMPLE_CHARS) -> DataFrame:
    """Every participant's rendering of every conversation, as samples."""
    return samples(rotated_turns(conversations), chars)
