"""Chat formatting by perspective rotation.

For every participant of a conversation the dialogue is rendered with that speaker as the assistant and all others as
named users, with the character spans on which the speaker's own words stand (the loss mask). Rows are dealt out by
ranges of (conversation, perspective, turn), and positions are summed in two steps, so one very long conversation is
spread over many tasks. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlab.llm.common import stage

#: Roles that are shown in every perspective and never are one.
NARRATORS = ("system",)
#: Turns in one row of the result; longer conversations go on in further parts.
PART_TURNS = 256
UNNAMED = "unknown"


def rotate_perspectives(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", narrators: tuple[str, ...] = NARRATORS, part_turns: int = PART_TURNS
) -> DataFrame:
    """One row per conversation, perspective and part of `part_turns` turns: conv_id, perspective, part, n_turns, text,
    start_char (of the part in the whole rendering), mask (array of struct<start,end>, character positions in the whole
    rendering on which the perspective's own texts stand) and mask_chars.

    A turn is rendered as <|role name|> line, text, <|end|> line: `assistant` for the perspective itself, `system` for a
    narrator, `user NAME` for anyone else. Names and texts are rendered as they are: a marker or line feed in them is not
    escaped, so only the mask, not the text, says for sure where a turn ends. Joining the parts' texts in order gives the whole rendering; conversations of
    up to `part_turns` turns are one row.

    Null or empty roles are the speaker `unknown`; null texts are empty; null turns come first and equal turns follow
    role, then MD5 of the text. Repeated rows are rendered as often as they occur. Rows with a null conversation id form one
    conversation with id null. A conversation of narrators only has no perspective and gives no row. Other columns are
    ignored; an empty table gives an empty result.
    """
    speaker = F.when(F.coalesce(F.trim(F.col(f"`{role}`")), F.lit("")) == "", F.lit(UNNAMED)).otherwise(F.col(f"`{role}`"))
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), speaker.alias("speaker"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("said")
    )
    people = rows.filter(~F.col("speaker").isin(*narrators)).select(F.col("conv_id").alias("p_conv"), F.col("speaker").alias("perspective")).distinct()
    own = F.col("speaker") == F.col("perspective")
    head = F.when(own, F.lit("<|assistant|>\n")).when(F.col("speaker").isin(*narrators), F.concat(F.lit("<|"), F.col("speaker"), F.lit("|>\n"))).otherwise(F.concat(F.lit("<|user "), F.col("speaker"), F.lit("|>\n")))
    seen = rows.join(people, F.col("conv_id").eqNullSafe(F.col("p_conv"))).select(
        "conv_id", "perspective", "turn", "speaker", "said", head.alias("head"), own.alias("own"), (F.length(head) + F.length("said") + F.length(F.lit("\n<|end|>\n"))).alias("size")
    )
    # Rows that differ in nothing may stand in any order, so the last key only spreads them.
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(64))
    # the bounds of the ranges are sampled on the driver, so they hold digests of texts only
    keys = ["conv_id", "perspective", "turn", "speaker", "digest"]
    dealt = stage(seen.withColumn("digest", F.md5("said")).withColumn("tie", spread).repartitionByRange(*keys, "tie").withColumn("block", F.spark_partition_id()), "chat")
    here = Window.partitionBy("block", "conv_id", "perspective").orderBy("turn", "speaker", "digest", "tie")
    sofar = here.rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("l_seq", F.row_number().over(here) - 1).withColumn("l_pos", F.coalesce(F.sum("size").over(sofar), F.lit(0)))
    # one row per block and perspective: as many as there are partitions for the longest conversation
    blocks = dealt.groupBy("block", "conv_id", "perspective").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("chars"))
    before = Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select(
        F.col("block").alias("b_block"), F.col("conv_id").alias("b_conv"), F.col("perspective").alias("b_persp"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("b_seq"), F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("b_pos"),
    )
    placed = local.join(
        bases, (F.col("block") == F.col("b_block")) & F.col("conv_id").eqNullSafe(F.col("b_conv")) & (F.col("perspective") == F.col("b_persp"))
    ).select(
        "conv_id", "perspective", "head", "said", "own",
        (F.col("l_seq") + F.col("b_seq")).cast("long").alias("seq"), (F.col("l_pos") + F.col("b_pos")).cast("long").alias("pos"),
    )
    parts = placed.groupBy("conv_id", "perspective", F.floor(F.col("seq") / part_turns).cast("int").alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("seq", "pos", "head", "said", "own"))).alias("t")
    )
    mask = F.transform(
        F.filter("t", lambda t: t["own"]),
        lambda t: F.struct((t["pos"] + F.length(t["head"])).alias("start"), (t["pos"] + F.length(t["head"]) + F.length(t["said"])).alias("end")),
    )
    return parts.select(
        "conv_id", "perspective", "part", F.size("t").alias("n_turns"),
        F.array_join(F.transform("t", lambda t: F.concat(t["head"], t["said"], F.lit("\n<|end|>\n"))), "").alias("text"),
        F.element_at("t", 1)["pos"].alias("start_char"), mask.alias("mask"),
        F.aggregate(mask, F.lit(0).cast("long"), lambda a, m: a + m["end"] - m["start"]).alias("mask_chars"),
    )
