"""Multi-party perspective rotation of dialogues (DataFrame functions only).

For every participant of a conversation the dialogue is rendered once, with that speaker as the assistant and all
others as named users; masks mark the assistant's own characters. Turns are put in order by a range sort over all
conversations; positions within a conversation come from counts per range, so one conversation may fill many ranges.
Renderings are cut into parts of a fixed number of turns, so no task gathers a whole conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import stored

PART_TURNS = 32
SYSTEM = "system"
UNKNOWN = "unknown"
BEGIN, END = "<|im_start|>", "<|im_end|>"


def placed(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, part, pos, speaker, text) of every turn; order: turn (null first), role, text."""
    speaker = F.when(F.coalesce("role", F.lit("")) == "", UNKNOWN).otherwise(F.col("role"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role",
                        speaker.alias("speaker"), "text", F.monotonically_increasing_id().alias("row"))
    keys = ["conv_id", "turn", "role", "text", "row"]
    ordered = stored(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .select("conv_id", "speaker", "text", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("seq")),
        "chat-order",
    )
    # One row per range.
    ranges = ordered.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("low"))
    ranges = ranges.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n") - F.col("low")).alias("shift"))
    numbered = ordered.join(F.broadcast(ranges), "range").select("conv_id", "speaker", "text", (F.col("seq") + F.col("shift")).alias("at"))
    starts = numbered.groupBy("conv_id").agg(F.min("at").alias("first")).withColumnRenamed("conv_id", "c")
    pos = F.col("at") - F.col("first")
    return numbered.join(starts, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", F.floor(pos / part_turns).cast("long").alias("part"), pos.alias("pos"), "speaker", F.coalesce("text", F.lit("")).alias("text")
    )


def rendered(turns: Column, perspective: Column) -> Column:
    """struct(text, mask): a part of the dialogue from one perspective, and its spans of the assistant's characters."""
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("text"), F.array().cast("array<string>").alias("mask"))

    def step(state: Column, turn: Column) -> Column:
        own = turn["speaker"] == perspective
        name = F.when(own, "assistant").when(turn["speaker"] == SYSTEM, SYSTEM).otherwise(F.concat(F.lit("user name="), turn["speaker"]))
        head = F.concat(F.lit(BEGIN), name, F.lit("\n"))
        body = F.concat(turn["text"], F.lit(END))
        start = state["at"] + F.length(head)
        stop = start + F.length(body)
        span = F.concat_ws(":", start.cast("string"), stop.cast("string"))
        return F.struct(
            (stop + 1).alias("at"), F.concat(state["text"], F.array(F.concat(head, body, F.lit("\n")))).alias("text"),
            F.when(own, F.concat(state["mask"], F.array(span))).otherwise(state["mask"]).alias("mask"),
        )

    return F.aggregate(turns, nothing, step, lambda s: F.struct(F.concat_ws("", s["text"]).alias("text"), F.concat_ws(",", s["mask"]).alias("mask")))


def rotate(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, perspective, part, n_turns, text, mask: parts in order make up one rendering per participant.

    Participants are all speakers but ``system`` and turns without a role, which speak as the user ``unknown``. The
    mask lists start:end of the participant's text and end mark (code points of this part's text, end exclusive). Null
    text is empty; null conversation ids form one conversation; null turns come first, ties go by role and text, and
    repeated turns are all rendered. Conversations without participants give no rows, an empty table none; other
    columns are ignored.
    """
    rows = placed(turns, part_turns)
    turn = F.struct("pos", "speaker", "text")
    parts = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    people = (
        turns.filter((F.coalesce("role", F.lit("")) != "") & (F.col("role") != SYSTEM))
        .select(F.col("conv_id").cast("long").alias("c"), F.col("role").alias("perspective")).filter(F.col("perspective") != UNKNOWN).distinct()
    )
    out = rendered(F.col("turns"), F.col("perspective"))
    return parts.join(people, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "perspective", "part", F.size("turns").cast("long").alias("n_turns"), out.alias("out")
    ).select("conv_id", "perspective", "part", "n_turns", "out.text", "out.mask")
