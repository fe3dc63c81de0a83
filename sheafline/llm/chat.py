"""Chat formatting from each participant's point of view.

For every participant of a dialogue the dialogue is rendered with that speaker as
the assistant and all others as named users; the mask holds the character ranges
that the assistant says. Only built-in functions are used.

A dialogue of any length is rendered in blocks of bounded size, each a row of its
own; the blocks of a participant in order are the whole rendering. So a dialogue
that holds a third of all turns is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BLOCK_TURNS = 64
# The chat template.
START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT, USER = "assistant", "user"
NOBODY = "unknown"


def _head(speaker: Column, own: Column) -> Column:
    named = F.concat(F.lit(f"{START}{USER} name="), speaker, F.lit("\n"))
    return F.when(own, F.lit(f"{START}{ASSISTANT}\n")).otherwise(named)


def turn_blocks(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(conv_id, block, part, turns): the turns of a dialogue in blocks, in order.

    A block is a range of turn numbers, so no task needs the whole dialogue to find
    it. Where more turns than that share a range (turns with the same number), the
    range goes on in further parts.
    """
    keyed = turns.withColumn("block", F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-1)).cast("bigint"))
    place = F.row_number().over(W.partitionBy("conv_id", "block").orderBy("turn", "role", "text"))
    keyed = keyed.withColumn("part", F.floor((place - 1) / block_turns).cast("bigint"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return keyed.groupBy("conv_id", "block", "part").agg(ordered.alias("turns"))


def perspectives(
    turns: DataFrame,
    block_turns: int = BLOCK_TURNS,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Per participant and block: conv_id, participant, block, part, n_turns, n_own, text, spans.

    ``spans`` are the (start, end) character ranges of ``text`` that the participant
    says, with the end mark behind them. Turns go by number, then speaker, then
    text; turns without a number come first, in block -1. A row that repeats
    another in all four columns is one turn; turns that only share a number all
    stay. A null text is empty, a null speaker is ``unknown``; rows without a
    dialogue id make up one dialogue of null id; other columns are left behind; an
    empty table gives no rows.
    """
    rows = turns.select(
        F.col(conv_col).cast("bigint").alias("conv_id"),
        F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(NOBODY)).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).distinct()
    blocks = turn_blocks(rows, block_turns)
    people = rows.select(F.col("conv_id").alias("_conv"), F.col("role").alias("participant")).distinct()
    both = blocks.join(people, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")

    own = lambda t: t["role"] == F.col("participant")
    said = F.transform("turns", lambda t: F.concat(_head(t["role"], own(t)), t["text"], F.lit(END)))
    step = both.withColumn("said", said)
    at = F.lit(0).cast("int")
    none = F.array().cast("array<struct<start:int,end:int>>")

    def add(done: Column, i: Column) -> Column:
        turn, size = F.get(F.col("turns"), i), F.char_length(F.get(F.col("said"), i))
        end = done["at"] + size
        start = done["at"] + F.char_length(_head(turn["role"], own(turn)))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"), F.when(own(turn), F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans")
        )

    folded = F.aggregate(F.sequence(F.lit(0), F.size("turns") - 1), F.struct(at.alias("at"), none.alias("spans")), add)
    return step.select(
        "conv_id",
        "participant",
        "block",
        "part",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.size(F.filter("turns", own)).cast("bigint").alias("n_own"),
        F.array_join("said", "").alias("text"),
        folded["spans"].alias("spans"),
    )
