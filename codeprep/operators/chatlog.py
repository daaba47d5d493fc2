"""Replaying chat logs: commands, turn counter, last answer, saves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeprep.functions.prompts import generate_prompt
from codeprep.functions.text import computed_once, strip

# The chat commands, matched whole and without regard to case.
QUIT_COMMANDS = ("/quit", "/exit", "/q")
CLEAR_COMMAND = "/clear"
SAVE_COMMAND = "/save"

# Turn numbers per block; one task replays a block, not a whole conversation.
BLOCK_TURNS = 4096


def classify(user_input: Column) -> Column:
    """blank, quit, clear, save or ask."""
    text = F.lower(strip(user_input))
    return (
        F.when(text == "", "blank")
        .when(text.isin(*QUIT_COMMANDS), "quit")
        .when(text == CLEAR_COMMAND, "clear")
        .when(text == SAVE_COMMAND, "save")
        .otherwise("ask")
    )


def replay(log: DataFrame) -> DataFrame:
    """State of each conversation after every user turn up to its end.

    ``log`` has (conv_id, turn, role, text), one row per (conv_id, turn); the
    answer to turn t is the assistant turn t + 1. Assistant turns that follow
    something else answer nothing. Blank turns do nothing; nothing after the
    first quit counts. ``turn_count`` is the number of answered asks since the
    last clear; ``last_response`` outlives a clear.

    State is carried in two levels: within blocks of turns, and from block to
    block over one summary row per block, so one endless conversation spreads
    over many tasks. An answer is put in the block of its question. Both
    levels read the same shuffle.
    """
    block = ["conv_id", "block"]
    is_user = F.col("role") == "user"
    asked_at = F.when(is_user, F.col("turn")).otherwise(F.col("turn") - 1)
    in_order = Window.partitionBy(*block).orderBy("turn")
    is_answer = (F.lead("role").over(in_order) == "assistant") & (
        F.lead("turn").over(in_order) == F.col("turn") + 1
    )
    is_answered = (F.col("command") == "ask") & F.col("response").isNotNull()
    inputs = (
        log.filter(
            F.col("role").isin("user", "assistant")
            & F.col("conv_id").isNotNull()
            & F.col("turn").isNotNull()
        )
        .withColumn("block", F.floor(asked_at / BLOCK_TURNS))
        .withColumn("response", F.when(is_answer, F.lead("text").over(in_order)))
        .filter(is_user)
        .transform(lambda rows: computed_once(rows, {"command": classify(F.col("text"))}))
        .filter(F.col("command") != "blank")
        .withColumn("answer", F.when(is_answered, F.col("response")))
        .withColumn("answered", is_answered.cast("bigint"))
        .withColumn("quit", (F.col("command") == "quit").cast("bigint"))
    )
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = inputs.withColumns(
        {
            "quits": F.sum("quit").over(so_far),
            "asks": F.sum("answered").over(so_far),
            "latest": F.last("answer", ignorenulls=True).over(so_far),
        }
    ).withColumn("asks_at_clear", F.when(F.col("command") == "clear", F.col("asks")))
    local = local.withColumn("cleared_at", F.max("asks_at_clear").over(so_far))

    ends = local.groupBy(*block).agg(
        F.sum("quit").alias("block_quits"),
        F.sum("answered").alias("block_asks"),
        F.max("asks_at_clear").alias("block_cleared_at"),
        F.max(F.when(F.col("answered") == 1, F.struct("turn", "answer"))).alias("block_latest"),
    )
    earlier = (
        Window.partitionBy("conv_id")
        .orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = ends.withColumn(
        "asks_before", F.coalesce(F.sum("block_asks").over(earlier), F.lit(0))
    ).select(
        *block,
        "asks_before",
        F.coalesce(F.sum("block_quits").over(earlier), F.lit(0)).alias("quits_before"),
        F.coalesce(
            F.max(F.col("asks_before") + F.col("block_cleared_at")).over(earlier), F.lit(0)
        ).alias("cleared_before"),
        F.last("block_latest.answer", ignorenulls=True).over(earlier).alias("latest_before"),
    )
    # A quit ends the session after its own row. Every block has a start; the
    # outer join and the coalesce only keep the two plans alike for their shuffle.
    earlier_quits = F.coalesce("quits_before", F.lit(0)) + F.col("quits") - F.col("quit")
    alive = earlier_quits == 0
    cleared = F.greatest("cleared_before", F.col("asks_before") + F.col("cleared_at"))
    return (
        local.join(starts, block, "left")
        .filter(alive)
        .select(
            "conv_id",
            "turn",
            "command",
            (F.col("asks_before") + F.col("asks") - cleared).alias("turn_count"),
            F.coalesce("latest", "latest_before", F.lit("")).alias("last_response"),
        )
    )


def asked_prompts(log: DataFrame) -> DataFrame:
    """The prompt of every ask in a session, as (conv_id, turn, prompt).

    Asks after the end of a session, blank turns and commands have none.
    """
    asks = replay(log).filter(F.col("command") == "ask").select("conv_id", "turn")
    said = log.filter(F.col("role") == "user").select("conv_id", "turn", "text")
    return asks.join(said, ["conv_id", "turn"]).select(
        "conv_id", "turn", generate_prompt(F.col("text")).alias("prompt")
    )


def saves(states: DataFrame) -> DataFrame:
    """What each save command writes, with a file name per conversation and turn."""
    has_answer = F.col("last_response") != ""
    return states.filter(F.col("command") == "save").select(
        "conv_id",
        "turn",
        F.when(has_answer, F.format_string("chat_%d_%d.py", "conv_id", "turn")).alias("file_name"),
        F.when(has_answer, F.col("last_response")).alias("content"),
        F.when(has_answer, "saved").otherwise("nothing to save").alias("outcome"),
    )
