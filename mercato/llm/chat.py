"""Preference formatting of chosen and rejected conversations [native].

Two conversations of a pair are compared turn by turn: their longest common
prefix of turns is the prompt and is rendered once; the remaining turns of each
side are its completion. Every turn becomes one row of rendered text with a
``trained`` flag: only assistant turns of a completion are trained on, all other
turns are masked.

The comparison is a full join on (pair, position) and one aggregate per pair, so
a conversation of any length is never collected into one row; its turns are
spread over tasks. Prompts, completions and spans are read off by ordering rows
by (pair_id, side, position). Everything is DataFrame functions.

Defined cases:

* rows without a pair, a side or a turn number have no place and are left out;
* a null role is rendered as ``unknown``, a null text as empty text;
* rows of one conversation and turn that are equal count once; different rows of
  one turn are ordered by role, then text, and take consecutive places of it;
* a conversation without a partner has an empty prompt, and its turns are its
  completion; when one side is a prefix of the other, its completion is empty;
* equal conversations are all prompt and nothing is trained;
* columns other than the four named ones are not read; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHOSEN, REJECTED, PROMPT = "chosen", "rejected", "prompt"


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def with_borrowed_replies(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    reply_role: str = "assistant",
) -> DataFrame:
    """Conversations as chosen sides, and a rejected side for each: the same
    turns, but for the last reply, which is the last reply of the conversation
    with the next id (none where there is no such reply)."""
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    ).filter("conv_id is not null and turn is not null")
    last = (
        rows.filter(F.col("role") == reply_role)
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("reply"))
    )
    lent = last.select((F.col("conv_id") - 1).alias("conv_id"), F.col("reply.text").alias("text"))
    own = last.select("conv_id", F.col("reply.turn").alias("last_turn"))
    kept = (
        rows.join(own, "conv_id", "left")
        .filter(~(F.col("role").eqNullSafe(F.lit(reply_role)) & (F.col("turn") == F.col("last_turn"))) | F.col("last_turn").isNull())
        .select("conv_id", "turn", "role", "text")
    )
    borrowed = own.join(lent, "conv_id").select("conv_id", F.col("last_turn").alias("turn"), F.lit(reply_role).alias("role"), "text")
    return rows.withColumn("chosen", F.lit(True)).unionByName(kept.unionByName(borrowed).withColumn("chosen", F.lit(False)))


def preference_turns(
    turns: DataFrame,
    pair_of: Column,
    chosen: Column,
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """One row per rendered turn: pair_id, segment (prompt, chosen or
    rejected), turn, place (0 unless rows share a turn), role, content
    (rendered), trained.

    ``pair_of`` names the pair of a turn and ``chosen`` tells its side.
    """
    rows = (
        turns.select(
            pair_of.alias("pair_id"),
            F.when(chosen, CHOSEN).when(~chosen, REJECTED).alias("side"),
            F.col(turn_col).cast("long").alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        )
        .filter("turn is not null and pair_id is not null and side is not null")
        .distinct()
    )
    # place of a row among the different rows of its turn
    of_turn = Window.partitionBy("pair_id", "side", "turn").orderBy("role", "text")
    rows = rows.withColumn("place", F.row_number().over(of_turn) - 1)
    at = ["pair_id", "turn", "place"]
    ours = rows.filter(F.col("side") == CHOSEN).select(*at, F.struct("role", "text").alias(CHOSEN))
    theirs = rows.filter(F.col("side") == REJECTED).select(*at, F.struct("role", "text").alias(REJECTED))
    both = ours.join(theirs, at, "full")
    # the first place where the sides differ ends the common prefix
    split = (
        both.filter(~F.col(CHOSEN).eqNullSafe(F.col(REJECTED)))
        .groupBy("pair_id")
        .agg(F.min(F.struct("turn", "place")).alias("split"))
    )
    in_prompt = F.col("split").isNull() | (F.struct("turn", "place") < F.col("split"))
    sides = F.when(in_prompt, F.array(F.struct(F.lit(PROMPT).alias("segment"), F.col(CHOSEN).alias("row")))).otherwise(
        F.array(
            F.struct(F.lit(CHOSEN).alias("segment"), F.col(CHOSEN).alias("row")),
            F.struct(F.lit(REJECTED).alias("segment"), F.col(REJECTED).alias("row")),
        )
    )
    return (
        both.join(split, "pair_id", "left")
        .select("pair_id", "turn", "place", F.inline(sides))
        .filter("row is not null")
        .select(
            "pair_id",
            "segment",
            "turn",
            F.col("place").cast("long").alias("place"),
            "row.role",
            render(F.col("row.role"), F.col("row.text")).alias("content"),
            ((F.col("row.role") == trained_role) & (F.col("segment") != PROMPT)).alias("trained"),
        )
    )
