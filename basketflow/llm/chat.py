"""Preference pairs: one prompt, two masked completions.

The prompt is the longest common prefix of turns of the chosen and the
rejected conversation, rendered once. What follows is rendered per side; a
mask tells the turns to learn from (the assistant's) from the others. Only
DataFrame expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "<|{role}|>\n{text}<|end|>\n"


def rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def conversation(turns: DataFrame, key: str) -> DataFrame:
    """(key, turns) with the turns of each conversation in order. A null role
    or text counts as empty; turns of equal number are ordered by role and
    text, and one that repeats stays repeated. Turns without conversation or
    number belong nowhere and are left out."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    placed = turns.filter(F.col(key).isNotNull() & F.col("turn").isNotNull())
    return placed.groupBy(key).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def common_turns(a: Column, b: Column) -> Column:
    """How many leading turns agree in role and text."""
    most = F.least(F.size(a), F.size(b))
    differ = F.filter(
        F.sequence(F.lit(1), most),
        lambda i: (F.get(a, i - 1)["role"] != F.get(b, i - 1)["role"])
        | (F.get(a, i - 1)["text"] != F.get(b, i - 1)["text"]),
    )
    return F.when(most == 0, 0).otherwise(F.coalesce(F.get(differ, F.lit(0)) - 1, most))


def format_preferences(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """One row per key of either side, both given as turns (key, turn, role, text).

    Columns: key, prompt_turns, prompt; and for each side the completion text
    and its mask, an array of (length, learn) whose lengths add up to the
    completion's. A side that is missing is an empty conversation: the prompt
    is then empty and the other side all completion."""
    none = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    left = conversation(chosen, key).select(key, F.col("turns").alias("a"))
    right = conversation(rejected, key).select(key, F.col("turns").alias("b"))
    both = left.join(right, key, "full").select(
        key, F.coalesce("a", none).alias("a"), F.coalesce("b", none).alias("b")
    )
    shared = both.withColumn("prompt_turns", common_turns(F.col("a"), F.col("b")))

    def text(turns: Column) -> Column:
        return F.array_join(F.transform(turns, rendered), "")

    def rest(side: str) -> Column:
        return F.slice(F.col(side), F.col("prompt_turns") + 1, F.size(side))

    def mask(turns: Column) -> Column:
        return F.transform(
            turns,
            lambda t: F.struct(
                F.length(rendered(t)).cast("bigint").alias("length"), (t["role"] == "assistant").alias("learn")
            ),
        )

    return shared.select(
        key,
        F.col("prompt_turns").cast("bigint"),
        text(F.slice("a", F.lit(1), F.col("prompt_turns"))).alias("prompt"),
        text(rest("a")).alias("chosen"),
        mask(rest("a")).alias("chosen_mask"),
        text(rest("b")).alias("rejected"),
        mask(rest("b")).alias("rejected_mask"),
    )


def swapped_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chosen, rejected) turns out of plain conversations.

    Each conversation is chosen as it is. Its rejected form is the same up to
    its last assistant turn, where the last assistant turn of its neighbour
    (conv_id with the lowest bit flipped) stands instead, and ends there. A
    conversation that or whose neighbour has no assistant turn is rejected as
    it stands up to there, without an answer."""
    turns = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text").filter(
        F.col("pair_id").isNotNull() & F.col("turn").isNotNull()
    )
    answers = turns.filter(F.col("role") == "assistant").groupBy("pair_id")
    last = answers.agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last"))
    before = (
        turns.join(last.select("pair_id", F.col("last.turn").alias("until")), "pair_id", "left")
        .filter(F.col("until").isNull() | (F.col("turn") < F.col("until")))
        .select("pair_id", "turn", "role", "text")
    )
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("last.text").alias("text"))
    answer = last.join(other, "pair_id").select(
        "pair_id", F.col("last.turn").alias("turn"), F.lit("assistant").alias("role"), "text"
    )
    return turns, before.unionByName(answer)
