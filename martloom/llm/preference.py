"""Preference formatting: one shared prompt and two masked completions per pair of conversations.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed by the format: how a turn is rendered.
OPEN, AFTER_ROLE, CLOSE = "<|", "|>\n", "<|end|>\n"
TRAINED_ROLE = "assistant"


def gather_turns(turns: DataFrame, pair: str, name: str) -> DataFrame:
    """One row per conversation: its turns (role, text) in order of ``turn``, then role and text.

    Rows without a conversation id are left out; equal rows count once; NULL roles and texts
    count as empty; NULL turn numbers come first. A conversation is one row of the result, so its
    turns meet in one place; what one conversation can hold is bounded by what a row can.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    rows = turns.where(F.col(pair).isNotNull()).select(F.col(pair).alias("pair_id"), turn.alias("t"))
    gathered = rows.groupBy("pair_id").agg(F.array_sort(F.collect_set("t")).alias("t"))
    return gathered.select(
        "pair_id",
        F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias(name),
    )


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(AFTER_ROLE), turn["text"], F.lit(CLOSE))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def trained_spans(turns: Column) -> Column:
    """``start, end`` (characters, end exclusive) of what a completion is trained on: the text
    and the closing mark of the assistant's turns. The rest is masked."""
    step = lambda acc, t: F.struct(
        (acc["at"] + F.length(_rendered(t))).alias("at"),
        F.when(
            t["role"] == TRAINED_ROLE,
            F.concat(
                acc["spans"],
                F.array(
                    F.struct(
                        (acc["at"] + F.length(F.concat(F.lit(OPEN), t["role"], F.lit(AFTER_ROLE)))).alias("start"),
                        (acc["at"] + F.length(_rendered(t))).alias("end"),
                    )
                ),
            ),
        )
        .otherwise(acc["spans"])
        .alias("spans"),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two turn arrays."""
    shorter = F.least(F.size(a), F.size(b))
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, shorter).cast("int")


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row per pair: ``pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_spans,
    rejected_spans``.

    ``chosen`` and ``rejected`` hold one row per pair with its turns in a column of that name
    (see ``gather_turns``); a pair needs both. The longest common prefix of turns is rendered once
    as the prompt; what follows on either side is a completion, with the spans that are trained
    on. Equal conversations have everything in the prompt and empty completions; conversations
    that differ from the first turn on have an empty prompt. Pairs with a NULL id are left out.
    """
    both = chosen.select("pair_id", "chosen").join(rejected.select("pair_id", "rejected"), "pair_id")
    both = both.withColumn("n", common_turns(F.col("chosen"), F.col("rejected")))
    rest = lambda c: F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    both = both.select(
        "pair_id",
        F.col("n").alias("n_prompt_turns"),
        F.slice("chosen", F.lit(1), F.col("n")).alias("p"),
        rest(F.col("chosen")).alias("c"),
        rest(F.col("rejected")).alias("r"),
    )
    return both.select(
        "pair_id",
        "n_prompt_turns",
        render(F.col("p")).alias("prompt"),
        render(F.col("c")).alias("chosen"),
        render(F.col("r")).alias("rejected"),
        trained_spans(F.col("c")).alias("chosen_spans"),
        trained_spans(F.col("r")).alias("rejected_spans"),
    )


def with_earlier_reply(gathered: DataFrame) -> DataFrame:
    """A rejected partner for each conversation: the same turns, but the last reply repeats the
    conversation's first one, or is empty if there is no other. Conversations without a reply
    have no partner."""
    turns = F.col("chosen")
    numbered = F.transform(turns, lambda t, i: F.struct(i.alias("i"), t["role"].alias("role"), t["text"].alias("text")))
    replies = F.filter(numbered, lambda t: t["role"] == TRAINED_ROLE)
    rows = gathered.withColumn("replies", replies).where(F.size("replies") > 0)
    rows = rows.withColumn("last", F.element_at("replies", -1)["i"]).withColumn(
        "worse", F.when(F.size("replies") > 1, F.element_at("replies", 1)["text"]).otherwise("")
    )
    changed = F.transform(
        turns,
        lambda t, i: F.struct(
            t["role"].alias("role"),
            F.when(i == F.col("last"), F.col("worse")).otherwise(t["text"]).alias("text"),
        ),
    )
    return rows.select("pair_id", changed.alias("rejected"))
