"""Preference formatting of conversation pairs.

The longest common prefix of turns of the chosen and the rejected conversation is rendered once as prompt; what follows is
rendered as two completions, each with the character spans that training should score (the assistant's turns).

Everything is DataFrame functions. Turns meet in one row per pair of conversations, which is what is asked for; no other
group is collected, so common openings or conversations are no hot keys.

Defined cases: turns are ordered by number, ties by role and text; NULL role or text counts as empty in the rendering and
equals only NULL in the comparison; turns without a conversation belong to none and are in no pair; a conversation
without partner has a NULL partner and is all prompt; equal conversations have two empty completions; markers inside a text
are broken up by a space, so no turn can open another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SHUT = "<|im_start|>", "<|im_end|>"
TURN = "struct<turn:bigint,role:string,text:string>"


def _plain(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"<\|", "< |")


def render(turn: Column) -> Column:
    """One turn in chat markup."""
    return F.concat(F.lit(OPEN), _plain(turn["role"]), F.lit("\n"), _plain(turn["text"]), F.lit(SHUT + "\n"))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, render), "")


def scored_spans(turns: Column) -> Column:
    """[start, end) characters of each assistant turn's content and end marker in the rendered turns."""

    def add(state: Column, turn: Column) -> Column:
        size = F.length(render(turn)).cast("long")
        start = state["at"] + F.length(F.concat(F.lit(OPEN + "\n"), _plain(turn["role"])))
        end = state["at"] + size - 1
        mine = F.array(F.struct(start.cast("long").alias("start"), end.alias("end")))
        return F.struct(
            (state["at"] + size).alias("at"),
            F.when(turn["role"].eqNullSafe(F.lit("assistant")), F.concat(state["spans"], mine)).otherwise(state["spans"]).alias("spans"),
        )

    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return F.aggregate(turns, F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans")), add, lambda s: s["spans"])


def formatted(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair.

    turns: conv_id, turn, role, text. pairs: pair_id, conv_id, rejected (whether the conversation is the rejected one).
    Returns pair_id, chosen_id, rejected_id, n_common, prompt, chosen, rejected, chosen_spans, rejected_spans.
    """
    told = turns.select("conv_id", F.struct(F.col("turn").cast("long").alias("turn"), "role", "text").alias("t")).join(pairs, "conv_id")
    side = lambda no: F.sort_array(F.collect_list(F.when(F.col("rejected") == F.lit(no), F.col("t")))).cast(f"array<{TURN}>")
    name = lambda no: F.max(F.when(F.col("rejected") == F.lit(no), F.col("conv_id")))
    rows = told.groupBy("pair_id").agg(
        side(False).alias("c"), side(True).alias("r"), name(False).alias("chosen_id"), name(True).alias("rejected_id")
    )
    same = F.zip_with("c", "r", lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]) & x.isNotNull() & y.isNotNull())
    apart = F.array_position(F.transform(same, lambda x: F.coalesce(x, F.lit(False))), F.lit(False))
    alone = F.col("chosen_id").isNull() | F.col("rejected_id").isNull()
    both = F.greatest(F.size("c"), F.size("r"))
    n = F.when(alone, both).when(apart == 0, both).otherwise(apart - 1).cast("int")
    rows = rows.withColumn("n_common", n)
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c), F.lit(1)))
    first = F.when(F.col("chosen_id").isNull(), F.col("r")).otherwise(F.col("c"))
    return rows.select(
        "pair_id", "chosen_id", "rejected_id", "n_common",
        _joined(F.slice(first, F.lit(1), F.col("n_common"))).alias("prompt"),
        _joined(rest("c")).alias("chosen"), _joined(rest("r")).alias("rejected"),
        scored_spans(rest("c")).alias("chosen_spans"), scored_spans(rest("r")).alias("rejected_spans"),
    )


def neighbours(turns: DataFrame) -> DataFrame:
    """Pairs of conversations 2k (chosen) and 2k + 1 (rejected), for tables that state no preference."""
    ids = turns.select("conv_id").filter("conv_id is not null").distinct()
    return ids.select("conv_id", F.floor(F.col("conv_id") / 2).alias("pair_id"), (F.pmod("conv_id", F.lit(2)) == 1).alias("rejected"))
