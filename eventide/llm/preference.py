"""Preference formatting: one prompt, two masked completions.

A pair names a chosen and a rejected conversation. Their longest common prefix
of turns (equal role and text) is rendered once as the prompt; the rest of
each is its completion, with the character spans a loss counts: the assistant
turns' texts and their end marks. All of it is column expressions; the turns of
a conversation are gathered once and each conversation is shuffled to its pair.

Defined results: rows with a null conv_id belong to no conversation; turns are
ordered by (turn, role, text), nulls first; a null role is ``user`` and a null
text is empty; exactly repeated rows are one turn; a conversation without a
partner makes no pair; equal conversations have empty completions; the start
and end marks inside a text or role are broken by a space so that they cannot open
or close a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks around a turn.
START, END = "<|im_start|>", "<|im_end|>"


def _plain(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit(START), F.lit("<| im_start|>"))
    return F.replace(out, F.lit(END), F.lit("<| im_end|>"))


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, turns: the rendered pieces of each conversation in order."""
    rows = turns.where("conv_id is not null").select(
        "conv_id", F.col("turn").alias("t"), _plain(F.coalesce("role", F.lit("user"))).alias("role"),
        _plain(F.col("text")).alias("text"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_set(F.struct("t", "role", "text"))).alias("turns"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))), "")


def loss_spans(turns: Column) -> Column:
    """(start, end) character spans of the assistant turns in their rendering."""
    head = (lambda t: F.lit(len(START) + 1) + F.length(t["role"]))
    body = (lambda t: F.length(t["text"]) + len(END))
    span = (lambda a, t: F.when(t["role"] == "assistant", F.array(F.struct(
        (a["at"] + head(t)).alias("start"), (a["at"] + head(t) + body(t)).alias("end"))))
        .otherwise(F.array().cast("array<struct<start:int,end:int>>")))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return F.aggregate(turns, first, lambda a, t: F.struct(
        (a["at"] + head(t) + body(t) + 1).alias("at"), F.concat(a["spans"], span(a, t)).alias("spans")),
        lambda a: a["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of turns."""
    shorter = F.least(F.size(a), F.size(b))
    same = (lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    differs = F.filter(F.sequence(F.lit(0), shorter), lambda i: (i == shorter) | ~same(F.get(a, i), F.get(b, i)))
    return F.get(differs, F.lit(0))


def preference_rows(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair (chosen_id, rejected_id) whose conversations exist."""
    conv = conversations(turns)
    both = pairs.select("chosen_id", "rejected_id").join(
        conv.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c")), "chosen_id").join(
        conv.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("r")), "rejected_id")
    return formatted(both)


def formatted(both: DataFrame) -> DataFrame:
    """Rows (chosen_id, rejected_id, c, r) with their prompt and completions."""
    n = F.col("n_common")
    rest = (lambda t: F.slice(t, n + 1, F.greatest(F.size(t) - n, F.lit(0))))
    return both.withColumn("n_common", common_turns(F.col("c"), F.col("r"))).select(
        "chosen_id", "rejected_id", F.col("n_common").cast("long").alias("n_prompt_turns"),
        render(F.slice("c", F.lit(1), n)).alias("prompt"),
        render(rest(F.col("c"))).alias("chosen"), loss_spans(rest(F.col("c"))).alias("chosen_spans"),
        render(rest(F.col("r"))).alias("rejected"), loss_spans(rest(F.col("r"))).alias("rejected_spans"))


def neighbour_preferences(turns: DataFrame) -> DataFrame:
    """Pairs conversation 2k (chosen) with 2k + 1 (rejected), k of any sign."""
    conv = conversations(turns).select(
        F.shiftright("conv_id", 1).alias("pair"), F.pmod("conv_id", F.lit(2)).alias("side"), "conv_id", "turns")
    one = (lambda side, col: F.first(F.when(F.col("side") == side, F.col(col)), ignorenulls=True))
    both = conv.groupBy("pair").agg(
        one(0, "conv_id").alias("chosen_id"), one(1, "conv_id").alias("rejected_id"),
        one(0, "turns").alias("c"), one(1, "turns").alias("r")).where("c is not null and r is not null")
    return formatted(both)
