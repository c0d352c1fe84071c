"""Preference pairs of conversations, formatted for training, in SQL functions only.

Chosen and rejected conversation share a prefix of whole turns. It is found turn by turn,
rendered once as the prompt, and what follows becomes two completions, each with a mask: the
spans on which a loss is taken, which are the assistant's own words and their end marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted

# Fixed values of the rendering.
OPEN, CLOSE, LINE = "<|im_start|>", "<|im_end|>", "\n"
LEARNED = "assistant"


def conversations(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, turns``: one row per conversation, an array of structs ``role, text`` in order.

    Rows without an id belong to no conversation. Rows that share a turn number are ordered by
    role and text, null first. A null role or text is rendered as empty. A conversation
    is one training text, so it is held whole, and only its own turns are.
    """
    row = F.struct(
        quoted(turn_col).alias("turn"),
        F.coalesce(quoted(role_col), F.lit("")).alias("role"),
        F.coalesce(quoted(text_col), F.lit("")).alias("text"),
    )
    some = turns.filter(quoted(id_col).isNotNull())
    held = some.groupBy(quoted(id_col).alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    said = F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text")))
    return held.select("conv_id", said.alias("turns"))


def render(turns: Column) -> Column:
    one = lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(LINE), t["text"], F.lit(CLOSE + LINE))
    return F.array_join(F.transform(turns, one), "")


def learned_spans(turns: Column) -> Column:
    """Spans of the rendered turns to learn, in code points: an assistant's text with its end mark."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    before = len(OPEN) + len(LINE)
    behind = len(CLOSE) + len(LINE)

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + before + F.length(t["role"])
        end = start + F.length(t["text"]) + len(CLOSE)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(t["role"] == LEARNED, F.concat(state["spans"], span)).otherwise(state["spans"])
        at = start + F.length(t["text"]) + behind
        return F.struct(at.alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.aggregate(turns, start, step, lambda state: state["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    differs = F.array_position(same, False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(a)).cast("int")


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Rows with arrays of turns ``chosen`` and ``rejected`` -> the same rows with texts and masks.

    ``n_prompt_turns, prompt`` and, for both sides, ``_completion`` and ``_spans`` (positions in the
    completion). Where one conversation is the start of the other, its completion is empty;
    equal ones have two empty completions. Null arrays count as empty. Other columns stay.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    sides = {s: F.coalesce(F.col(s), empty) for s in ("chosen", "rejected")}
    known = pairs.withColumns(sides).withColumn("n_prompt_turns", common_turns(F.col("chosen"), F.col("rejected")))
    shared = F.col("n_prompt_turns")
    out = known.withColumn("prompt", render(F.slice("chosen", F.lit(1), shared)))
    for side in sides:
        rest = F.slice(side, shared + 1, F.size(side) + 1)
        out = out.withColumn(f"{side}_completion", render(rest)).withColumn(f"{side}_spans", learned_spans(rest))
    return out.drop("chosen", "rejected")


def opening_pairs(held: DataFrame) -> DataFrame:
    """``conv_id, rejected_id, chosen, rejected``: of conversations with an equal first turn, the one
    with the smallest id is chosen against each other one. The number of pairs is that of the
    conversations at most."""
    first = held.withColumn("opening", F.sha2(F.to_json(F.col("turns")[0]), 256))
    leaders = first.groupBy("opening").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    leaders = leaders.filter("n > 1").drop("n")
    chosen = leaders.join(held.withColumnRenamed("turns", "chosen"), "conv_id")
    others = first.withColumnRenamed("conv_id", "rejected_id").withColumnRenamed("turns", "rejected")
    return chosen.join(others, "opening").filter("conv_id != rejected_id").drop("opening")


def stale_reply_pairs(held: DataFrame) -> DataFrame:
    """``conv_id, chosen, rejected``: a conversation up to the assistant's last reply, against the
    same with the assistant's reply before that in its place."""
    n = F.size("turns")
    at = F.filter(F.sequence(F.lit(1), n), lambda i: F.get("turns", i - 1)["role"] == LEARNED)
    placed = held.filter(n > 0).withColumn("at", at).filter(F.size("at") >= 2)
    last, before = F.element_at("at", -1), F.element_at("at", -2)
    chosen = F.slice("turns", F.lit(1), last)
    rejected = F.concat(F.slice("turns", F.lit(1), last - 1), F.slice("turns", before, F.lit(1)))
    return placed.select("conv_id", chosen.alias("chosen"), rejected.alias("rejected"))
