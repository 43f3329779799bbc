"""Conversations: arrays of (role, content), and padded label lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.text import clean_turn

LEAST_TURN = 3


def conversation_of(df: DataFrame) -> Column:
    """The conversation column, or one made of instruction and response where that is missing."""
    has = set(df.columns)
    if "conversation" in has:
        return F.col("conversation")
    if {"instruction", "response"} <= has:
        turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
        return F.array(turn("user", "instruction"), turn("assistant", "response"))
    raise ValueError("neither conversation nor instruction and response")


def from_turns(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", content: str = "text") -> DataFrame:
    """Rows of turns as one row for each conversation, its turns in order."""
    packed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(role).alias("role"), F.col(content).alias("content"))))
    return turns.groupBy(key).agg(F.transform(packed, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("conversation"))


def cleaned(conversation: Column) -> Column:
    """The turns cleaned; null if any is then shorter than three characters."""
    clean = F.transform(conversation, lambda x: F.struct(x["role"].alias("role"), clean_turn(x["content"]).alias("content")))
    short = F.exists(clean, lambda x: F.length(F.coalesce(x["content"], F.lit(""))) < LEAST_TURN)
    return F.when(~short, clean)


def first_prompt(conversation: Column) -> Column:
    """The content of the first turn, whatever its role; null of an empty list."""
    return F.get(conversation, 0)["content"]


def first_answer(conversation: Column) -> Column:
    """The content of the second turn; null if there is none."""
    return F.get(conversation, 1)["content"]


def turn_pairs(conversation: Column) -> Column:
    """Turns divided by two, as a double."""
    return F.size(conversation) / F.lit(2.0)


def padded(labels: Column, size: Column, *, left: bool = False, fill: int = -100) -> Column:
    """A list filled up to ``size`` on one side."""
    extra = F.array_repeat(F.lit(fill).cast("double"), F.greatest(size - F.size(labels), F.lit(0)).cast("int"))
    return F.concat(extra, labels) if left else F.concat(labels, extra)
