"""The three corpus flows, composed of the operators; models are plugged in."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.functions import conversations as C
from quillmill.operators import dedup, models, select, similarity


def edu_corpus(docs: DataFrame, scorer: Callable[[], models.Scorer], *, order: Sequence[str], least: float = 0.4) -> DataFrame:
    """Web documents: scored, floored, banded, and of equal texts the first: one lazy plan."""
    scored = models.regressor_scored(select.text_named(docs), scorer)
    return dedup.keep_first(select.banded(select.score_floor(scored, least)), "text", order)


def textbook_corpus(seeds: DataFrame, generator: Callable[[], models.Generator], *, style: str = "wikihow") -> DataFrame:
    """Seed rows with generated textbook text in ``data``."""
    return models.textbook(select.text_named(seeds), generator, style=style)


def judged_chats(chats: DataFrame, judge: Callable[[], models.Generator], *, order: Sequence[str] = ("conv_id",)) -> DataFrame:
    """Conversations cleaned, one for each first prompt, with judges' replies parsed and incomplete ones dropped."""
    from quillmill.functions import judge as J
    from quillmill.functions.text import first_digit

    c = chats.withColumn("conversation", C.cleaned(C.conversation_of(chats))).where("conversation IS NOT NULL")
    c = c.withColumns({"first_prompt": C.first_prompt(F.col("conversation")), "first_answer": C.first_answer(F.col("conversation"))})
    c = models.chat_judged(dedup.keep_first(c, "first_prompt", order), judge)
    score = first_digit(J.json_value(F.col("score_reply"), "score", repair=True))
    difficulty = {k: J.json_value(F.col("difficulty_reply"), k) for k in ("difficulty", "intent", "knowledge")}
    tags = {"primary_tag": J.json_value(F.col("classify_reply"), "primary_tag"), "other_tags": J.json_list(F.col("classify_reply"), "other_tags")}
    c = c.withColumns(difficulty | tags | {"score": score})
    return select.without_nulls(c, "difficulty", "score", "primary_tag")


def chat_corpus(chats: DataFrame, encoder: Callable[[], models.Encoder], *, threshold: float | None = None, id_col: str = "conv_id", least_score: float | None = None) -> DataFrame:
    """Conversations cleaned and, category by category, without near neighbours of an earlier one."""
    c = chats.withColumn("conversation", C.cleaned(F.col("conversation"))).where("conversation IS NOT NULL")
    c = c.withColumn("first_prompt", C.first_prompt(F.col("conversation")))
    c = dedup.keep_first(c, "first_prompt", [id_col])
    c = c.withColumn("embedding", models.encoded(F.col("first_prompt"), encoder))
    near = similarity.nearest(c, 1, id_col=id_col, group="system_prompt_key")
    if threshold is None:
        limits = similarity.group_thresholds(c, ["system_prompt_key"], [id_col], has_document="document" in c.columns)
        own = c.select(F.col(id_col).alias("i"), "system_prompt_key")
        near = near.join(own, "i").join(limits, "system_prompt_key").where(F.col("score") > F.col("threshold"))
    out = similarity.similarity_dedup(c, near, -2.0 if threshold is None else threshold, id_col=id_col)
    return out if least_score is None else select.at_least(out, "score", least_score)
