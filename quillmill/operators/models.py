"""Model operators: contracts for what is plugged in, and deterministic stand-ins.

A model is built once for each Python worker by a factory and is fed Arrow batches in
pieces of the batch size that it asks for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import text as X

# Sampling weights of generation categories; the active ones sum to 1, and so do the inactive.
CATEGORIES = {"information-seeking": 0.05, "reasoning": 0.125, "planning": 0.05, "editing": 0.10, "coding": 0.125, "math": 0.125, "role-playing": 0.10, "data-analysis": 0.125, "creative-writing": 0.10, "advice-seeking": 0.05, "brainstorming": 0.05}
INACTIVE_CATEGORIES = {"format-constrain": 0.2, "rewrite": 0.1, "summary": 0.1, "safe": 0.1, "translate": 0.1, "doc-qa": 0.2, "everyday": 0.2}
FAILED = "no"

# Prompts in our own words; only their slots matter to the operators.
EDU_PROMPT = "Judge from 0 to 5 how much the following text would teach a pupil. Give reasons, then write 教育得分：<score>.\n\n{}"
STYLES = {
    "college": "Write a chapter of a college course that draws on: {}",
    "college_textbook": "Write a chapter of a college textbook on linear algebra.",
    "high_textbook": "Write a section of a high-school textbook that draws on: {}",
    "story": "Write a story that teaches what is in: {}",
    "self_story": "Write in the first person how someone came to learn what is in: {}",
    "baby": "Explain to a small child what is in: {}",
    "middle_edu": "Write a lesson for middle school that draws on: {}",
    "wikihow": "Write step-by-step instructions that draw on: {}",
}
JUDGE_PROMPTS = {
    "difficulty": 'How hard is this request? Answer with JSON {{"intent": "", "knowledge": "", "difficulty": ""}}.\n{query}',
    "score": 'How good is this request, from 0 to 5? Answer with JSON {{"score": ""}}.\n{query}',
    "classify": 'What is this request about? Answer with JSON {{"primary_tag": "", "other_tags": []}}.\n{query}',
}


class Scorer(Protocol):
    batch_size: int

    def score(self, texts: list[str]) -> Sequence[float]: ...


class Generator(Protocol):
    batch_size: int

    def generate(self, prompts: list[str]) -> Sequence[str]: ...


class Encoder(Protocol):
    batch_size: int

    def encode(self, texts: list[str]) -> Sequence[Sequence[float]]: ...


class Tokenizer(Protocol):
    def encode(self, text: str) -> list[int]: ...


def _unit(text: str, salt: str) -> float:
    return int.from_bytes(hashlib.sha256(f"{salt}\0{text}".encode()).digest()[:6], "big") / (1 << 48)


class HashScorer:
    """A score from 0 to 1 that depends on the text alone."""

    batch_size = 128

    def score(self, texts: list[str]) -> list[float]:
        return [_unit(t, "score") for t in texts]


class TemplateGenerator:
    """Replies of a fixed form, so that parsers have something to read."""

    batch_size = 64

    def generate(self, prompts: list[str]) -> list[str]:
        return [f"因此，教育得分：{int(_unit(p, 'edu') * 6)}" for p in prompts]


class HashEncoder:
    """A unit vector that depends on the text alone."""

    batch_size = 128

    def __init__(self, dim: int = 16) -> None:
        self.dim = dim

    def encode(self, texts: list[str]) -> list[list[float]]:
        rows = np.array([[_unit(t, str(k)) - 0.5 for k in range(self.dim)] for t in texts]).reshape(len(texts), self.dim)
        return (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)).tolist()


class WordTokenizer:
    def encode(self, text: str) -> list[int]:
        return [int.from_bytes(hashlib.md5(w.encode()).digest()[:3], "big") for w in text.split()]


def _fed(make: Callable, method: str, default):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for s in batches:
            out: list = []
            for k in range(0, len(s), model.batch_size):
                part = s.iloc[k : k + model.batch_size].fillna("").tolist()
                try:
                    out += list(getattr(model, method)(part))
                except Exception:
                    if default is None:
                        raise
                    out += [default] * len(part)
            yield pd.Series(out, dtype=object)

    return run


def scored(c: Column, make: Callable[[], Scorer]) -> Column:
    """The scorer's value of each text, each text once."""

    @F.pandas_udf("double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in _fed(make, "score", None)(batches):
            yield s.astype("float64")

    return udf(c)


def generated(c: Column, make: Callable[[], Generator], *, on_failure: str | None = None) -> Column:
    """The generator's reply to each prompt; a batch that fails gives ``on_failure``, if set."""

    @F.pandas_udf("string")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from _fed(make, "generate", on_failure)(batches)

    return udf(c)


def encoded(c: Column, make: Callable[[], Encoder], *, dtype: str = "float") -> Column:
    """The encoder's vector of each text, of 32 bits a number; as the encoder has them with ``dtype`` "double"."""

    @F.pandas_udf(f"array<{dtype}>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from _fed(make, "encode", None)(batches)

    return udf(c)


def tokenised(df: DataFrame, make: Callable[[], Tokenizer], *, text: str = "text", limit: int = 512) -> DataFrame:
    """Token ids in place of the text, ``limit`` at most; a null label's row is dropped."""

    @F.pandas_udf("array<int>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for s in batches:
            yield s.fillna("").map(lambda t: model.encode(t)[:limit])

    out = df.withColumn("input_ids", udf(F.col(text))).drop(text)
    return out.where(F.col("labels").isNotNull()) if "labels" in out.columns else out


def edu_judged(df: DataFrame, make: Callable[[], Generator], *, text: str = "text") -> DataFrame:
    """With ``edu_eval``, the judge's reply to the text's start, and ``score``, the digit in it."""
    prompt = X.one_turn_prompt(X.filled(EDU_PROMPT, X.truncated(F.col(text), 2000)))
    return df.withColumn("edu_eval", generated(prompt, make)).withColumn("score", X.edu_score(F.col("edu_eval")))


def regressor_scored(df: DataFrame, make: Callable[[], Scorer], *, text: str = "text") -> DataFrame:
    """With ``score`` and the marker ``new`` = 1."""
    return df.withColumn("score", scored(F.col(text), make)).withColumn("new", F.lit(1))


def textbook(df: DataFrame, make: Callable[[], Generator], *, style: str = "wikihow", limit: int = 800) -> DataFrame:
    """With ``data``: what the generator makes of the title and the start of the text."""
    body = X.titled(F.col("title"), F.col("text")) if "title" in df.columns else F.col("text")
    template = STYLES[style]
    prompt = X.filled(template, X.truncated(body, limit)) if "{}" in template else F.lit(template)
    return df.withColumn("data", X.without_nbsp(generated(X.one_turn_prompt(prompt), make)))


def chat_judged(df: DataFrame, make: Callable[[], Generator], *, query: str = "first_prompt") -> DataFrame:
    """With three replies: difficulty, score, classify; a batch that fails has the reply "no"."""
    for name, template in JUDGE_PROMPTS.items():
        prompt = X.one_turn_prompt(X.filled_by_name(template, query=F.col(query)))
        df = df.withColumn(f"{name}_reply", generated(prompt, make, on_failure=FAILED))
    return df


def uniform_draw(key: Column) -> Column:
    """A reproducible number in [0, 1) from a key, the same in any engine."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def drawn_category(u: Column, weights: dict[str, float] = CATEGORIES) -> Column:
    """The category whose share of [0, 1) has ``u``."""
    total, names, out = 0.0, list(weights), None
    for name in names[:-1]:
        total = round(total + weights[name], 9)
        out = F.when(u < total, name) if out is None else out.when(u < total, name)
    return F.lit(names[-1]) if out is None else out.otherwise(names[-1])


def conversation_seeds(spark, rows: int, weights: dict[str, float] = CATEGORIES, *, first: int = 0) -> DataFrame:
    """Exactly ``rows`` rows (id, system_prompt_key), categories by weight; ``first`` goes on where a run ended."""
    ids = spark.range(first, first + rows)
    return ids.withColumn("system_prompt_key", drawn_category(uniform_draw(F.col("id")), weights))


def conversations(seeds: DataFrame, make: Callable[[], Generator], prompts: DataFrame, *, turns: int = 3) -> DataFrame:
    """Seeds with conversations of ``turns`` turns of user and assistant; ``prompts`` (system_prompt_key, prompt) is a table of categories."""
    rows = seeds.join(F.broadcast(prompts), "system_prompt_key", "left")
    said = F.concat_ws("\n", F.coalesce("prompt", F.lit("")), F.col("id").cast("string"))
    parts = []
    for k in range(turns):
        for role in ("user", "assistant"):
            name = f"__{role}{k}"
            rows = rows.withColumn(name, generated(F.concat(said, F.lit(f"\n{role}")), make))
            said = F.concat_ws("\n", said, F.col(name))
            parts.append(F.struct(F.lit(role).alias("role"), F.col(name).alias("content")))
    return rows.select("id", "system_prompt_key", F.array(*parts).alias("conversation"))


def first_token_suppressed(suppressed: Sequence[int], penalty: float = -1e4) -> Callable[[Sequence[int], np.ndarray], np.ndarray]:
    """A logits processor for a generator: the given tokens can't come first."""

    def process(so_far: Sequence[int], logits: np.ndarray) -> np.ndarray:
        if not len(so_far):
            logits = logits.copy()
            logits[list(suppressed)] = penalty
        return logits

    return process


def trained_regressor(df: DataFrame, *, text: str = "text", labels: str = "labels", buckets: int = 1 << 14, steps: int = 20):
    """An offline stand-in for a fine-tuned regressor: hashed words and ridge regression, as a Spark ML pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import HashingTF, RegexTokenizer
    from pyspark.ml.regression import LinearRegression

    stages = [RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"\s+"), HashingTF(inputCol="__words", outputCol="__tf", numFeatures=buckets), LinearRegression(featuresCol="__tf", labelCol=labels, regParam=0.1, maxIter=steps, solver="l-bfgs", predictionCol="score")]
    return Pipeline(stages=stages).fit(df)
