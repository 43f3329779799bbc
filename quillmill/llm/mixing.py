"""Soft-membership mixing of a corpus to target weights.

A softmax classifier over hashed byte trigrams, learned from the labelled rows, gives each
document a posterior over the domains.  Rates, one for each document, are then fitted so
that the expected tokens of each domain, the sum over documents of rate times tokens
times posterior, match the targets in the least-squares sense:

    minimise  1/2 sum_k (S_k(r) - b_k)^2 / c_k   over r >= floor,
    S_k(r) = sum_d r_d t_d p_dk,   c_k = sum_d t_d p_dk

by projected gradient descent in the norm that weighs each rate with its tokens.  In it
the gradient is p_d . (S - b) / c, with Lipschitz constant at most 1 (c are the row sums
of the Gram matrix), so that the step length is 1.  Every iteration is one pass over a
table of tokens and posteriors that returns a number for each domain.  A rate is a
function of the posterior and of the gradients so far, so rates are never stored or
joined: they are worked out where they are used.

A rate r makes floor(r) copies of its document and one more with the probability of the
rest, drawn by a hash of id and text: the same draw on every run.

Defined cases: a null or empty text has the classifier's prior and no tokens, and its
rate follows its posterior.  A domain without labelled rows (or with none short enough to
learn from) can't be predicted: a target for it is an error, as are negative or all-zero
weights.  Only the built-in targets leave out domains that have no documents at all, with a
warning.  A learned domain without a target has the target 0.  Without labelled rows there
are no domains, and without targets nothing to meet: every rate is 1.  Empty tables give
empty results.  Repeated rows have equal rates and equal draws.  Other columns pass through.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.flat import bounded_sample, fresh, map_arrow, slices, sums, words
from quillmill.staging import drop, stage

BITS = 14
SAMPLE_ROWS = 2000
SAMPLE_BYTES = 16 << 20
EACH = 40


@dataclass(frozen=True)
class Domains:
    """A classifier: domain names, weights (bucket, domain), biases."""

    names: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray


def _trigrams(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.uint32)
    h = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA6B) + x[2:] * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(32 - BITS)).astype(np.int32)


def learn(texts: list[str], labels: list[str], *, epochs: int = 12, rate: float = 20.0, seed: int = 3) -> Domains:
    """Softmax regression on trigram shares by stochastic gradient descent."""
    names = tuple(sorted(set(labels)))
    y = np.array([names.index(x) for x in labels], np.int64)
    rows = []
    for _, raw, at in (p for t in texts for p in slices(pa.array([t], pa.large_string()), 1 << 62)):
        u, c = np.unique(_trigrams(raw), return_counts=True) if len(raw) > 2 else (np.zeros(0, np.int32), np.zeros(0))
        rows.append((u, c / max(1, c.sum())))
    weights, bias = np.zeros((1 << BITS, len(names))), np.log(np.bincount(y, minlength=len(names)) / max(1, len(y)) + 1e-9)
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        for i in rng.permutation(len(y)):
            u, share = rows[i]
            z = share @ weights[u] + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            weights[u] -= rate * (1 - epoch / epochs) * share[:, None] * p
    return Domains(names, weights.astype(np.float32), bias)


def posteriors(column: pa.Array, d: Domains) -> tuple[np.ndarray, np.ndarray]:
    """(documents, domains) probabilities, and the number of words of each."""
    out, tokens = np.zeros((len(column), len(d.names))), np.zeros(len(column), np.int64)
    for i, raw, at in slices(column):
        n = len(at) - 1
        tokens[i : i + n] = np.diff(words(raw, at)[2])
        if not d.names:
            continue
        z = np.tile(d.bias, (n, 1))
        if len(raw) > 2:
            ids, last = _trigrams(raw), np.maximum(at[1:] - 2, at[:-1])
            first = np.minimum(at[:-1], last)
            for k in range(len(d.names)):
                z[:, k] += sums(d.weights[:, k][ids], first, last) / np.maximum(last - first, 1)
        p = np.exp(z - z.max(1, keepdims=True))
        out[i : i + n] = p / p.sum(1, keepdims=True)
    return out, tokens


def fit_domains(
    docs: DataFrame,
    labels: DataFrame,
    *,
    domain_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
) -> Domains:
    """Learns from labelled rows (those with an id in ``labels``).

    At most ``sample_rows`` whole texts of ``sample_bytes`` together, in the order of a hash of the id, but the first
    EACH rows of every labelled domain before all others, so that a rare one is learned too.
    """
    ids = labels.select(F.col(id_col).alias("_id")).where("_id IS NOT NULL").distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_t"), F.col(domain_col).cast("string").alias("_y")).where("_y IS NOT NULL")
    found = bounded_sample(rows, ids, rows_most=sample_rows, bytes_most=sample_bytes, seed=11, each=EACH)
    return learn([t for t, _ in found], [y for _, y in found])


def members(docs: DataFrame, d: Domains, *, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns with ``tokens`` and ``posterior``."""
    shared = docs.sparkSession.sparkContext.broadcast(d)
    source = docs.select(*[F.col(f"`{c}`") for c in (carry or [])], F.col(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, tokens = posteriors(b.column(b.num_columns - 1), shared.value)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(tokens), pa.array(list(p), pa.list_(pa.float64()))], names=[*b.schema.names[:-1], "tokens", "posterior"])

    return map_arrow(source, run, T.StructType([*source.schema.fields[:-1], T.StructField("tokens", T.LongType()), T.StructField("posterior", T.ArrayType(T.DoubleType()))]))


def fold_rates(p: np.ndarray, gradients: list[np.ndarray], floor: float) -> np.ndarray:
    """The rates after the steps so far, all having begun at 1 (or the floor if that is higher)."""
    r = np.full(len(p), max(1.0, floor))
    for g in gradients:
        r = np.maximum(floor, r - p @ g)
    return r


@dataclass(frozen=True)
class Fit:
    """Steps of the descent, the tokens of each domain (as they are, as asked for, as fitted), and whether these meet."""

    gradients: tuple[np.ndarray, ...]
    floor: float
    natural: np.ndarray
    target: np.ndarray
    fitted: np.ndarray
    converged: bool = True


def fit_rates(
    table: DataFrame, names: tuple[str, ...], weights: dict[str, float], *, floor: float = 0.0, total: float | None = None, steps: int = 40, tolerance: float = 1e-3
) -> Fit:
    """Fits rates over ``table`` (tokens, posterior) until every domain is within ``tolerance`` of the total.

    ``total``: tokens asked for; by default those that there are, or with a floor the
    fewest with which no domain needs less than its floor.  Where a floor stands in the way of
    a target, the descent ends at the least squares there are: when a step moves no domain by
    a tenth of the tolerance.  ``converged`` of the result says whether either end was reached
    within ``steps``; if not, there is a warning too.
    """
    if not names or not weights:
        return Fit((), floor, np.zeros(0), np.zeros(0), np.zeros(0))
    if unknown := set(weights) - set(names):
        raise ValueError(f"no labelled rows of {sorted(unknown)}")
    w = np.array([weights.get(n, 0.0) for n in names])
    if (w < 0).any() or not w.sum() > 0:
        raise ValueError("weights are non-negative and not all zero")
    w = w / w.sum()
    source = table.select("tokens", "posterior")

    def sums_at(gradients: list[np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            s = np.zeros(len(names))
            for b in batches:
                if b.num_rows:
                    p = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                    s += (b.column(0).to_numpy() * fold_rates(p, gradients, floor)) @ p
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(s), dtype=np.int32)), pa.array(s)], names=["k", "s"])

        rows = source.mapInArrow(run, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
        out = np.zeros(len(names))
        for k, s in rows:
            out[k] = s
        return out

    first = sums_at([])
    natural = first / max(1.0, floor)
    if total is None:
        total = natural.sum() if floor <= 0 else max((floor * c / x for c, x in zip(natural, w, strict=True) if x > 0), default=0.0)
    target, gradients, now = w * total, [], first

    def met() -> bool:
        return bool(np.abs(now - target).max() <= tolerance * max(total, 1e-9))

    still = False
    while not (met() or still) and len(gradients) < steps:
        gradients.append((now - target) / np.maximum(natural, 1e-9) * (natural > 0))
        before, now = now, sums_at(gradients)
        still = bool(np.abs(now - before).max() <= 0.1 * tolerance * max(total, 1e-9))
    if not (met() or still):
        warnings.warn(f"after {steps} steps the tokens by domain are {now.round()} and not {target.round()}", stacklevel=2)
    return Fit(tuple(gradients), floor, natural, target, now, met() or still)


def with_rates(docs: DataFrame, d: Domains, fit: Fit, *, text_col: str = "text", rate: str = "rate") -> DataFrame:
    """The rows of ``docs``, all columns, with their rate, which replaces a column of that name."""
    docs = docs.drop(rate)
    shared = docs.sparkSession.sparkContext.broadcast((d, fit))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, fit = shared.value
        for b in batches:
            r = fold_rates(posteriors(b.column(at), d)[0], fit.gradients, fit.floor)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(r)], names=[*b.schema.names, rate])

    return map_arrow(docs, run, T.StructType([*docs.schema.fields, T.StructField(rate, T.DoubleType())]))


def copies(rate: Column, *key: Column) -> Column:
    """floor(rate), and one more with the probability of the rest, by a hash of ``key``."""
    u = F.pmod(F.xxhash64(*key, F.lit(29)), F.lit(1 << 40)) / float(1 << 40)
    return (F.floor(rate) + (u < rate - F.floor(rate)).cast("int")).cast("int")


TARGETS = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}


def default_targets(docs: DataFrame, domain_col: str = "lang") -> dict[str, float]:
    """TARGETS of the domains that ``docs`` has rows of; for the others, which no rate can meet, there is a warning."""
    there = {r[0] for r in docs.select(F.col(domain_col).cast("string")).where(F.col(domain_col).isin(*TARGETS)).distinct().collect()}
    if there and there < set(TARGETS):
        warnings.warn(f"no documents of {sorted(set(TARGETS) - there)}: their targets are shared out among the others", stacklevel=2)
    return {k: v for k, v in TARGETS.items() if k in there}


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """Query: the fitted non-negative rate of every document, and its copies; as many tokens are asked for as there are."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    d = fit_domains(docs, labels)
    table = stage(members(docs, d, carry=["doc_id"]), "members")
    fit = fit_rates(table, d.names, default_targets(docs))
    shared = spark.sparkContext.broadcast(fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        for b in batches:
            p = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) if b.num_rows else np.zeros((0, len(fit.target)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fold_rates(p, fit.gradients, fit.floor))], names=[*b.schema.names, "rate"])

    rated = table.mapInArrow(run, T.StructType([*table.schema.fields, T.StructField("rate", T.DoubleType())]))
    shares = [F.round(F.col("posterior")[k], 6).alias(f"p_{n}") for k, n in enumerate(d.names)]
    return rated.select("doc_id", "tokens", *shares, F.round("rate", 6).alias("rate"), copies(F.col("rate"), F.col("doc_id")).alias("copies"))


def mix(
    docs: DataFrame,
    labels: DataFrame,
    *,
    targets: dict[str, float] | None = None,
    floor: float = 1.0,
    most_expansion: float = 16.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    domain_col: str = "lang",
) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says; with a floor of 1 none goes.

    Targets that would make more than ``most_expansion`` times the tokens that there are, as a tiny weight of a large
    domain does under a floor, are an error.  Posteriors are worked out twice, for the fit and for the result, which
    costs less than writing every text once more beside them.
    """
    d = fit_domains(docs, labels, domain_col=domain_col, id_col=id_col, text_col=text_col)
    if not d.names:
        return docs
    table = stage(members(docs, d, text_col=text_col), "members")
    fit = fit_rates(table, d.names, default_targets(docs, domain_col) if targets is None else targets, floor=floor)
    drop(table)
    if fit.target.sum() > most_expansion * fit.natural.sum():
        raise ValueError(f"the targets ask for {fit.target.sum() / fit.natural.sum():.1f} times the tokens that there are")
    rate, copy = fresh(docs, "rate"), fresh(docs, "copy")
    rated = with_rates(docs, d, fit, text_col=text_col, rate=rate)
    n = copies(F.col(rate), F.col(id_col), F.col(text_col))
    return rated.withColumn(copy, F.explode(F.array_repeat(F.lit(0), n))).drop(rate, copy)
