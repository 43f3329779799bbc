"""Quality classifier: supervised subword embeddings.

Each document is the mean of the learned vectors of its features: words, pairs of
neighbouring words, and byte n-grams of three and five bytes, all hashed into one
table.  A softmax layer on the mean gives the class probabilities.  Table and layer
are learned together by stochastic gradient descent in numpy.

Scoring uses that the layer is linear: the mean of vectors times the layer's
weights is the mean of (vector times weights), so that each feature needs one
number, not a vector.  This is the same value, at an eighth of the memory traffic.

Defined cases: a null or empty text, or one without features, has the mean vector
zero and so the score that the bias alone gives.  Rows with a null label are not
learned from.  Repeated rows are scored alike.  If the labelled rows have fewer than
two classes there is nothing to tell apart: the score is then 1.0 if only
label 1 occurs, 0.0 if only label 0 occurs and 0.5 without labels.  Columns of the
input other than the text are passed through; labels are looked up by id in a table
of their own, and no column of it reaches the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.flat import bounded_sample, fresh, map_arrow, mix, range_hashes, slices, sums, words

BITS = 18
_C = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1)]
_PAIR = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Training:
    """What the fit may look at and how it steps.

    ``sample_rows`` and ``sample_bytes`` bound the labelled rows that the driver
    gathers: whole texts in the order of a hash of their id, up to so many rows; a text
    that would pass the bound on bytes is passed over.
    """

    sample_rows: int = 2500
    sample_bytes: int = 32 << 20
    dim: int = 8
    epochs: int = 4
    batch: int = 16
    rate: float = 1.0
    seed: int = 7


def _grams(raw: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the n bytes that start at each place; shorter by n-1 than the text."""
    x = raw.astype(np.uint32)
    m = len(x) - n + 1
    h = x[:m] * _C[0]
    for k in range(1, n):
        h += x[k : m + k] * _C[k]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h += np.uint32(n)
    return (h >> np.uint32(32 - BITS)).astype(np.int32)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int32)


def features(raw: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(buckets, first, last)`` for each kind of feature; [first, last) are those of a document."""
    out = []
    for n in (3, 5):
        if len(raw) >= n:
            last = np.maximum(at[1:] - (n - 1), at[:-1])
            out.append((_grams(raw, n), np.minimum(at[:-1], last), last))
    start, end, first = words(raw, at)
    h = range_hashes(raw, start, end)
    out.append((_bucket(mix(h)), first[:-1], first[1:]))
    if len(h) > 1:
        pair = np.where(h[1:] == h[:-1], _PAIR, h[:-1] * _PAIR + h[1:])  # a repeated word is one feature, whichever word it is
        last = np.maximum(first[1:] - 1, first[:-1])
        out.append((_bucket(mix(pair)), np.minimum(first[:-1], last), last))
    return out


def _counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text its buckets and their shares, in one row after another: (row starts, buckets, shares)."""
    starts, ids, shares = [0], [], []
    for text in texts:
        for _, raw, at in slices(pa.array([text], pa.large_string()), 1 << 62):
            parts = [b[f[0] : e[0]] for b, f, e in features(raw, at)]
            all_ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        u, c = np.unique(all_ids, return_counts=True)
        ids.append(u)
        shares.append((c / max(1, c.sum())).astype(np.float32))
        starts.append(starts[-1] + len(u))
    return np.array(starts), np.concatenate(ids), np.concatenate(shares)


def train(texts: list[str], labels: list[int], how: Training = Training()) -> np.ndarray:
    """The table of one number for each bucket, and the bias at the end: the log-odds of label 1 are their mean plus the bias."""
    y = np.asarray(labels, np.int64)
    table = np.zeros((1 << BITS) + 1, np.float32)
    if len(set(labels)) < 2:
        table[-1] = 0 if not labels else (np.inf if labels[0] else -np.inf)
        return table
    rng = np.random.default_rng(how.seed)
    vectors = rng.uniform(-1 / how.dim, 1 / how.dim, (1 << BITS, how.dim)).astype(np.float32)
    layer, bias = rng.normal(0, 0.5, (2, how.dim)).astype(np.float32), np.zeros(2, np.float32)
    starts, ids, shares = _counted(texts)
    balance = (0.5 / np.bincount(y, minlength=2) * len(y)) ** 0.5
    steps, done = how.epochs * ((len(y) + how.batch - 1) // how.batch), 0
    for _ in range(how.epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), how.batch):
            rows = order[k : k + how.batch]
            rate = how.rate * (1 - done / steps)
            done += 1
            sizes = starts[rows + 1] - starts[rows]
            pick = np.repeat(starts[rows] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            owner = np.repeat(np.arange(len(rows)), sizes)
            i, w = ids[pick], shares[pick]
            hidden = np.zeros((len(rows), how.dim), np.float32)
            full = np.flatnonzero(sizes)
            if len(full):
                hidden[full] = np.add.reduceat(vectors[i] * w[:, None], np.concatenate([[0], np.cumsum(sizes[full])[:-1]]))
            logits = hidden @ layer.T + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= balance[y[rows], None]
            back = p @ layer
            layer -= rate * 0.1 * p.T @ hidden
            bias -= rate * 0.02 * p.sum(0)
            # a document's features share its step; without the length in it a long text would barely move them
            np.add.at(vectors, i, -(rate * 8) * (w[:, None] * back[owner]))
    table[:-1] = vectors @ (layer[1] - layer[0])
    table[-1] = bias[1] - bias[0]
    return table


def score_batch(column: pa.Array, table: np.ndarray) -> np.ndarray:
    """The probability of label 1 of each text."""
    out = np.zeros(len(column), np.float64)
    for i, raw, at in slices(column):
        n = len(at) - 1
        total, count = np.zeros(n), np.zeros(n)
        for buckets, first, last in features(raw, at):
            total += sums(table[buckets], first, last)
            count += last - first
        out[i : i + n] = total / np.maximum(count, 1) + np.float64(table[-1])
    return 1 / (1 + np.exp(-np.clip(out, -50, 50)))


def fit(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", keep: Column | None = None, how: Training = Training(), id_col: str = "doc_id", text_col: str = "text"
) -> np.ndarray:
    """Learns from the labelled rows for which ``keep`` (over ``_id``) holds; of several labels of an id the greatest counts."""
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y")).where("_y IN (0, 1) AND _id IS NOT NULL")
    if keep is not None:
        marks = marks.where(keep)
    marks = marks.groupBy("_id").agg(F.max("_y").alias("_y"))
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    found = bounded_sample(texts, marks, rows_most=how.sample_rows, bytes_most=how.sample_bytes, seed=how.seed)
    return train([t for t, _ in found], [y for _, y in found], how)


def score(docs: DataFrame, table: np.ndarray, *, text_col: str = "text", out: str = "score", carry: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` (columns ``carry``, all by default) with the probability ``out``, which replaces a column of that name."""
    carry = [c for c in (docs.columns if carry is None else carry) if c != out]
    shared = docs.sparkSession.sparkContext.broadcast(table)
    source = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = pa.array(score_batch(b.column(b.num_columns - 1), shared.value), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], scores], names=[*b.schema.names[:-1], out])

    return map_arrow(source, run, T.StructType([*source.schema.fields[:-1], T.StructField(out, T.DoubleType())]))


THRESHOLD = 0.3


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves no remainder by 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op1_quality(spark, sf_dir: str) -> DataFrame:
    """Query: the score of every document; learned from rows outside the held-out fifth."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    table = fit(docs, labels, keep=~held_out("_id"))
    scored = score(docs, table, carry=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score ``threshold`` or more, with their own columns."""
    table = fit(docs, labels, keep=~held_out("_id"))
    own = fresh(docs, "score")
    return score(docs, table, out=own).where(F.col(own) >= threshold).drop(own)
