"""Texts of an Arrow batch as one flat byte buffer, and hashes over it.

Everything here works on numpy arrays over many documents at a time; a slice is
cut after a bounded number of bytes, so that memory follows the slice and the
longest single text, not the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def fresh(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores behind it as make it a column that ``df`` hasn't got."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_arrow(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """mapInArrow by position, so that names may hold dots or anything else."""
    inner = T.StructType([T.StructField(f"o{k}", x.dataType) for k, x in enumerate(schema.fields)])
    names = inner.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in f(batches):
            yield pa.RecordBatch.from_arrays(b.columns, names=names)

    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]).mapInArrow(run, inner).toDF(*schema.names)


def bounded_sample(texts: DataFrame, marks: DataFrame, *, rows_most: int, bytes_most: int, seed: int, each: int = 0) -> list[tuple[str, object]]:
    """``(text, label)`` of at most so many of the rows of ``texts`` (_id, _t) that ``marks`` (_id) names, with at most so many bytes of text.

    One of the two has the label _y.  Rows come in the order of a hash of their id, the first ``each`` of every label
    before all others.  Sizes alone reach the driver first, for twice as many rows as are asked for; a text that is over
    what is left of the bytes is passed over whole, and only the texts that have been chosen leave the executors.
    Repeated rows count once.
    """
    order = F.xxhash64(F.col("_id"), F.lit(seed))
    others = [c for c in texts.columns if c not in ("_id", "_t")]
    sized = texts.select("_id", *others, F.octet_length("_t").alias("n"), F.xxhash64("_t").alias("h")).join(marks, "_id").select("_id", "_y", "n", "h").distinct()
    found = sized.orderBy(order, "_id", "h", "_y").limit(2 * rows_most).collect()
    if each:
        rank = F.row_number().over(Window.partitionBy("_y").orderBy(order, "_id", "h"))
        found = [*sized.withColumn("r", rank).where(F.col("r") <= each).orderBy("_y", "r").drop("r").collect(), *found]
    chosen: dict[tuple, object] = {}
    left = bytes_most
    for x in found:
        key = (x["_id"], x["h"])
        if key not in chosen and x["n"] <= left and len(chosen) < rows_most:
            left -= x["n"]
            chosen[key] = x["_y"]
    kind = T.StructType([texts.schema["_id"], T.StructField("h", T.LongType())])
    table = texts.sparkSession.createDataFrame(list(chosen), kind)  # at most rows_most of them
    got = texts.select("_id", "_t", F.xxhash64("_t").alias("h")).join(F.broadcast(table), ["_id", "h"]).dropDuplicates(["_id", "h"])
    text_of = {(r["_id"], r["h"]): r["_t"] for r in got.toLocalIterator()}
    return [(text_of[k], y) for k, y in chosen.items()]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column one after another, and n+1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of rows of about ``most`` bytes; at least one row each."""
    raw, at = flat(column)
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, raw[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n."""
    if len(_powers[0]) < n:
        n = max(n, SLICE_BYTES * 2)
        for k, b in enumerate((_BASE, _INVERSE)):
            x = np.full(n, b, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SPREAD = mix(np.arange(1, 257, dtype=np.uint64))


def ascii_lower(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte as it is."""
    return raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, first)`` of the words ``[^\\x20\\x09-\\x0D]+``: byte ranges, and n+1 word indexes by document."""
    solid = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, at)


def range_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range [start, end), equal for equal bytes."""
    power, inverse = _power(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_SPREAD[raw] * power[: len(raw)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def sums(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The sum of values[first:last] for each pair; ranges are in order and don't overlap."""
    out = np.zeros(len(first), np.float64)
    full = np.flatnonzero(last > first)
    if len(full):
        cuts = np.stack([first[full], last[full]], 1).ravel()
        padded = np.append(values, values.dtype.type(0))
        out[full] = np.add.reduceat(padded, cuts, dtype=np.float64)[::2]
    return out
