"""Exact and digest dedup with keep-first, and its approximate form."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _xxh3_128(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else xxhash.xxh3_128_hexdigest(x.encode()))


def digest(c: Column, how: str = "md5") -> Column:
    """Of the text's UTF-8 bytes, in hexadecimal: md5, sha256 or xxh3_128."""
    if how == "md5":
        return F.md5(c)
    if how == "sha256":
        return F.sha2(c, 256)
    if how == "xxh3_128":
        return _xxh3_128(c)
    raise ValueError(f"no digest {how}")


def _key(column: str, how: str) -> Column:
    """Null is a value of its own that equals null and nothing else."""
    return F.coalesce(digest(F.col(column), how), F.lit("null"))


def flagged(df: DataFrame, column: str, order: Sequence[str], *, scope: Sequence[str] = (), how: str = "md5", out: str = "flags") -> DataFrame:
    """Whether an equal value came before in the order, within the scope.

    The first row of each value is found by a minimum, combined before the shuffle, so a
    value that a third of all rows share costs each task one row.  Rows are joined with
    it on the digest; a hot digest is split by the optimiser.
    """
    key = [*scope, "__d"]
    rows = df.withColumn("__d", _key(column, how)).withColumn("__o", F.struct(*order))
    first = rows.groupBy(*key).agg(F.min("__o").alias("__first"))
    on = [rows[k].eqNullSafe(first[k]) for k in key]
    joined = rows.join(first, on)
    return joined.select(*[rows[c] for c in df.columns], (rows["__o"] > first["__first"]).alias(out))


def keep_first(df: DataFrame, column: str, order: Sequence[str], *, scope: Sequence[str] = (), how: str = "md5") -> DataFrame:
    """The first row in the order of each value of the column; ``order`` must tell rows apart."""
    own = Window.partitionBy(*scope, "__d").orderBy(*order)
    # the rank limit is applied before the shuffle too, so equal values don't meet in great numbers
    return df.withColumn("__d", _key(column, how)).withColumn("__r", F.row_number().over(own)).where("__r = 1").drop("__d", "__r")


class ScalableBloom:
    """Bloom filters of doubling size and halving error, opened as they fill; the errors sum to less than ``error``."""

    def __init__(self, capacity: int = 1 << 16, error: float = 1e-4) -> None:
        self.capacity, self.error, self.layers, self.room = capacity, error / 2, [], 0

    def _grow(self) -> None:
        bits = max(64, math.ceil(-self.capacity * math.log(self.error) / math.log(2) ** 2))
        hashes = max(1, round(bits / self.capacity * math.log(2)))
        self.layers.append((np.zeros(bits // 8 + 1, np.uint8), bits, hashes))
        self.room = self.capacity
        self.capacity, self.error = self.capacity * 2, self.error / 2

    def add_all(self, digests: np.ndarray) -> np.ndarray:
        """Of each digest, a pair of 64-bit numbers, whether it was (probably) there before, earlier ones of the batch included; all are there after."""
        if not len(digests):
            return np.zeros(0, bool)
        a, b = digests[:, 0], digests[:, 1] | np.uint64(1)
        there = np.zeros(len(a), bool)
        for field, bits, hashes in self.layers:
            left = np.flatnonzero(~there)
            at = _places(a[left], b[left], bits, hashes)
            there[left] = (field[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(1)
        first = np.zeros(len(a), bool)
        first[np.unique(digests, axis=0, return_index=True)[1]] = True
        new = np.flatnonzero(~there & first)
        while len(new):
            if not self.room:
                self._grow()
            put, new = new[: self.room], new[self.room :]
            field, bits, hashes = self.layers[-1]
            at = _places(a[put], b[put], bits, hashes).ravel()
            np.bitwise_or.at(field, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
            self.room -= len(put)
        return there | ~first

    def add(self, value: bytes) -> bool:
        """Whether the value was (probably) there before; it is there after."""
        return bool(self.add_all(np.frombuffer(xxhash.xxh3_128_digest(value), np.uint64).reshape(1, 2))[0])


def _places(a: np.ndarray, b: np.ndarray, bits: int, hashes: int) -> np.ndarray:
    """The bits of each digest, a row for each."""
    return ((a[:, None] + np.arange(hashes, dtype=np.uint64) * b[:, None]) % np.uint64(bits)).astype(np.int64)


def bloom_keep_first(df: DataFrame, column: str, order: Sequence[str], *, capacity: int = 1 << 16, error: float = 1e-4, partitions: int | None = None) -> DataFrame:
    """Keep-first by membership in a scalable Bloom filter: of the distinct values a share of less than ``error`` may be lost.

    Equal digests meet in one partition, sorted by the order, and each partition has a
    filter of its own, which grows with the distinct values of the partition, by about 20
    bits for each, and takes a batch at a time.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("__d", _key(column, "md5")).repartition(n, "__d").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = ScalableBloom(capacity, error)
        for b in batches:
            digests = b"".join(xxhash.xxh3_128_digest(x) for x in b.column(b.num_columns - 1).to_pylist())
            new = ~seen.add_all(np.frombuffer(digests, np.uint64).reshape(-1, 2))
            yield pa.RecordBatch.from_arrays(b.columns[:-1], names=b.schema.names[:-1]).filter(pa.array(new, pa.bool_()))

    return dealt.mapInArrow(run, T.StructType(dealt.schema.fields[:-1]))


def unseen(df: DataFrame, column: str, known: DataFrame, how: str = "md5") -> DataFrame:
    """Rows whose digest an earlier run's table (digest) has not."""
    return df.withColumn("__d", _key(column, how)).join(known.select(F.col("digest").alias("__d")), "__d", "left_anti").drop("__d")
