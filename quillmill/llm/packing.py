"""Conflict-constrained best-fit packing of documents into training sequences.

Documents go to shards of a few thousand rows by a hash of id, length and cluster, so that
a shard has its share of every source and needs no more than its own bins; rows equal in all
three that are very many are dealt to all shards.  Within a shard they are placed
longest first.  Open bins are kept in the order of their residual; each carries a bitmap
of the sources and one of the duplicate clusters that it has.  The search starts at the
least residual that fits and goes on to the next until it finds a bin with neither the
document's source nor its cluster: the tightest compatible bin.  Without one, a bin is
opened.  Nothing is left out: a document longer than a bin is cut into pieces that fill
bins of their own, and its remainder is packed like any other.

What is shuffled is a few numbers for each document, never its text.

Defined cases: a null or empty text, or one without words, has no tokens and is returned
with a null bin.  A null source or cluster conflicts with nothing.  Repeated rows are
placed one by one and, being of one cluster, never share a bin.  Ties in length are
broken by id, null ids last.  A null length counts as zero and a negative one is an error.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.staging import stage

CAPACITY = 2048
SHARD_ROWS = 4096
MOST_EQUAL = 16  # rows equal in id, length and cluster that are more than a 16th of a shard are dealt to all shards
PLACED = "doc_id long, piece int, first_token long, n_tokens long, source string, cluster long, bin_id long, at long"


def word_count(text: Column) -> Column:
    """The number of words, runs of anything but bytes 32 and 9-13; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def copy_cluster(text: Column) -> Column:
    """A number that copies of a text share, upper and lower case being one."""
    return F.xxhash64(F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


class Bins:
    """Open bins in the order of their residual, and of one residual by what they carry, so that a conflict is told once for all bins alike."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.levels: dict[int, dict[tuple[int, int], list[int]]] = {}  # residual -> bitmaps of sources and clusters -> bins
        self.present = 0  # bit r: some bin has the residual r
        self.count = 0

    def _put(self, residual: int, carried: tuple[int, int], bin_: int) -> None:
        if residual:
            self.levels.setdefault(residual, {}).setdefault(carried, []).append(bin_)
            self.present |= 1 << residual

    def place(self, need: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, tokens before) for ``need`` tokens; source and cluster are bitmaps of at most one bit."""
        later = self.present >> need
        while later:
            residual = need + (later & -later).bit_length() - 1
            level = self.levels[residual]
            carried = next((c for c in level if not (c[0] & source or c[1] & cluster)), None)
            if carried is not None:
                bins = level[carried]
                bin_ = bins.pop()
                if not bins:
                    del level[carried]
                    if not level:
                        del self.levels[residual]
                        self.present &= ~(1 << residual)
                self._put(residual - need, (carried[0] | source, carried[1] | cluster), bin_)
                return bin_, self.capacity - residual
            later &= later - 1
        self.count += 1
        self._put(self.capacity - need, (source, cluster), self.count - 1)
        return self.count - 1, 0


def pack_shard(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(row, piece, first token, bin, tokens before) for rows in the order given."""
    bins, out = Bins(capacity), []
    source_bit = {s: 1 << k for k, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    times = pd.Series([c for c in clusters if c is not None], dtype="object").value_counts()
    cluster_bit = {c: 1 << k for k, c in enumerate(times.index[times > 1])}
    rest = []
    for row, n in enumerate(lengths):
        pieces, left = divmod(n, capacity)
        for p in range(pieces):
            out.append((row, p, p * capacity, bins.count, 0))
            bins.count += 1
        if left:
            rest.append((left, row, pieces))
    rest.sort(key=lambda x: -x[0])  # stable: ties stay in the order given
    for left, row, piece in rest:
        b, before = bins.place(left, source_bit.get(sources[row], 0), cluster_bit.get(clusters[row], 0))
        out.append((row, piece, piece * capacity, b, before))
    return out


def pack(
    docs: DataFrame,
    *,
    capacity: int = CAPACITY,
    shard_rows: int = SHARD_ROWS,
    id_col: str = "doc_id",
    source: Column | None = None,
    length: Column | None = None,
    cluster: Column | None = None,
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece of each document (PLACED): the bin it is in and the tokens before it there."""
    if capacity < 1 or shard_rows < 1:
        raise ValueError("capacity and shard_rows are positive")
    text = F.col(text_col)
    n_tokens = F.coalesce(length.cast("long"), F.lit(0)) if length is not None else word_count(text)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        n_tokens.alias("n"),
        (F.col("source") if source is None else source).cast("string").alias("source"),
        (copy_cluster(text) if cluster is None else cluster).cast("long").alias("cluster"),
    )
    # numbers alone: texts are read once
    rows = stage(rows.withColumn("salt", F.monotonically_increasing_id()), "lengths")
    shards = max(1, -(-rows.count() // shard_rows))
    # a row that is there very often is dealt to all shards; there are at most shards * MOST_EQUAL such rows
    often = rows.groupBy("doc_id", "n", "cluster").agg(F.count("*").alias("times")).where(F.col("times") > shard_rows // MOST_EQUAL)
    often = often.select(F.xxhash64("doc_id", "n", "cluster").alias("key")).distinct().withColumn("often", F.lit(True))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "n", "cluster")).join(often, "key", "left")
    rows = rows.withColumn("shard", F.pmod(F.when(F.col("often"), F.xxhash64("key", "salt")).otherwise(F.col("key")), F.lit(shards))).drop("key", "often", "salt")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "cluster", "source"], na_position="last", kind="stable").reset_index(drop=True)
        if (pdf["n"] < 0).any():
            raise ValueError("a length is negative")
        clean = lambda c: [None if pd.isna(x) else x for x in pdf[c]]
        lengths = pdf["n"].astype("int64").tolist()
        base = int(pdf["shard"].iloc[0]) << 32
        placed = pd.DataFrame(pack_shard(lengths, clean("source"), clean("cluster"), capacity), columns=["row", "piece", "first_token", "bin", "at"], dtype="int64")
        out = pdf.iloc[placed["row"]].reset_index(drop=True)
        size = (out["n"] - placed["first_token"]).clip(upper=capacity)
        out = out.assign(piece=placed["piece"], first_token=placed["first_token"], n_tokens=size, bin_id=base + placed["bin"], at=placed["at"])
        none = pdf[pdf["n"] == 0].assign(piece=0, first_token=0, n_tokens=0, bin_id=None, at=None)
        out = pd.concat([out.astype(object), none.astype(object)]) if len(none) else out
        names = ["doc_id", "piece", "first_token", "n_tokens", "source", "cluster", "bin_id", "at"]
        return out[names].astype({c: "Int64" for c in names if c != "source"})

    return rows.groupBy("shard").applyInPandas(run, PLACED)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    """Query: every document packed into sequences of 2048 words; one source and one copy a sequence."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
