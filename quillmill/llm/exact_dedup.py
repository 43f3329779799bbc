"""Exact dedup by content sort.

Rows are dealt by range: Spark samples splitters over (the first characters of the
normalised text, a 64-bit hash of it, the id), and each partition is sorted externally by
prefix, hash, the whole normalised text and the id, so that equal texts are neighbours.
A pass over each sorted partition compares every text with the one before it in full.
The id in the range key lets a group of copies, however large, spread over as many
partitions as its share asks for.

A run of equal texts may be cut by a partition's border.  Runs under the first or the
last hash of a partition are open; one row of each comes with its text, and open runs of
one text, told by the whole text again, are joined.  There are two open runs for each
partition, and one more only where different texts share a hash.  So no hash ever decides
that two texts are equal: it decides which of those with the same prefix come first.

Defined cases: null counts as the empty text and all empty texts are one group.  A
null id is worse than any other, whichever end is kept.  Among rows that tie on id
exactly one is kept.  Only the id and text columns are read; other columns, whatever
their names, can be joined on again by id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.flat import slices
from quillmill.staging import stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX = 48
RUNS = "id long, part int, run int, keep_id long, n long, kept boolean, sha string, text binary"


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, no other character; null is empty."""
    return F.coalesce(F.translate(c, _UPPER, _LOWER), F.lit(""))


def _texts(column: pa.Array, lower: bool = False) -> Iterator[bytes]:
    """The texts of a batch one by one, as bytes."""
    for _, raw, at in slices(column):
        whole = raw.tobytes()
        if lower:
            whole = whole.lower()
        for k in range(len(at) - 1):
            yield whole[at[k] : at[k + 1]]


class _Held:
    """Rows of the latest hash of a sorted partition, and of what the batch has before it, until they can be returned."""

    def __init__(self) -> None:
        self.ids: list = []
        self.runs: list[int] = []
        self.marks: list[int] = []
        self.shas: dict[int, str] = {}
        self.open: dict[int, bytes] = {}  # texts of the runs under the partition's first hash
        self.late: dict[int, bytes] = {}  # and under the latest

    def returned(self, upto: int, part: int) -> pa.RecordBatch:
        """The first ``upto`` rows, as RUNS; texts of open runs come with their first row."""
        r = np.array(self.runs[:upto], np.int64)
        starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        sizes = np.diff(np.r_[starts, len(r)])
        kept = np.zeros(len(r), bool)
        kept[starts] = True
        texts: list = [None] * len(r)
        for s in starts:
            texts[s] = self.open.pop(int(r[s]), None)
        # ids are in order with nulls last: the first of a run is the one that stays
        keep = pa.array([self.ids[s] for s in starts], pa.int64()).take(pa.array(np.repeat(np.arange(len(starts)), sizes)))
        shas = pa.array([self.shas.pop(int(r[s])) for s in starts], pa.string()).take(pa.array(np.repeat(np.arange(len(starts)), sizes)))
        cols = [pa.array(self.ids[:upto], pa.int64()), pa.array(np.full(len(r), part, np.int32)), pa.array(r.astype(np.int32)), keep]
        cols += [pa.array(np.repeat(sizes, sizes)), pa.array(kept), shas, pa.array(texts, pa.binary())]
        del self.ids[:upto], self.runs[:upto], self.marks[:upto]
        return pa.RecordBatch.from_arrays(cols, names=["id", "part", "run", "keep_id", "n", "kept", "sha", "text"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition: (id, text, hash, part) -> RUNS.  Holds one batch, and the ids and one text of each run under one hash."""
    held, run, before, lead, part = _Held(), -1, None, None, 0
    for b in batches:
        if not b.num_rows:
            continue
        part, marks = b.column(3)[0].as_py(), b.column(2).to_pylist()
        lead = marks[0] if lead is None else lead
        held.ids += b.column(0).to_pylist()
        for text, mark in zip(_texts(b.column(1)), marks, strict=True):
            if held.marks and mark != held.marks[-1]:
                held.late = {}
            if text != before:
                run, before = run + 1, text
                held.shas[run] = hashlib.sha256(text).hexdigest()
                held.late[run] = text
                if mark == lead:
                    held.open[run] = text
            held.runs.append(run)
            held.marks.append(mark)
        ended = held.marks.index(marks[-1])  # the latest hash may go on
        if ended >= 4096:
            yield held.returned(ended, part)
    if held.marks:
        last = held.marks.index(held.marks[-1])
        if last:
            yield held.returned(last, part)
        held.open = dict(held.late)
        yield held.returned(len(held.marks), part)


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with (..., text, hash, part): the first of each run, its number, and whether the run is open."""
    before, run, lead, waiting = None, -1, None, None

    def out(rows: pa.RecordBatch | pa.Table, ended: bool) -> Iterator[pa.RecordBatch]:
        marks = rows.column(rows.num_columns - 2).to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch) else rows.column(rows.num_columns - 2).to_numpy()
        rows = rows.append_column("__open", pa.array(marks == lead if ended else np.ones(len(marks), bool)))
        yield from rows.to_batches() if isinstance(rows, pa.Table) else [rows]

    for b in batches:
        if not b.num_rows:
            continue
        k = b.num_columns
        new = []
        for text in _texts(b.column(k - 3), lower=True):
            new.append(text != before)
            before = text
        mask = np.array(new)
        marks = b.column(k - 2).to_numpy()
        lead = marks[0] if lead is None else lead
        numbers = run + np.cumsum(mask)
        run = int(numbers[-1])
        kept = b.append_column("__run", pa.array(numbers.astype(np.int32))).select([*range(k - 2), k, k - 2, k - 1]).filter(pa.array(mask))
        late = marks[mask] == marks[-1]
        if waiting is not None and waiting.column(k - 1)[0].as_py() != marks[-1]:
            yield from out(waiting, True)
            waiting = None
        if not late.all():
            yield from out(kept.filter(pa.array(~late)), True)
        if late.any():
            rows = pa.Table.from_batches([kept.filter(pa.array(late))])
            waiting = rows if waiting is None else pa.concat_tables([waiting, rows])
    if waiting is not None:
        yield from out(waiting, False)


def _by_id(column: str, keep: str) -> Column:
    if keep not in ("min", "max"):
        raise ValueError("keep is min or max")
    return F.col(column).asc_nulls_last() if keep == "min" else F.col(column).desc_nulls_last()


def groups(docs: DataFrame, *, keep: str = "min", id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """``(id, keep_id, group_size, kept, text_sha256)`` for each row of ``docs``.

    ``keep``: "min" or "max", the end of the ids from which the row that stays is taken.
    """
    by_id = _by_id("id", keep)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), ascii_lower(F.col(text_col)).alias("norm"))
    rows = rows.select("id", "norm", F.substring("norm", 1, PREFIX).alias("pre"), F.xxhash64("norm").alias("h"))
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "pre", "h", by_id).sortWithinPartitions("pre", "h", "norm", by_id)
    runs = stage(dealt.select("id", "norm", "h", F.spark_partition_id().alias("part")).mapInArrow(_runs, RUNS), "runs")
    # At most two rows for each partition, but for texts that share a hash: a broadcast is bounded by their number.
    pick = F.min if keep == "min" else F.max
    open_ = runs.where("text IS NOT NULL").groupBy("text")
    whole = open_.agg(pick("keep_id").alias("all_keep"), F.sum("n").alias("all_n"), F.min("part").alias("lead"), F.collect_list(F.struct("part", "run")).alias("pieces"))
    whole = whole.where("size(pieces) > 1").select("all_keep", "all_n", "lead", F.inline("pieces"))
    wide = runs.drop("text").join(F.broadcast(whole), ["part", "run"], "left")
    return wide.select(
        "id",
        F.coalesce("all_keep", "keep_id").alias("keep_id"),
        F.coalesce("all_n", "n").alias("group_size"),
        # ids are in order over the partitions too: the row that stays is in the first piece
        (F.col("kept") & (F.col("lead").isNull() | (F.col("lead") == F.col("part")))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, *, keep: str = "min", id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct normalised text, with all their columns as they were."""
    names = docs.columns
    by_id = _by_id("__id", keep)
    norm = ascii_lower(F.col("__text"))
    at = names.index(text_col)
    own = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names) if k != at]
    rows = docs.select(*own, F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    rows = rows.withColumns({"__pre": F.substring(norm, 1, PREFIX), "__h": F.xxhash64(norm)})
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "__pre", "__h", by_id).sortWithinPartitions("__pre", "__h", norm, by_id)
    source = dealt.select(*[f"c{k}" for k in range(len(names)) if k != at], "__text", "__h", F.spark_partition_id().alias("__part"))
    fields = [T.StructField(f.name, f.dataType, True) for f in source.schema.fields]
    marks = [T.StructField("__run", T.IntegerType()), *fields[-2:], T.StructField("__open", T.BooleanType())]
    firsts = stage(source.mapInArrow(_firsts, T.StructType([*fields[:-2], *marks])), "firsts")
    # Open runs of one text, told by the whole text: all pieces but the first go.  At most two rows for each partition.
    pieces = firsts.where("__open").groupBy(ascii_lower(F.col("__text"))).agg(F.array_sort(F.collect_list(F.struct("__part", "__run"))).alias("p"))
    lost = pieces.where("size(p) > 1").select(F.inline(F.slice("p", F.lit(2), F.size("p"))))
    kept = firsts.join(F.broadcast(lost), ["__part", "__run"], "left_anti")
    return kept.select(*[F.col("__text" if k == at else f"c{k}").alias(c) for k, c in enumerate(names)])


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: every document with the one that stays of its group, the largest id."""
    g = groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep="max")
    return g.withColumnRenamed("id", "doc_id")


OP4_SQL = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""
