"""Connected components over an edge table, by contracting it partition by partition."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.staging import drop, stage


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) -> (node, root): the least node that each reaches over this partition's edges alone."""
    up: dict = {}

    def find(x):
        top = x
        while up.setdefault(top, top) != top:
            top = up[top]
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    kind = None
    for b in batches:
        kind = b.column(0).type
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            low, high = sorted((find(u), find(v)))
            up[high] = low
    if up:
        nodes = list(up)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([find(x) for x in nodes], kind)], names=["node", "root"])


def component_labels(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(id, label)``: for each endpoint the smallest id that it reaches.

    A round contracts the edges of each partition where they lie, so a hub with very many
    edges needs no task of its own.  A node whose partitions disagree on its root gives
    edges between these roots, at most one for each partition, and they are the next
    round's graph.  Each round at least halves what is not contracted; stars and cliques
    take two.  Then the roots are looked up back through the rounds.  Rounds are written
    to the shared folder; nothing is collected.  Edges with a null end are ignored; an
    empty table gives no rows.
    """
    now = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    kind = now.schema["u"].dataType
    schema = T.StructType([T.StructField("node", kind), T.StructField("root", kind)])
    rounds: list[DataFrame] = []
    while True:
        roots = now.mapInArrow(_contracted, schema)
        found = roots.groupBy("node").agg(F.min("root").alias("root"), F.collect_set("root").alias("roots"))
        rounds.append(stage(found.withColumn("roots", F.when(F.size("roots") > 1, F.col("roots"))), "roots"))
        open_ = rounds[-1].where("roots IS NOT NULL")
        if not open_.limit(1).count():
            break
        now = open_.select(F.col("root").alias("u"), F.explode("roots").alias("v")).where("u <> v").distinct()
    labels = rounds[-1].select(F.col("node").alias("id"), F.col("root").alias("label"))
    for earlier in reversed(rounds[:-1]):
        later = labels.select(F.col("id").alias("root"), "label")
        labels = earlier.join(later, "root", "left").select(F.col("node").alias("id"), F.coalesce("label", "root").alias("label"))
    if len(rounds) == 1:
        labels._staged_path = rounds[0]._staged_path
        return labels
    out = stage(labels, "labels")
    drop(*rounds)
    return out
