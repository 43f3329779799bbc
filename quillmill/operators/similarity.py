"""Exact nearest neighbours by inner product, and dedup on the graph that they span."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.operators.components import component_labels

BLOCK = 2048


def _tiles(df: DataFrame, id_col: str, vec_col: str, group: Column, normalize: bool, tiles: DataFrame) -> DataFrame:
    """Vectors gathered in tiles of about BLOCK rows: (g, tiles, tile, ids, matrix as bytes of doubles)."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        m = np.array(pdf["v"].tolist(), np.float64)
        if normalize:
            m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
        first = pdf.iloc[0]
        return pd.DataFrame({"g": [first["g"]], "tiles": [int(first["tiles"])], "tile": [int(first["tile"])], "ids": [pdf["i"].tolist()], "m": [m.tobytes()]})

    rows = df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
    rows = rows.select(group.alias("g"), F.col(id_col).cast("long").alias("i"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.join(tiles, "g").withColumn("tile", F.pmod(F.xxhash64("i"), F.col("tiles")).cast("int"))
    return rows.groupBy("g", "tile").applyInPandas(pack, "g string, tiles int, tile int, ids array<long>, m binary")


def nearest(df: DataFrame, k: int = 5, *, id_col: str = "vec_id", vec_col: str = "embedding", group: str | None = None, normalize: bool = False) -> DataFrame:
    """``(i, j, score, rank)``: for each vector the k others, of its group, of largest inner product; ties to the smaller id.

    Tiles of a group meet in pairs, whatever the size of the table; a pair yields the best
    k of each query and no more, and those are merged.  Nothing is broadcast.
    """
    g = F.lit("") if group is None else F.coalesce(F.col(group).cast("string"), F.lit(""))
    tiles = df.groupBy(g.alias("g")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("tiles"))
    left = _tiles(df, id_col, vec_col, g, normalize, tiles)
    right = left.select("g", F.col("tile").alias("b"), F.col("ids").alias("jds"), F.col("m").alias("n"))
    pairs = left.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).join(right, ["g", "b"])

    def best(batches):
        for pdf in batches:
            for ids, m, jds, n in zip(pdf["ids"], pdf["m"], pdf["jds"], pdf["n"], strict=True):
                a, b = np.frombuffer(m).reshape(len(ids), -1), np.frombuffer(n).reshape(len(jds), -1)
                js = np.asarray(jds)
                order = np.argsort(js)
                js, s = js[order], a @ b[order].T
                s[np.asarray(ids)[:, None] == js[None, :]] = -np.inf
                top = np.argsort(-s, axis=1, kind="stable")[:, :k]
                got = np.take_along_axis(s, top, 1)
                ok = np.isfinite(got)
                yield pd.DataFrame({"i": np.repeat(ids, ok.sum(1)), "j": js[top][ok], "score": got[ok]})

    found = pairs.select("ids", "m", "jds", "n").mapInPandas(best, "i long, j long, score double")
    own = Window.partitionBy("i").orderBy(F.col("score").desc(), F.col("j"))
    return found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)


def neighbour_lists(neighbours: DataFrame) -> DataFrame:
    """The long form as lists: ``(i, nn_indices, nn_scores)``."""
    packed = F.array_sort(F.collect_list(F.struct("rank", "j", "score")))
    return neighbours.groupBy("i").agg(packed.alias("p")).select("i", F.col("p.j").alias("nn_indices"), F.col("p.score").alias("nn_scores"))


def first_of(c: Column) -> Column:
    """The first element of a list; null of an empty one."""
    return F.get(c, 0)


def edges(neighbours: DataFrame, threshold: float, use_neighbours: int = 1) -> DataFrame:
    """``(u, v)``: from each row to its first neighbours whose score is above the threshold."""
    return neighbours.where((F.col("rank") <= use_neighbours) & (F.col("score") > threshold)).select(F.col("i").alias("u"), F.col("j").alias("v"))


def similarity_dedup(df: DataFrame, neighbours: DataFrame, threshold: float = 0.95, *, id_col: str = "vec_id", use_neighbours: int = 1) -> DataFrame:
    """Rows that are alone or have the smallest id of their component."""
    gone = component_labels(edges(neighbours, threshold, use_neighbours)).where("id <> label").select(F.col("id").alias(id_col))
    return df.join(gone, id_col, "left_anti")


def turn_threshold(n_turn: float, has_document: bool) -> float:
    """0.6 for conversations about a document, else 0.7 for single turns and 0.85 for more."""
    return 0.6 if has_document else 0.7 if n_turn == 1 else 0.85


def group_thresholds(conversations: DataFrame, group: Sequence[str], order: Sequence[str], *, has_document: bool = False) -> DataFrame:
    """For each group the turns of its first row, halved, and the threshold for the whole group."""
    first = F.min_by(F.size("conversation"), F.struct(*order)) / F.lit(2.0)
    out = conversations.groupBy(*group).agg(first.alias("n_turn"))
    value = F.lit(0.6) if has_document else F.when(F.col("n_turn") == 1, 0.7).otherwise(0.85)
    return out.withColumn("threshold", value)
