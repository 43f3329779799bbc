import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quillmill.llm import packing as P


def check(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for b in bins.values():
        b.sort(key=lambda r: r.at)
        at = 0
        for r in b:
            assert r.at == at and r.n_tokens > 0
            at += r.n_tokens
        assert at <= capacity
        for field in ("source", "cluster"):
            values = [r[field] for r in b if r[field] is not None]
            assert len(values) == len(set(values))
    return bins


def test_places_every_token_without_conflict(messy, texts):
    docs = messy(texts * 4)
    rows = P.pack(docs, capacity=50, shard_rows=16).collect()
    check(rows, 50)
    words = {r.doc_id: len((r.text or "").split()) for r in docs.collect() if r.doc_id is not None}
    got = defaultdict(int)
    for r in rows:
        got[r.doc_id] += r.n_tokens
    for d, n in words.items():
        assert got[d] == n * (2 if d == 0 else 1)
    assert all((r.bin_id is None) == (r.n_tokens == 0) for r in rows)


def test_is_the_tightest_compatible_bin():
    """Against a search of all bins."""
    r = random.Random(3)
    for _ in range(30):
        n, capacity = 60, 30
        lengths = sorted((r.randint(1, 29) for _ in range(n)), reverse=True)
        sources, clusters = [r.choice([None, "a", "b", "c", "d", "e", "f"]) for _ in range(n)], [r.randrange(40) for _ in range(n)]
        got = {row: (b, at) for row, _, _, b, at in P.pack_shard(lengths, sources, clusters, capacity)}
        bins = []
        for i in range(n):
            fits = [(capacity - used - lengths[i], k) for k, (used, s, c) in enumerate(bins) if used + lengths[i] <= capacity and not (sources[i] is not None and sources[i] in s) and clusters[i] not in c]
            b, at = got[i]
            if fits:
                assert bins[b][0] == at and capacity - at - lengths[i] == min(fits)[0] and (min(fits)[0], b) in fits
            else:
                assert b == len(bins) and at == 0
                bins.append([0, set(), set()])
            bins[b][0] += lengths[i]
            bins[b][1].add(sources[i])
            bins[b][2].add(clusters[i])


def test_equal_rows_are_spread_and_take_no_quadratic_time(spark):
    import time

    docs = spark.range(6000).selectExpr("5L AS doc_id", "'one two three' AS text", "CAST(NULL AS string) AS source")
    rows = P.pack(docs, shard_rows=500).collect()
    shards = {r.bin_id >> 32 for r in rows}
    assert len(rows) == len({r.bin_id for r in rows}) == 6000 and len(shards) == 12
    began = time.time()
    placed = P.pack_shard([7] * 40_000, [None] * 40_000, [3] * 40_000, 2048)
    assert len({x[3] for x in placed}) == 40_000 and time.time() - began < 5


def test_long_documents_are_cut(spark):
    docs = spark.createDataFrame([(1, "w " * 25, "s"), (2, "v " * 4, "t")], "doc_id long, text string, source string")
    rows = sorted(P.pack(docs, capacity=10).collect(), key=lambda r: (r.doc_id, r.piece))
    assert [(r.doc_id, r.piece, r.first_token, r.n_tokens) for r in rows] == [(1, 0, 0, 10), (1, 1, 10, 10), (1, 2, 20, 5), (2, 0, 0, 4)]
    assert rows[2].bin_id == rows[3].bin_id


def test_other_lengths_and_errors(spark, empty):
    assert P.pack(empty).count() == 0
    docs = spark.createDataFrame([(1, 5, "s", 1), (2, None, "t", 2)], "doc_id long, n int, source string, c int")
    rows = P.pack(docs.withColumn("text", F.lit(None).cast("string")), length=F.col("n"), cluster=F.col("c"), capacity=8).collect()
    assert sorted((r.doc_id, r.n_tokens, r.bin_id is None) for r in rows) == [(1, 5, False), (2, 0, True)]
    with pytest.raises(ValueError):
        P.pack(docs, capacity=0)
