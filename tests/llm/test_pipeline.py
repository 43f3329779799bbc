"""The pipeline against its stages written out in Python."""

from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillmill.llm import mixing, near_dedup, packing, quality

from .test_exact_dedup import norm
from .test_near_dedup import brute
from .test_packing import check


@pytest.fixture(scope="module")
def tables(spark, messy, texts, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    junk = [" ".join(f"W{(k * 13 + i) % 50}%%%" for i in range(30)) for k in range(40)]
    prose = [" ".join(f"{'wort' if k % 4 == 0 else 'word'}{(k * 7 + i * (3 + k % 4)) % 60}" for i in range(40 + k % 9)) for k in range(60)]
    near = [" ".join([*prose[0].split()[:-1], f"end{k}"]) for k in range(12)]
    docs = messy(texts + junk + prose + prose[:10] + [p.upper() for p in prose[:5]] + near)
    docs = docs.withColumn("lang", F.when(F.contains(F.lower("text"), F.lit("wort")), "de").otherwise("en"))
    docs.drop("a.b").write.parquet(f"{d}/documents.parquet")
    n = len(texts)
    labels = [(n + k, 0) for k in range(40)] + [(n + 40 + k, 1) for k in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    return d


def test_run_equals_brute_force(spark, tables):
    docs, labels = spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{tables}/labels.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    table = quality.fit(docs, labels, keep=~quality.held_out("_id"))
    rows = [r for r, s in zip(rows, quality.score_batch(pa.array([t for _, t in rows]), table), strict=True) if s >= 0.3]
    first = {}
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(norm(t), (d, t))
    rows = list(first.values())
    parts = brute(rows, 5, 80)
    keep = {d for null, d, _, c in parts if not null and d == c} | {None for null, *_ in parts if null}
    rows = [r for r in rows if r[0] in keep]
    want = {d: len((t or "").split()) for d, t in rows}
    packed = corpus_pipeline.run(spark, tables).collect()
    check(packed, packing.CAPACITY)
    got = defaultdict(int)
    for r in packed:
        got[r.doc_id] += r.n_tokens
    assert set(got) == set(want) and len(want) < len(first)
    assert all(got[d] >= n and (not n or got[d] % n == 0) for d, n in want.items())
    assert sum(got.values()) > sum(want.values())  # some are repeated


def test_stages(spark, tables):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "near dedup", "mixing", "packing"]
    docs = before = spark.read.parquet(f"{tables}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        after = step(spark, docs, tables)
        if name == "packing":
            assert "bin_id" in after.columns
            continue
        assert after.columns == before.columns
        n, m = docs.count(), after.count()
        assert m < n if name != "mixing" else m > n
        docs = after


def test_empty(spark, tables, empty, tmp_path):
    empty.drop("a.b").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{tables}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), tables).count() == 0


def test_defaults():
    assert mixing.TARGETS and abs(sum(mixing.TARGETS.values()) - 1) < 1e-9 and near_dedup.COORDINATES == 64
