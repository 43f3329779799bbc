import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quillmill.llm import quality as Q


def junk(k):
    return " ".join(f"W{(k * 13 + i) % 50}%%%" for i in range(30))


def prose(k):
    return " ".join(f"word{(k * 7 + i * 3) % 60}" for i in range(30)) + "."


def test_learns_and_passes_rows_through(spark, messy, texts):
    docs = messy([junk(k) if k % 3 == 0 else prose(k) for k in range(120)] + texts)
    labels = spark.createDataFrame([(k, int(k % 3 != 0)) for k in range(100)] + [(5, None), (None, 1), (9999, 0)], "doc_id long, quality int")
    table = Q.fit(docs, labels, keep=~Q.held_out("_id"))
    scored = Q.score(docs, table)
    rows = scored.collect()
    assert scored.columns == [c for c in docs.columns if c != "score"] + ["score"] and len(rows) == docs.count()
    assert all(0 <= r.score <= 1 for r in rows)
    fresh = [r for r in rows if r.doc_id is not None and 100 <= r.doc_id < 120]
    assert all((r.score >= 0.3) == (r.doc_id % 3 != 0) for r in fresh)
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 100 in ids and 101 in ids and 102 not in ids


def test_one_class_or_none(spark, messy, texts, empty):
    docs = messy(texts)
    ones = spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int")
    assert {r.score for r in Q.score(docs, Q.fit(docs, ones)).collect()} == {1.0}
    none = ones.limit(0)
    assert {r.score for r in Q.score(docs, Q.fit(docs, none)).collect()} == {0.5}
    assert Q.keep_good(empty, ones).count() == 0


def test_folded_scores_equal_the_network():
    """The table of numbers gives what averaging vectors and the softmax give."""
    texts, labels = [junk(k) for k in range(20)] + [prose(k) for k in range(20)], [0] * 20 + [1] * 20
    table = Q.train(texts, labels, Q.Training(epochs=2))
    for t in texts[::7] + ["", "a"]:
        _, ids, shares = Q._counted([t])
        z = float((table[ids].astype(np.float64) * shares).sum() + table[-1])
        assert abs(Q.score_batch(pa.array([t]), table)[0] - 1 / (1 + np.exp(-z))) < 1e-5


def test_an_epoch_against_plain_python():
    """Every step of stochastic gradient descent written out, number by number."""
    import math

    texts, labels = [junk(k) for k in range(7)] + [prose(k) for k in range(11)] + [""], [0] * 7 + [1] * 12
    how = Q.Training(epochs=2, batch=4)
    rng = np.random.default_rng(how.seed)
    start = rng.uniform(-1 / how.dim, 1 / how.dim, (1 << Q.BITS, how.dim)).astype(np.float32)
    layer, bias = rng.normal(0, 0.5, (2, how.dim)).astype(np.float32).tolist(), [0.0, 0.0]
    docs = []
    for t in texts:
        _, ids, shares = Q._counted([t])
        docs.append({int(i): float(w) for i, w in zip(ids, shares, strict=True)})
    vectors = {i: [float(x) for x in start[i]] for d in docs for i in d}
    weight = [(0.5 / labels.count(y) * len(labels)) ** 0.5 for y in (0, 1)]
    steps, done, dims = how.epochs * math.ceil(len(labels) / how.batch), 0, range(how.dim)
    for _ in range(how.epochs):
        order = rng.permutation(len(labels)).tolist()
        for k in range(0, len(order), how.batch):
            rate, errors, hidden = how.rate * (1 - done / steps), [], []
            done += 1
            rows = order[k : k + how.batch]
            for r in rows:
                h = [sum(w * vectors[i][d] for i, w in docs[r].items()) for d in dims]
                z = [sum(h[d] * layer[c][d] for d in dims) + bias[c] for c in (0, 1)]
                p1 = 1 / (1 + math.exp(z[0] - z[1]))
                y = labels[r]
                hidden.append(h)
                errors.append([(1 - p1 - (y == 0)) * weight[y], (p1 - (y == 1)) * weight[y]])
            back = [[sum(e[c] * layer[c][d] for c in (0, 1)) for d in dims] for e in errors]
            for c in (0, 1):
                layer[c] = [layer[c][d] - rate * 0.1 * sum(e[c] * h[d] for e, h in zip(errors, hidden, strict=True)) for d in dims]
                bias[c] -= rate * 0.02 * sum(e[c] for e in errors)
            for r, g in zip(rows, back, strict=True):
                for i, w in docs[r].items():
                    for d in dims:
                        vectors[i][d] -= rate * 8 * w * g[d]
    table = Q.train(texts, labels, how)
    for i, v in vectors.items():
        assert abs(table[i] - sum(v[d] * (layer[1][d] - layer[0][d]) for d in dims)) < 1e-3
    assert abs(table[-1] - (bias[1] - bias[0])) < 1e-4


def test_features_against_plain_python():
    def bucket(data):
        x = 0
        for c, m in zip(data, Q._C):
            x = (x + c * int(m)) % 2**32
        x ^= x >> 15
        return ((x * 0x2C1B3C6D + len(data)) % 2**32) >> (32 - Q.BITS)

    text = "Größe ab ab\tc".encode()
    (g3, *_), (g5, *_), (w, first, last), (pairs, *_) = Q.features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert g3.tolist() == [bucket(text[i : i + 3]) for i in range(len(text) - 2)]
    assert g5.tolist() == [bucket(text[i : i + 5]) for i in range(len(text) - 4)]
    assert len(w) == 4 and w[1] == w[2] and len(set(w.tolist())) == 3 and (first[0], last[0]) == (0, 4) and len(pairs) == 3


def test_the_sample_is_bounded_before_texts_leave(spark):
    from quillmill.llm.flat import bounded_sample

    rows = [(k, "x" * (100_000 if k % 10 == 0 else 50)) for k in range(200)] + [(3, "x" * 50), (3, "another")]
    texts = spark.createDataFrame(rows, "_id long, _t string")
    marks = spark.range(200).selectExpr("id AS _id", "CAST(id % 2 AS int) AS _y")
    got = bounded_sample(texts, marks, rows_most=1000, bytes_most=20_000, seed=1)
    assert len(got) == 181 and sum(len(t) for t, _ in got) <= 20_000
    assert len(bounded_sample(texts, marks, rows_most=30, bytes_most=1 << 30, seed=1)) == 30
    assert bounded_sample(texts.limit(0), marks, rows_most=30, bytes_most=100, seed=1) == []


def test_score_depends_on_the_text_alone():
    table = np.linspace(-1, 1, (1 << Q.BITS) + 1).astype(np.float32)
    alone = [Q.score_batch(pa.array([t]), table)[0] for t in (prose(1), junk(2), "", "x" * 3_000_000)]
    assert list(Q.score_batch(pa.array([prose(1), junk(2), None, "x" * 3_000_000]), table)) == alone


def test_held_out(spark):
    rows = spark.range(50).select("id", Q.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_query(spark, tiny):
    rows = Q.op1_quality(spark, tiny)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"] and rows.count() == spark.read.parquet(f"{tiny}/documents.parquet").count()
    marked = rows.join(spark.read.parquet("/root/testdata/sf0.001/labels.parquet"), "doc_id").where("held_out")
    assert marked.where(F.col("predicted") == F.col("quality")).count() >= 0.8 * marked.count()
