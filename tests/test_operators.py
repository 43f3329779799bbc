import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmill.operators import dedup, metrics, models, select, similarity
from quillmill.operators.components import component_labels
from quillmill.operators.numbering import row_numbers


@pytest.fixture(scope="module")
def rows(spark):
    texts = [f"t{k % 37}" if k % 11 else None for k in range(400)]
    return spark.createDataFrame([(k, t, f"f{k % 3}", None if k % 13 == 0 else float("nan") if k % 7 == 0 else k % 101 / 100) for k, t in enumerate(texts)], "doc_id int, text string, file string, score double").repartition(5)


def first_of_each(rows, *key):
    seen = {}
    for r in sorted(rows.collect(), key=lambda r: r.doc_id):
        seen.setdefault(tuple(r[k] for k in key), r.doc_id)
    return sorted(seen.values())


@pytest.mark.parametrize("parts", ["1", "4", "16"])
@pytest.mark.parametrize("how", ["md5", "sha256", "xxh3_128"])
def test_keep_first(spark, rows, parts, how):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        kept = dedup.keep_first(rows, "text", ["doc_id"], how=how)
        assert sorted(r.doc_id for r in kept.collect()) == first_of_each(rows, "text")
        assert dedup.keep_first(kept, "text", ["doc_id"], how=how).count() == kept.count() and kept.columns == rows.columns
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_scopes_and_flags(rows):
    assert sorted(r.doc_id for r in dedup.keep_first(rows, "text", ["doc_id"], scope=["file"]).collect()) == first_of_each(rows, "file", "text")
    flags = dedup.flagged(rows, "text", ["doc_id"])
    assert sorted(r.doc_id for r in flags.where("NOT flags").collect()) == first_of_each(rows, "text") and flags.count() == rows.count()


def test_bloom_loses_little_and_keeps_no_copy(spark, rows):
    exact = set(first_of_each(rows, "text"))
    for n in (1, 4):
        assert {r.doc_id for r in dedup.bloom_keep_first(rows, "text", ["doc_id"], partitions=n).collect()} == exact
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.pmod(F.col("id"), F.lit(3000))).alias("text"))
    got = {r.doc_id for r in dedup.bloom_keep_first(many, "text", ["doc_id"], capacity=64, error=0.05).collect()}
    assert got <= set(range(3000)) and len(got) > 2800


def test_bloom_grows_within_its_error():
    f = dedup.ScalableBloom(100, 0.01)
    values = [str(k).encode() for k in range(5000)]
    first = [f.add(v) for v in values]
    assert sum(first) < 100 and len(f.layers) > 3 and all(f.add(v) for v in values)


def test_unseen(rows):
    known = rows.where("doc_id < 20").select(dedup.digest(F.col("text")).alias("digest"))
    left = {r.text for r in dedup.unseen(rows, "text", known).collect()}
    assert left and not left & {r.text for r in rows.where("doc_id < 20 AND text IS NOT NULL").collect()}


def test_bands_are_disjoint_and_cover(rows):
    floor = {r.doc_id for r in select.score_floor(rows).collect()}
    want = {r.doc_id: r.score for r in rows.collect() if r.score is not None and r.score == r.score}
    assert floor == {k for k, v in want.items() if v >= 0.4}
    bands = {r.doc_id: r.band for r in select.banded(rows).collect()}
    assert bands == {k: "0.6-0.8" if v < 0.8 else "0.8-2" for k, v in want.items() if 0.6 <= v < 2}


def test_names(spark):
    both = spark.createDataFrame([("c", "m")], "content string, md string")
    assert select.text_named(both).columns == ["text", "md"] and select.text_named(both.drop("content")).columns == ["text"]
    assert select.text_named(both.withColumn("text", F.lit(1))).columns == ["content", "md", "text"]
    assert select.labels_named(spark.createDataFrame([(1,)], "scores int")).columns == ["labels"]


def test_samples(rows):
    a, b = select.sample_cap(rows, 50), select.sample_cap(rows.repartition(9), 50)
    assert a.count() == 50 and a.exceptAll(b).count() == 0 and select.sample_cap(rows, 10**6).count() == rows.count()
    assert [r.doc_id for r in select.shuffled(rows).collect()] == [r.doc_id for r in select.shuffled(rows.repartition(2)).collect()] != sorted(r.doc_id for r in rows.collect())
    assert [r.n for r in row_numbers(rows.select("doc_id"), ["doc_id"], "n", start=0).orderBy("doc_id").collect()] == list(range(400))


def test_caps_keep_whole_rows_where_they_lie(spark):
    rows = spark.createDataFrame([(k, f"text {k}") for k in range(3000)] + [(None, "no id")], "doc_id long, text string").repartition(5)
    for cap in (1, 7, 1000, 3001):
        got = select.sample_cap(rows, cap)
        want = rows.withColumn("o", select.shuffle_key(0, "doc_id")).orderBy("o", "doc_id").limit(cap)
        assert sorted(map(repr, got.collect())) == sorted(repr(r) for r in want.drop("o").collect())
    assert select.sample_cap(rows.limit(0), 5).count() == 0 and select.first_rows(rows.limit(0), 5, "doc_id").count() == 0
    assert sorted(r.doc_id or 0 for r in select.first_rows(rows, 4, "doc_id").collect()) == [0, 0, 1, 2]
    assert [r.doc_id for r in select.first_rows(rows, 3, "text", "doc_id").orderBy("text").collect()] == [None, 0, 1]
    twice = rows.unionByName(rows)
    assert select.sample_cap(twice, 8).count() in (7, 8) and select.sample_cap(twice, 8).dropDuplicates().count() == 4


def test_sets(spark):
    a, b = spark.createDataFrame([(1,), (1,), (None,), (2,)], "x int"), spark.createDataFrame([(2,), (3,)], "x int")
    assert {r.x for r in select.set_union(a, b).collect()} == {1, 2, 3, None} and {r.x for r in select.set_difference(a, b).collect()} == {1, None}
    bag = select.bag_concat(a, b.withColumn("y", F.lit("z")))
    assert bag.columns == ["x", "y"] and bag.count() == 6


def test_components_do_not_depend_on_order(spark):
    import random

    r = random.Random(1)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(500 + k, 501 + k) for k in range(40)] + [(None, 1)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for u, v in edges[:-1]:
        a, b = find(u), find(v)
        up[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges[:-1] for x in e}
    for es in (edges, [(v, u) for u, v in reversed(edges)]):
        got = {x.id: x.label for x in component_labels(spark.createDataFrame(es, "u int, v int")).collect()}
        assert got == want
    assert component_labels(spark.createDataFrame([], "u int, v int")).count() == 0


@pytest.mark.parametrize("block", [2048, 7])
def test_nearest(spark, monkeypatch, block):
    monkeypatch.setattr(similarity, "BLOCK", block)
    r = np.random.default_rng(2)
    vectors = np.round(r.normal(size=(40, 4)), 1)
    df = spark.createDataFrame([(k, v.tolist(), f"g{k % 2}") for k, v in enumerate(vectors)] + [(None, [0.0] * 4, "g0"), (99, None, "g0")], "vec_id long, embedding array<double>, g string")
    s = vectors @ vectors.T
    for group in (None, "g"):
        got = {}
        for x in similarity.nearest(df, 3, group=group).collect():
            got.setdefault(x.i, {})[x["rank"]] = x.j
        for i in range(40):
            others = [j for j in range(40) if j != i and (group is None or j % 2 == i % 2)]
            want = sorted(others, key=lambda j: (-s[i, j], j))[:3]
            near = [got[i][k] for k in (1, 2, 3)]
            assert np.allclose(s[i, near], s[i, want])
    lists = similarity.neighbour_lists(similarity.nearest(df, 3)).first()
    assert len(lists.nn_indices) == 3 and list(lists.nn_scores) == sorted(lists.nn_scores, reverse=True)
    unit = similarity.nearest(df.where("vec_id < 40 AND vec_id > 0"), 1, normalize=True).agg(F.max("score")).first()[0]
    assert unit <= 1 + 1e-9


def test_graph_dedup(spark):
    df = spark.createDataFrame([(k, [1.0, 0.01 * k]) for k in range(3)] + [(9, [0.0, 0.1])], "vec_id long, embedding array<double>")
    near = similarity.nearest(df, 1, normalize=True)
    assert sorted(r.vec_id for r in similarity.similarity_dedup(df, near, 0.9).collect()) == [0, 9]
    assert similarity.similarity_dedup(df, near, 1.5).count() == 4
    assert [similarity.turn_threshold(n, d) for n, d in ((1, False), (2, False), (1, True))] == [0.7, 0.85, 0.6]


def test_metrics(spark, rows):
    got, seen = metrics.counted(rows, "seen")
    assert got.count() == 400 and seen.get["rows"] == 400
    assert metrics.value_counts(rows, "text").first().text.startswith("t") and metrics.value_counts(rows, "text").where("text IS NULL").count() == 0
    assert metrics.distinct_values(rows, "text").count() == 38
    assert metrics.mean_score(spark.createDataFrame([("3",), ("x",), ("nan",), ("5",)], "score string")).first().mean_score == 4.0


def test_models(spark, rows):
    class Broken:  # in here, so that workers get it by value
        batch_size = 3

        def generate(self, prompts):
            if any("7" in p for p in prompts):
                raise RuntimeError("no")
            return ["ok"] * len(prompts)

    assert abs(sum(models.CATEGORIES.values()) - 1) < 1e-9 and abs(sum(models.INACTIVE_CATEGORIES.values()) - 1) < 1e-9
    judged = models.edu_judged(rows, models.TemplateGenerator)
    assert judged.where("score IS NULL OR score > 5").count() == 0
    scored = models.regressor_scored(rows, models.HashScorer)
    assert scored.where("score < 0 OR score >= 1 OR new <> 1").count() == 0 and scored.groupBy("text").agg(F.countDistinct("score").alias("n")).where("n > 1").count() == 0
    one = rows.where("doc_id = 7 OR doc_id = 8").coalesce(1)
    assert {r.x for r in one.select(models.generated(F.col("doc_id").cast("string"), Broken, on_failure="no").alias("x")).collect()} == {"no"}
    with pytest.raises(Exception, match="no"):
        one.select(models.generated(F.col("doc_id").cast("string"), Broken)).collect()
    chats = models.chat_judged(rows.select(F.col("text").alias("first_prompt")), models.TemplateGenerator)
    assert {"difficulty_reply", "score_reply", "classify_reply"} <= set(chats.columns) and chats.count() == 400
    for style in models.STYLES:
        assert models.textbook(rows.limit(2), models.TemplateGenerator, style=style).where("data IS NULL").count() == 0
    tokens = models.tokenised(rows.withColumn("labels", F.col("score")), models.WordTokenizer, limit=1)
    assert "text" not in tokens.columns and tokens.where(F.size("input_ids") > 1).count() == 0 and tokens.where("labels IS NULL").count() == 0
    v = rows.limit(5).select(models.encoded(F.coalesce("text", F.lit("")), models.HashEncoder).alias("v")).collect()
    assert all(abs(sum(x * x for x in r.v) - 1) < 1e-5 for r in v)


def test_generation(spark):
    seeds = models.conversation_seeds(spark, 30, first=5)
    assert seeds.count() == 30 and seeds.agg(F.min("id")).first()[0] == 5
    prompts = spark.createDataFrame([(k, f"about {k}") for k in models.CATEGORIES], "system_prompt_key string, prompt string")
    made = models.conversations(seeds, models.TemplateGenerator, prompts).collect()
    assert all([t.role for t in r.conversation] == ["user", "assistant"] * 3 for r in made)
    logits = models.first_token_suppressed([1, 2])([], np.zeros(4))
    assert list(logits) == [0, -1e4, -1e4, 0] and not models.first_token_suppressed([1])([5], np.zeros(2)).any()


def test_regressor(spark):
    df = spark.createDataFrame([("good text here", 1.0), ("bad words there", 0.0)] * 20, "text string, labels double")
    out = models.trained_regressor(df).transform(df)
    assert out.groupBy("labels").agg(F.avg("score").alias("s")).orderBy("labels").collect()[0].s < 0.5


def test_flows(spark, rows):
    from quillmill.plans import flows

    a = flows.edu_corpus(rows.withColumnRenamed("text", "content").drop("score"), models.HashScorer, order=["doc_id"])
    assert a.where("score < 0.6").count() == 0 and a.groupBy("text").count().where("count > 1").count() == 0
    turns = "array<struct<role:string,content:string>>"
    chats = spark.createDataFrame([(k, [("user", f"question {k % 15}"), ("assistant", "answer")], f"c{k % 2}") for k in range(40)], f"conv_id int, conversation {turns}, system_prompt_key string")
    assert flows.judged_chats(chats, models.TemplateGenerator).count() == 0  # its replies are no JSON
    assert flows.chat_corpus(chats, models.HashEncoder).count() == 15
