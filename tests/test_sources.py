import json
import os

import pytest
from pyspark.sql import functions as F

from quillmill.operators import select
from quillmill.sources import readers, sinks
from quillmill.streaming import dedup as stream


@pytest.fixture
def tree(spark, tmp_path):
    for d, rows in (("one", [("a", 0.5), ("b", 0.3), ("c", float("nan")), ("d", None)]), ("two words/deep", [("e", 0.9)])):
        spark.createDataFrame(rows, "text string, score double").coalesce(1).write.parquet(f"{tmp_path}/in/{d}")
    spark.createDataFrame([("f",)], "text string").coalesce(1).write.parquet(f"{tmp_path}/in/none")
    os.makedirs(f"{tmp_path}/in/bad")
    with open(f"{tmp_path}/in/bad/x.parquet", "w") as f:
        f.write("no parquet")
    return str(tmp_path)


def test_listing(spark, tree):
    found = readers.files(spark, f"{tree}/in", ".parquet")
    assert len(found) == 4 and found == sorted(found) and readers.files(spark, f"{tree}/in", ".parquet", recursive=False) == []
    assert len(readers.files(spark, f"{tree}/in", ".parquet", exclude="x.parquet")) == 3 and len(readers.files(spark, f"{tree}/in", ".parquet", contains="x")) == 1
    assert readers.subdirectories(spark, f"{tree}/in") == ["bad", "none", "one", "two words"]
    with pytest.raises(FileNotFoundError):
        readers.files(spark, f"{tree}/nowhere", ".parquet")


def test_ingest(spark, tree):
    dirs = [f"{tree}/in/{d}" for d in ("two words", "one", "none", "bad")]
    df = readers.ingest(spark, dirs)
    assert [(r.text, r.score) for r in df.orderBy("order_key").collect()] == [("e", 0.9), ("a", 0.5)]
    assert df.where("text = 'e'").first().file_name.startswith(f"{tree}/in/two words/deep/part-")
    cached = readers.ingest(spark, dirs, cache_dir=f"{tree}/cache")
    again = readers.ingest(spark, dirs, cache_dir=f"{tree}/cache")
    assert cached.drop("order_key").exceptAll(again.drop("order_key")).count() == 0 and again.count() == 2
    assert readers.ingest(spark, dirs, min_score=0.1, cache_dir=f"{tree}/cache").count() == 3  # another floor, another cache
    with pytest.raises(FileNotFoundError):
        os.makedirs(f"{tree}/void")
        readers.ingest(spark, [f"{tree}/void"])


def test_training_rows(spark, tmp_path):
    rows = [("t ext", "3"), (None, "2"), ("u", "x"), ("v", "4"), ("w", "5")]
    spark.createDataFrame(rows, "content string, scores string").coalesce(1).write.parquet(f"{tmp_path}/set_zh")
    assert [(r.text, r.labels) for r in readers.training_rows(spark, f"{tmp_path}/set_zh", limit=4).collect()] == [("t ext", 3.0), ("v", 4.0)]
    assert readers.training_rows(spark, f"{tmp_path}/set_zh", lang="zh", clean=True).count() == 3 and readers.training_rows(spark, f"{tmp_path}/set_zh", lang="en").count() == 0


def test_json(spark, tmp_path):
    with open(f"{tmp_path}/qwen_coder.json", "w") as f:
        json.dump({"data": [[{"instruction": "i", "response": "r"}, {"instruction": "j", "response": None}], [{"instruction": "not"}]]}, f)
    got = readers.first_data(spark, f"{tmp_path}/qwen_coder.json", "instruction string, response string").withColumn("m", readers.model_of(F.col("file_name")))
    assert [(r.instruction, r.response, r.m) for r in got.collect()] == [("i", "r", "qwen2.5-coder-32b"), ("j", None, "qwen2.5-coder-32b")]
    spark.createDataFrame([("p", "1")], "text string, n string").coalesce(1).write.parquet(f"{tmp_path}/mix/a.parquet")
    with open(f"{tmp_path}/mix/b.jsonl", "w") as f:
        f.write('{"text": "q", "n": "01"}\n')
    os.replace(next(str(p) for p in (tmp_path / "mix/a.parquet").iterdir() if p.suffix == ".parquet"), f"{tmp_path}/mix/c.parquet")
    import shutil

    shutil.rmtree(f"{tmp_path}/mix/a.parquet")
    assert sorted((r.text, r.n) for r in readers.parquet_or_json(spark, f"{tmp_path}/mix", "text string, n string").collect()) == [("p", "1"), ("q", "01")]
    sinks.json_lines(spark.createDataFrame([(None, "x")], "a string, b string"), f"{tmp_path}/out")
    assert any('{"a":null,"b":"x"}' in p.read_text() for p in (tmp_path / "out").glob("*.json"))


def test_markers_and_manifest(spark, tree):
    paths = readers.files(spark, f"{tree}/in/one", ".parquet")
    assert readers.unmarked(spark, paths) == paths and readers.has_column(spark, paths[0], "score")
    manifest = spark.createDataFrame([(paths[0],)], "file_name string")
    assert readers.not_done([*paths, "other"], manifest).collect()[0].file_name == "other"


def test_sinks(spark, tmp_path):
    df = spark.range(20).withColumn("k", F.when(F.col("id") % 3 == 0, None).otherwise(F.concat(F.lit("a/b"), F.col("id") % 3)))
    sinks.parquet(df, f"{tmp_path}/s", shards=4)
    assert len(list((tmp_path / "s").glob("*.parquet"))) == 4
    sinks.by_column(df, f"{tmp_path}/k", "k")
    assert {r.k for r in spark.read.parquet(f"{tmp_path}/k").select("k").distinct().collect()} == {"a/b1", "a/b2"}
    sinks.swap(spark.read.parquet(f"{tmp_path}/s").where("id < 5"), f"{tmp_path}/s")
    assert spark.read.parquet(f"{tmp_path}/s").count() == 5 and not list(tmp_path.glob("s.*"))
    select.banded(spark.createDataFrame([(0.7,), (0.9,)], "score double")).write.partitionBy("band").parquet(f"{tmp_path}/bands")
    assert sorted(p.name for p in (tmp_path / "bands").glob("band=*")) == ["band=0.6-0.8", "band=0.8-2"]


def test_resume(spark, tmp_path):
    src = spark.createDataFrame([(k, f"f{k % 4}") for k in range(12)], "id int, file_name string")
    seen = []

    def step(df):
        seen.append(df.count())
        return df

    assert sinks.resume(spark, src.where("file_name < 'f2'"), f"{tmp_path}/o", step) == 2
    assert sinks.resume(spark, src, f"{tmp_path}/o", step) == 2 and sinks.resume(spark, src, f"{tmp_path}/o", step) == 0
    assert seen == [6, 6] and spark.read.parquet(f"{tmp_path}/o").count() == 12


def test_stream_remembers(spark, tmp_path):
    schema = "id long, text string"
    write = lambda ids, k: spark.createDataFrame([(i, None if i == 5 else f"t{i % 6}") for i in ids], schema).write.mode("append").parquet(f"{tmp_path}/in")
    for k, ids in enumerate((range(8), range(4, 20))):
        write(ids, k)
        stream.run_available(stream.new_texts(spark, f"{tmp_path}/in", schema), f"{tmp_path}/out", f"{tmp_path}/state")
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert len(rows) == 7 and {r.text for r in rows} == {None, "t0", "t1", "t2", "t3", "t4", "t5"}
