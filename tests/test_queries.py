"""Every query beside its SQL, and that its plan is what it should be."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from quillmill.plans import catalogue, files  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else v


@pytest.fixture(scope="module")
def con(tiny):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tiny}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, tiny, con, name):
    df = catalogue.QUERIES[name](spark, tiny)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    if name not in catalogue.SQL:
        return
    cur = con.execute(catalogue.SQL[name])
    names = [d[0] for d in cur.description]
    at = [names.index(c) for c in columns]
    assert sorted(names) == columns and rows == sorted(repr(tuple(plain(r[i]) for i in at)) for r in cur.fetchall())


def test_texts_are_whole(spark, tiny):
    """What cleaning, prompts and repairs return goes on to the end of the text."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet").where("length(text) > 1000").select("doc_id", "text")
    for name, out, least in (("clean_text", "clean", 900), ("strip_nbsp", "data", 1000), ("prompt_fill", "positional", 1000), ("prompt_fill", "named", 1000)):
        got = catalogue.QUERIES[name](spark, tiny).join(docs, "doc_id").selectExpr(f"length({out}) AS n").collect()
        assert got and all(r.n > least for r in got), name
    turns = spark.read.parquet(f"{tiny}/conversations.parquet")
    assert catalogue.QUERIES["repair_inner_quotes"](spark, tiny).where("length(repaired) > 80").count() >= turns.where("length(text) > 80").count() > 0


def test_encoded_next_to_a_half_and_without_text(spark, tmp_path):
    """As in SQL, where 32 bits would round to the other side of a half, and where there is no text."""
    texts = ["near a half 261064", "near a half 644700", "near a half 751121", "near a half 986109", "", "a\0b", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.norm, r.first) for r in catalogue.QUERIES["encoded"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    cur = con.execute(f"SELECT doc_id, norm, first FROM ({catalogue.SQL['encoded']})")
    assert got == {i: (norm, first) for i, norm, first in cur.fetchall()} and [got[i][1] for i in (0, 1, 2, 3, 6)] == [115, -284, 201, 401, None]


def test_every_document_has_a_place(spark, tiny):
    n = spark.read.parquet(f"{tiny}/documents.parquet").count()
    places = [r.place for r in catalogue.QUERIES["seeded_shuffle_rank"](spark, tiny).collect()]
    assert sorted(places) == list(range(1, n + 1)) and catalogue.QUERIES["sample_cap_whole"](spark, tiny).count() == n


def test_contract(spark):
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and __spark_entry__.entry(spark).count() == 2


def test_the_rest_works_without_the_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys

    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{top}/quillmill", tmp_path / "quillmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{top}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert set(e.queries()) and not any(k.startswith('op') or k == 'pipeline' for k in e.queries()); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from quillmill.operators import select

    spark.createDataFrame([(1, "a", 0.7, "x")], "doc_id int, text string, score double, other string").write.parquet(f"{tmp_path}/t")
    df = select.banded(select.score_floor(spark.read.parquet(f"{tmp_path}/t"))).select("doc_id", "band")
    p = plan(df)
    assert "GreaterThanOrEqual(score,0.6)" in p and "LessThan(score,2" in p and "ReadSchema: struct<doc_id:int,score:double>" in p and "Python" not in p


def test_keep_first_limits_before_the_shuffle(spark, tiny):
    from quillmill.operators import dedup

    p = plan(dedup.keep_first(spark.read.parquet(f"{tiny}/documents.parquet"), "text", ["doc_id"]))
    assert p.count("WindowGroupLimit") == 2 and p.count("Exchange") == 1
