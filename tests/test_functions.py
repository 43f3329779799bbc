"""Scalar functions against Python restatements, on strings chosen to be awkward."""

import json
import re

import pytest
from pyspark.sql import functions as F

from quillmill.functions import conversations as C
from quillmill.functions import judge as J
from quillmill.functions import text as X
from quillmill.functions.config import flattened, signature

STRINGS = [
    None, "", " ", " x ", " 　 a \x1c", "a\r\nb", "a\r\n\r\n\nb", "x    y", "x  y", "--", "---", "-----", "□■a■", "𠮷a" * 3, "教育得分：３分", "教育得分：\n约 4 分 5", "教育得分：1 教育得分：2", "教育得分：none", "得分：3", "教育得分：9",
    "||ab||", "<|im_end|>", " abc<|im_end|>||", "ab", "100% {} {query}", "a" * 2001, "a" * 2000, "，。“”‘’；：", "```json\n{\"a\": 1}\n```",
]


def col(spark, values, *exprs):
    df = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    return [tuple(r) for r in df.select("i", *[e.alias(f"e{k}") for k, e in enumerate(exprs)]).orderBy("i").drop("i").collect()]


def edu(t):
    m = re.search(r"教育得分：[\s\S]*?(\d)", t)
    return m and str(int(m[1]))


def on(f):
    return lambda s: None if s is None else f(s)


@pytest.mark.parametrize(
    "spark_form,python_form",
    [
        (X.py_strip, str.strip), (X.edu_score, edu), (X.without_nbsp, lambda t: t.replace(" ", "")),
        (lambda c: X.truncated(c, 2000), lambda t: t[:2000] + "......" if len(t) > 2000 else t), (lambda c: X.truncated(c, 2), lambda t: t[:2] + "......" if len(t) > 2 else t),
        (X.clean_turn, lambda t: t.replace("||", "").replace("<|im_end|>", "").strip()),
        (X.plain_punctuation, lambda t: t.translate(str.maketrans("，。“”‘’；：", ",.\"\"'';:"))),
        (X.bare_json, lambda t: t.replace("```", "").replace("\n", "").replace("json", "").replace(" ", "")),
        (X.inner_quotes_repaired, lambda t: re.sub(r'(?<![{:,}])"(?![{:,}])', "“", t)),
        (lambda c: X.filled("<{}>%", c), lambda t: f"<{t}>%"), (lambda c: X.filled_by_name('{{"q": {query}}}', query=c), lambda t: '{"q": ' + t + "}"),
        (X.base_name, lambda t: t.rsplit("/", 1)[-1]),
    ],
)
def test_text(spark, spark_form, python_form):
    assert [r[0] for r in col(spark, STRINGS, spark_form(F.col("s")))] == [on(python_form)(s) for s in STRINGS]


CLEANED = {
    "": "", " x ": "x", "a\nb": "a\nb", "a\r\nb": "a\n\nb", "a\r\n\r\n\nb": "a\n\nb", "a\n \nb": "a\n \nb", "x  y": "x  y", "x    y": "x  y", "--": "--", "-----": "---", "----- x ----": "--- x ---",
    "\u25a1\u25a0a\u25a0": "a", "a\u2003b": "ab", "a\u00a0\u3000b": "a  b", "\u3000 a \x1c": "a", "a \u2003 b": "a  b", "-\u25a1--": "---",
}


def test_cleaning(spark):
    assert [r[0] for r in col(spark, [None, *CLEANED], X.uniform(F.col("s")))] == [None, *CLEANED.values()]


REPLIES = ['{"a": "1", "b": ["x","y"]}', "{'a': '1'}", '{"a": "1"} tail', '{"a": "1", "a": "2"}', '["a"]', '{"a": ["q"]}', '{"a": 3}', '{"b": "1"}', '{"a": "x json y"}', '```json\n{“a”：“全”}\n```', '{"a": "say "hi" now"}', "{", "", "no", None, '{"a": null}']


def test_json_values(spark):
    got = col(spark, REPLIES, J.json_value(F.col("s"), "a"), J.json_value(F.col("s"), "a", strict=True), J.json_value(F.col("s"), "a", repair=True))

    def strict(s):
        s = X_bare(s)
        try:
            v = json.loads(s)["a"]
        except Exception:
            return None
        return v if v is None or isinstance(v, str) else json.dumps(v)

    def X_bare(s):
        return s.translate(str.maketrans("，。“”‘’；：", ",.\"\"'';:")).replace("```", "").replace("\n", "").replace("json", "").replace(" ", "")

    assert [g[1] for g in got] == [None if s is None else strict(s) for s in REPLIES]
    same = [k for k, s in enumerate(REPLIES) if s not in ('{"a": ["q"]}',)]
    assert [got[k][0] for k in same] == [got[k][1] for k in same]
    assert got[10][0] is None and got[10][2] == "say“hi“now"
    assert [r[0] for r in col(spark, REPLIES[:1], F.get(J.json_list(F.col("s"), "b"), 1))] == ["y"]


def test_labels(spark):
    values = ["3", " 3 ", "3f", "3d", "nan", "inf", "-Infinity", "1_000", "３", "", "x", None, "1e3", "0x10"]

    def number(s):
        try:
            return float(s)
        except (TypeError, ValueError):
            return None

    got = [r[0] for r in col(spark, values, J.as_number(F.col("s")))]
    assert [repr(g) for g in got] == [repr(number(v)) for v in values]
    assert col(spark, ["5 of 3", "none"], X.first_digit(F.col("s"))) == [(5,), (None,)]


def test_conversations(spark):
    turns = "array<struct<role:string,content:string>>"
    df = spark.createDataFrame([(0, [("user", "hello||"), ("assistant", "there")]), (1, [("user", "ab")]), (2, []), (3, None), (4, [("user", "one"), ("user", "two")])], f"i int, conversation {turns}")
    c = F.col("conversation")
    rows = df.orderBy("i").select(C.cleaned(c)["content"].alias("c"), C.first_prompt(c).alias("p"), C.first_answer(c).alias("a"), C.turn_pairs(c).alias("n"), X.conversation_prompt(c, suffix="!").alias("t"), X.conversation_prompt(c, template=False).alias("r")).collect()
    assert [r.c for r in rows] == [["hello", "there"], None, [], None, ["one", "two"]]
    assert [r.p for r in rows] == ["hello||", "ab", None, None, "one"] and rows[0].a == "there" and rows[4].n == 1.0
    assert rows[0].t.endswith("there<|im_end|>\n!") and rows[4].t.endswith("two<|im_end|>\n<|im_start|>assistant\n!") and rows[2].t == "" and rows[4].r == "one"
    made = spark.createDataFrame([("q", "a")], "instruction string, response string")
    assert made.select(C.conversation_of(made).alias("c")).first().c[1].content == "a"
    with pytest.raises(ValueError):
        C.conversation_of(made.drop("response"))
    pads = spark.createDataFrame([([1.0],)], "l array<double>").select(C.padded(F.col("l"), F.lit(3)).alias("r"), C.padded(F.col("l"), F.lit(3), left=True).alias("l"), C.padded(F.col("l"), F.lit(0)).alias("n")).first()
    assert (pads.r, pads.l, pads.n) == ([1.0, -100, -100], [-100, -100, 1.0], [1.0])


def test_paths(spark):
    got = col(spark, ["file:///a%20b/c+d.parquet", "hdfs://host:1/x/教.json", "/plain"], X.decoded_path(F.col("s")), X.with_suffix(F.col("s"), ".parquet", ".x"))
    assert [g[0] for g in got] == ["/a b/c+d.parquet", "/x/教.json", "/plain"] and got[0][1].endswith("c+d.x")


def test_settings():
    s = {"a": 1, "b": {"c": [], "d": [1, 2], "e": [{"f": 3}, {"f": 4}]}, "skip": 5}
    assert flattened(s, {"skip"}) == [("a", "1"), ("b_c", ""), ("b_d", "1-2"), ("b_e-0_f", "3"), ("b_e-1_f", "4")]
    assert flattened({"a": {"b": 1, "c": {"b": 2}}, "b": [3], "d": {}}, {"b", "a_b"}) == [("a_c_b", "2"), ("b", "3")]
    assert flattened({"a": [1, {"x": 2}], "b": [None, 2]}) == [("a", "1-{'x': 2}"), ("unknown", "NoneType"), ("unknown", "int")]
    assert flattened([1]) == [("unknown", "list")] and signature(s) != signature(s, {"skip"}) and len(signature(s)) == 40


def test_bad_templates():
    with pytest.raises(ValueError):
        X.filled("{} {}", "x")
