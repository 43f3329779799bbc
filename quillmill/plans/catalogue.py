"""The queries over the base operators and, beside each, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import conversations as C
from quillmill.functions import judge as J
from quillmill.functions import text as X
from quillmill.operators import dedup, metrics, models, select, similarity
from quillmill.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS_SQL = "concat(" + ", ".join(f"chr({ord(c)})" for c in X.PY_WS) + ")"

# -- fixtures: one expression for Spark and one for SQL -------------------------------------------


def scored_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a score surrogate that has nulls and NaNs; the language stands for a file."""
    n = F.col("doc_id")
    score = F.when(n % 97 == 0, None).when(n % 89 == 0, float("nan")).otherwise((n * 7919 % 1001).cast("double") / 1000)
    return table(spark, sf_dir, "documents").withColumn("score", score)


SCORED_SQL = "(SELECT *, CASE WHEN doc_id % 97 = 0 THEN NULL WHEN doc_id % 89 = 0 THEN CAST('nan' AS DOUBLE) ELSE CAST(doc_id * 7919 % 1001 AS DOUBLE) / 1000 END AS score FROM documents)"


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.from_turns(table(spark, sf_dir, "conversations"))


FIRST_SQL = "(SELECT conv_id, arg_min(role, turn) AS first_role, arg_min(text, turn) AS first_prompt, arg_min(CASE WHEN rk = 2 THEN text END, turn) AS first_answer, count(*) AS turns FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rk FROM conversations) GROUP BY conv_id)"


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A judge's reply for each conversation: full-width punctuation, a fence, spaces; every eleventh is broken."""
    d = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    n = F.col("conv_id")
    digit, tag = (n % 6).cast("string"), F.when(n % 3 == 0, "Math").when(n % 3 == 1, "Coding").otherwise("Other")
    good = F.concat(F.lit('```json\n{ “intent”：“to know ， more”， "knowledge"： "some"，\n"difficulty"： "'), F.when(n % 2 == 0, "easy").otherwise("hard"), F.lit('"， "score": "'), digit, F.lit(' points"， "primary_tag": "'), tag, F.lit('"， "other_tags": ["a"， "b'), digit, F.lit('"] }\n```'))
    return d.withColumn("reply", F.when(n % 11 == 0, F.concat(F.lit('{"score": "'), digit)).otherwise(good))


REPLIES_SQL = """(SELECT conv_id, CASE WHEN conv_id % 11 = 0 THEN '{"score": "' || CAST(conv_id % 6 AS VARCHAR)
 ELSE '```json' || chr(10) || '{ “intent”：“to know ， more”， "knowledge"： "some"，' || chr(10) || '"difficulty"： "' || CASE WHEN conv_id % 2 = 0 THEN 'easy' ELSE 'hard' END || '"， "score": "' || CAST(conv_id % 6 AS VARCHAR) || ' points"， "primary_tag": "' || CASE conv_id % 3 WHEN 0 THEN 'Math' WHEN 1 THEN 'Coding' ELSE 'Other' END || '"， "other_tags": ["a"， "b' || CAST(conv_id % 6 AS VARCHAR) || '"] }' || chr(10) || '```' END AS reply FROM (SELECT DISTINCT conv_id FROM conversations))"""
PLAIN_SQL = f"translate(reply, '{X.CJK_PUNCTUATION}', {sql_text(X.ASCII_PUNCTUATION)})"
BARE_SQL = f"replace(replace(replace(replace({PLAIN_SQL}, '```', ''), chr(10), ''), 'json', ''), ' ', '')"


def repaired_sql(c: str) -> str:
    """Without lookaround: marks that stay are hidden behind chr(1), the rest replaced."""
    for a in "{:,}":
        c = f"replace({c}, '{a}\"', '{a}' || chr(1))"
    for a in "{:,}":
        c = f"replace({c}, '\"{a}', chr(1) || '{a}')"
    return f"replace(replace({c}, '\"', '“'), chr(1), '\"')"


# -- scans and projections ------------------------------------------------------------------------


@query("scan_project_rename", "SELECT doc_id, text, CAST(n_chars AS DOUBLE) / 5 AS labels FROM documents")
def _(spark, sf):
    """Other names for the columns, put right again."""
    d = table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"), F.col("n_chars").alias("score"), "lang")
    d = select.labels_named(select.text_named(d)).drop("lang")
    return d.withColumn("labels", J.normalised(F.col("labels")))


@query("file_provenance_tag", """SELECT doc_id, '/data/' || source || '_' || lang || '/part.json' AS file_name, 'part.json' AS base, 1 AS "new",
 CASE WHEN source LIKE '%src1%' THEN 'one' WHEN source LIKE '%src2%' THEN 'two' ELSE 'rest' END AS model, lang = 'en' AS is_en FROM documents""")
def _(spark, sf):
    """P6, P7, P8, S13, T18, T19 on a path made of source and language."""
    path = F.concat(F.lit("/data/"), F.col("source"), F.lit("_"), F.col("lang"), F.lit("/part.json"))
    model = F.when(F.contains("source", F.lit("src1")), "one").when(F.contains("source", F.lit("src2")), "two").otherwise("rest")
    return table(spark, sf, "documents").select("doc_id", path.alias("file_name"), X.base_name(path).alias("base"), F.lit(1).alias("new"), model.alias("model"), F.contains(path, F.lit("_en")).alias("is_en"))


# -- filters and bands ----------------------------------------------------------------------------


@query("score_floor", f"SELECT doc_id, score FROM {SCORED_SQL} WHERE score >= 0.4 AND NOT isnan(score)")
def _(spark, sf):
    return select.score_floor(scored_docs(spark, sf)).select("doc_id", "score")


BANDED_SQL = f"(SELECT *, CASE WHEN score < 0.8 THEN '0.6-0.8' ELSE '0.8-2' END AS band FROM {SCORED_SQL} WHERE score >= 0.6 AND score < 2)"


@query("score_bands", f"SELECT doc_id, score, band FROM {BANDED_SQL}")
def _(spark, sf):
    return select.banded(scored_docs(spark, sf)).select("doc_id", "score", "band")


@query("band_counts", f"SELECT band, count(*) AS n, count(DISTINCT lang) AS files FROM (SELECT *, row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) AS rk FROM {BANDED_SQL}) WHERE rk = 1 GROUP BY band")
def _(spark, sf):
    """Bands, keep-first within each file, rows of each band."""
    d = dedup.keep_first(select.banded(scored_docs(spark, sf)), "text", ["doc_id"], scope=["lang"])
    return d.groupBy("band").agg(F.count("*").alias("n"), F.countDistinct("lang").alias("files"))


@query("text_and_label_filter", "SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN CAST('nan' AS DOUBLE) ELSE CAST(doc_id % 6 AS DOUBLE) END / 5 AS label FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 13 <> 0")
def _(spark, sf):
    """Rows with a text and a label that reads as a number, NaN being one."""
    n = F.col("doc_id")
    raw = F.when(n % 13 == 0, F.concat((n % 6).cast("string"), F.lit("f"))).when(n % 7 == 0, "nan").otherwise(F.concat(F.lit(" "), (n % 6).cast("string"), F.lit(" ")))
    d = table(spark, sf, "documents").select(n, F.when(n % 5 != 0, F.col("text")).alias("text"), raw.alias("labels"))
    return select.with_number(select.with_text(d)).select("doc_id", J.normalised(J.as_number(F.col("labels"))).alias("label"))


@query("title_filters", "SELECT doc_id, regexp_matches(title, '[0-9]+[年月]$') AS dated, regexp_matches(title, '[a-zA-Z]') AND NOT regexp_matches(title, '[一-鿿]') AS latin, lang = 'en' OR source = 'en' AS tagged, source LIKE '%src1%' AS part FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN '春 ' || doc_id || '年' ELSE text END AS title FROM documents)")
def _(spark, sf):
    """title and tag predicates."""
    title = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("春 "), F.col("doc_id").cast("string"), F.lit("年"))).otherwise(F.col("text"))
    tags = F.array("lang", "source")
    return table(spark, sf, "documents").select("doc_id", select.title_ends_in_date(title).alias("dated"), select.title_is_latin(title).alias("latin"), select.tags_contain(tags, "en", whole=True).alias("tagged"), select.tags_contain(F.array("source"), "src1").alias("part"))


# -- dedup ----------------------------------------------------------------------------------------


@query("dedup_text_per_file", "SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) AS rk FROM documents) WHERE rk = 1")
def _(spark, sf):
    return dedup.keep_first(table(spark, sf, "documents"), "text", ["doc_id"], scope=["lang"]).select("doc_id", "lang")


@query("dedup_text_global", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def _(spark, sf):
    return dedup.keep_first(table(spark, sf, "documents"), "text", ["doc_id"]).select("doc_id")


@query("dedup_md5", "SELECT min(doc_id) AS doc_id, md5(text) AS digest FROM documents GROUP BY text")
def _(spark, sf):
    return dedup.keep_first(table(spark, sf, "documents"), "text", ["doc_id"], how="md5").select("doc_id", dedup.digest(F.col("text")).alias("digest"))


@query("dedup_sha256", "SELECT min(doc_id) AS doc_id, sha256(text) AS digest FROM documents GROUP BY text")
def _(spark, sf):
    return dedup.keep_first(table(spark, sf, "documents"), "text", ["doc_id"], how="sha256").select("doc_id", dedup.digest(F.col("text"), "sha256").alias("digest"))


@query("dedup_xxh3", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def _(spark, sf):
    return dedup.keep_first(table(spark, sf, "documents"), "text", ["doc_id"], how="xxh3_128").select("doc_id")


@query("dedup_flags", "SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS flags FROM documents")
def _(spark, sf):
    """D4 with its flags, F4, P10, J4."""
    return dedup.flagged(table(spark, sf, "documents"), "text", ["doc_id"]).select("doc_id", "flags")


@query("dedup_bloom_approx")
def _(spark, sf):
    """D4, approximate; tests bound what it may lose."""
    return dedup.bloom_keep_first(table(spark, sf, "documents"), "text", ["doc_id"]).select("doc_id")


@query("dedup_against_known", "SELECT doc_id FROM documents WHERE md5(text) NOT IN (SELECT md5(text) FROM documents WHERE lang = 'en')")
def _(spark, sf):
    """J4 over runs: digests of an earlier run are anti-joined."""
    d = table(spark, sf, "documents")
    return dedup.unseen(d, "text", d.where("lang = 'en'").select(dedup.digest(F.col("text")).alias("digest"))).select("doc_id")


# -- sets and implicit joins ----------------------------------------------------------------------


@query("union_concat", "SELECT doc_id, lang, CAST(NULL AS INTEGER) AS quality FROM documents UNION ALL SELECT doc_id, CAST(NULL AS VARCHAR) AS lang, quality FROM labels")
def _(spark, sf):
    return select.bag_concat(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels").select("doc_id", "quality"))


@query("set_union_ids", "SELECT doc_id FROM documents WHERE lang = 'en' UNION SELECT doc_id FROM labels")
def _(spark, sf):
    return select.set_union(table(spark, sf, "documents").where("lang = 'en'").select("doc_id"), table(spark, sf, "labels").select("doc_id"))


@query("set_difference_ids", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def _(spark, sf):
    return select.set_difference(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id"))


@query("semi_anti_survivors", "SELECT doc_id, 'in' AS side FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0) UNION ALL SELECT doc_id, 'out' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, sf):
    d, m = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels")
    return select.surviving(d, m.where("toxic = 0"), "doc_id").withColumn("side", F.lit("in")).unionByName(select.without(d, m, "doc_id").withColumn("side", F.lit("out")))


# -- scalar functions -----------------------------------------------------------------------------


@query("truncate_2000", "SELECT doc_id, CASE WHEN length(text) > 2000 THEN left(text, 2000) || '......' ELSE text END AS excerpt FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.truncated(F.col("text"), 2000).alias("excerpt"))


@query("truncate_800_title", "SELECT doc_id, CASE WHEN length(t) > 800 THEN left(t, 800) || '......' ELSE t END AS excerpt FROM (SELECT doc_id, coalesce(CASE WHEN doc_id % 4 <> 0 THEN source END, '') || chr(10) || text AS t FROM documents)")
def _(spark, sf):
    """The title comes before the cut; a null one counts as empty."""
    title = F.when(F.col("doc_id") % 4 != 0, F.col("source"))
    return table(spark, sf, "documents").select("doc_id", X.truncated(X.titled(title, F.col("text")), 800).alias("excerpt"))


@query("prompt_fill", """SELECT doc_id, 'Rate 100% of {this}: ' || text || ' / ' || lang AS positional, '{"q": "' || text || '"}' AS named FROM documents""")
def _(spark, sf):
    """T4, T5: braces and per cent signs of templates and of values stay."""
    text = F.col("text")
    positional, named = X.filled("Rate 100% of {this}: {} / {}", text, F.col("lang")), X.filled_by_name('{{"q": "{query}"}}', query=text)
    return table(spark, sf, "documents").select("doc_id", positional.alias("positional"), named.alias("named"))


@query("chat_wrap", "SELECT conv_id, '<|im_start|>user' || chr(10) || min(CASE WHEN turn = 0 THEN text END) || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS one_turn, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) || CASE WHEN arg_max(role, turn) = 'user' THEN '<|im_start|>assistant' || chr(10) ELSE '' END || '#' AS prompt FROM conversations GROUP BY conv_id")
def _(spark, sf):
    """T6, T7, T17."""
    c = F.col("conversation")
    return nested(spark, sf).select("conv_id", X.one_turn_prompt(C.first_prompt(c)).alias("one_turn"), X.stop_tokens_replaced(X.conversation_prompt(c, suffix="@"), {"@": "#"}).alias("prompt"))


EDU = "CASE WHEN doc_id % 13 = 0 THEN 'none ' || doc_id ELSE text || '。教育得分：' || chr(10) || CASE WHEN doc_id % 5 = 0 THEN '３' ELSE '约 ' || (doc_id % 10) END || ' 分 5' END"


@query("parse_edu_score", f"SELECT doc_id, translate(nullif(regexp_extract(reply, '教育得分：[\\s\\S]*?([0-9０-９])', 1), ''), '{X.FULL_WIDTH_DIGITS}', '0123456789') AS score FROM (SELECT doc_id, {EDU} AS reply FROM documents)")
def _(spark, sf):
    """T8."""
    n = F.col("doc_id")
    digit = F.when(n % 5 == 0, "３").otherwise(F.concat(F.lit("约 "), (n % 10).cast("string")))
    reply = F.when(n % 13 == 0, F.concat(F.lit("none "), n.cast("string"))).otherwise(F.concat("text", F.lit("。教育得分：\n"), digit, F.lit(" 分 5")))
    return table(spark, sf, "documents").select("doc_id", X.edu_score(reply).alias("score"))


NOISE = "replace(replace(replace(replace(text, ' th', chr(160) || chr(8195) || '□th'), '. ', '.' || chr(13) || chr(10) || chr(13)), ' o', '    o'), ' a', '-----■' || chr(12288) || 'a')"


def _noisy() -> Column:
    c = F.col("text")
    for old, new in ((" th", "  □th"), (". ", ".\r\n\r"), (" o", "    o"), (" a", "-----■　a")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.concat(F.lit(" \x1c "), c, F.lit("  "))


@query("clean_text", f"SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(translate(translate(chr(160) || chr(28) || ' ' || {NOISE} || ' ' || chr(8233), chr(8195) || '□■', ''), chr(160) || chr(12288), '  '), '[\\n\\r]{{2,}}', chr(10) || chr(10), 'g'), ' {{2,}}', '  ', 'g'), '-{{3,}}', '---', 'g'), {WS_SQL}) AS clean FROM documents")
def _(spark, sf):
    """T9, T12."""
    return table(spark, sf, "documents").select("doc_id", X.uniform(_noisy()).alias("clean"))


@query("strip_nbsp", f"SELECT doc_id, replace(chr(160) || chr(28) || ' ' || {NOISE} || ' ' || chr(8233), chr(160), '') AS data FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.without_nbsp(_noisy()).alias("data"))


@query("text_digests", "SELECT doc_id, md5(text) AS m, sha256(text) AS s, length(text) AS n, CASE WHEN source LIKE '%1' THEN left(source, length(source) - 1) || '.x' ELSE source END AS swapped FROM documents")
def _(spark, sf):
    """T18, T20, T21."""
    return table(spark, sf, "documents").select("doc_id", dedup.digest(F.col("text")).alias("m"), dedup.digest(F.col("text"), "sha256").alias("s"), F.length("text").cast("long").alias("n"), X.with_suffix(F.col("source"), "1", ".x").alias("swapped"))


@query("normalise_judge_json", f"SELECT conv_id, {BARE_SQL} AS bare FROM {REPLIES_SQL}")
def _(spark, sf):
    """T13, T14."""
    return replies(spark, sf).select("conv_id", J.reply_json(F.col("reply")).alias("bare"))


@query("repair_inner_quotes", f"SELECT conv_id, turn, {repaired_sql('quoted')} AS repaired FROM (SELECT conv_id, turn, replace(replace(text, ' ', '\"'), 'e', '{{\"') || ':\"a\"b\",\"c\"}}' AS quoted FROM conversations)")
def _(spark, sf):
    """T15, every turn."""
    quoted = F.concat(F.replace(F.replace("text", F.lit(" "), F.lit('"')), F.lit("e"), F.lit('{"')), F.lit(':"a"b","c"}'))
    return table(spark, sf, "conversations").select("conv_id", "turn", X.inner_quotes_repaired(quoted).alias("repaired"))


_OK = f"json_valid({BARE_SQL})"
FIELDS_SQL = f"""(SELECT conv_id, CASE WHEN {_OK} THEN json_extract_string({BARE_SQL}, '$.difficulty') END AS difficulty, CASE WHEN {_OK} THEN json_extract_string({BARE_SQL}, '$.score') END AS score,
 CASE WHEN {_OK} THEN json_extract_string({BARE_SQL}, '$.primary_tag') END AS primary_tag, CASE WHEN {_OK} THEN json_extract_string({BARE_SQL}, '$.other_tags[1]') END AS second_tag, CASE WHEN {_OK} THEN json_extract_string({BARE_SQL}, '$.intent') END AS intent, CASE WHEN {_OK} THEN json_extract_string({BARE_SQL}, '$.knowledge') END AS knowledge FROM {REPLIES_SQL})"""


def fields(spark, sf) -> DataFrame:
    r = F.col("reply")
    cols = {k: J.json_value(r, k) for k in ("difficulty", "score", "primary_tag", "intent", "knowledge")}
    return replies(spark, sf).select("conv_id", *[v.alias(k) for k, v in cols.items()], F.get(J.json_list(r, "other_tags"), 1).alias("second_tag"))


@query("judge_json_fields", f"SELECT conv_id, difficulty, score, primary_tag, second_tag, intent, knowledge FROM {FIELDS_SQL}")
def _(spark, sf):
    """N1, N2."""
    return fields(spark, sf)


@query("judge_filtered", f"SELECT conv_id, difficulty, CAST(regexp_extract(score, '([0-9])', 1) AS INTEGER) AS score, primary_tag FROM {FIELDS_SQL} WHERE difficulty IS NOT NULL AND score IS NOT NULL AND primary_tag IS NOT NULL")
def _(spark, sf):
    """F9, T16."""
    d = select.without_nulls(fields(spark, sf), "difficulty", "score", "primary_tag")
    return d.select("conv_id", "difficulty", X.first_digit(F.col("score")).alias("score"), "primary_tag")


# -- aggregates -----------------------------------------------------------------------------------


@query("length_stats", "SELECT lang, round(avg(length(text)), 6) AS mean_len, max(length(text)) AS max_len, min(length(text)) AS min_len FROM documents GROUP BY lang")
def _(spark, sf):
    """A2."""
    d = metrics.length_stats(table(spark, sf, "documents"), ["lang"])
    return d.select("lang", F.round("mean_len", 6).alias("mean_len"), F.col("max_len").cast("long").alias("max_len"), F.col("min_len").cast("long").alias("min_len"))


@query("score_mean", f"SELECT lang, round(avg(CASE WHEN NOT isnan(score) THEN score END), 6) AS mean_score FROM {SCORED_SQL} GROUP BY lang")
def _(spark, sf):
    """A1: of scores kept as text."""
    d = metrics.mean_score(scored_docs(spark, sf).withColumn("score", F.col("score").cast("string")), ["lang"])
    return d.select("lang", F.round("mean_score", 6).alias("mean_score"))


@query("category_value_counts", f"SELECT primary_tag, count(*) AS n FROM {FIELDS_SQL} WHERE primary_tag IS NOT NULL GROUP BY primary_tag")
def _(spark, sf):
    """A4."""
    return metrics.value_counts(fields(spark, sf), "primary_tag")


@query("category_legal_counts", f"SELECT CASE WHEN primary_tag IN ('Math', 'Coding') THEN primary_tag ELSE 'other' END AS tag, count(*) AS n FROM {FIELDS_SQL} GROUP BY 1")
def _(spark, sf):
    """A10."""
    tag = metrics.legal_or_other(F.col("primary_tag"), ["Math", "Coding"]).alias("tag")
    return fields(spark, sf).groupBy(tag).agg(F.count("*").alias("n"))


@query("distinct_values", f"SELECT DISTINCT primary_tag FROM {FIELDS_SQL}")
def _(spark, sf):
    """A5: null is a value too."""
    return metrics.distinct_values(fields(spark, sf), "primary_tag")


@query("files_by_directory", "SELECT '/data/' || lang AS directory, count(DISTINCT source) AS files FROM documents GROUP BY lang")
def _(spark, sf):
    """A8."""
    return metrics.files_by_directory(table(spark, sf, "documents"), F.concat(F.lit("/data/"), F.col("lang"), F.lit("/"), F.col("source"), F.lit(".parquet")))


@query("pad_labels", "SELECT conv_id, m AS max_size, rtrim(repeat('-100 ', m - n) || repeat('1 ', n)) AS padded FROM (SELECT conv_id, count(*) AS n, max(count(*)) OVER () AS m FROM conversations GROUP BY conv_id)")
def _(spark, sf):
    """Lists filled up on the left to the longest one."""
    d = nested(spark, sf).select("conv_id", F.array_repeat(F.lit(1).cast("double"), F.size("conversation")).alias("l"))
    most = metrics.longest_list(d, "l")
    padded = C.padded(F.col("l"), F.col("max_size"), left=True)
    return d.crossJoin(F.broadcast(most)).select("conv_id", F.col("max_size").cast("long").alias("max_size"), F.array_join(F.transform(padded, lambda x: x.cast("int").cast("string")), " ").alias("padded"))


# -- order and samples ----------------------------------------------------------------------------


@query("head_n_then_filter", "SELECT doc_id FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 300) WHERE lang = 'en'")
def _(spark, sf):
    """O1, O3: the head is taken before the filter."""
    return select.first_rows(table(spark, sf, "documents"), 300, "doc_id").where("lang = 'en'").select("doc_id")


@query("sample_cap", "SELECT doc_id FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || '-0'), doc_id LIMIT 400")
def _(spark, sf):
    """The cap is what the operator is about."""
    return select.sample_cap(table(spark, sf, "documents"), 400).select("doc_id")


@query("sample_cap_whole", SQL["sample_cap"].replace("LIMIT 400", "LIMIT 500000"))
def _(spark, sf):
    """O4 with its own cap."""
    return select.sample_cap(table(spark, sf, "documents")).select("doc_id")


@query("seeded_shuffle_rank", "SELECT doc_id, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || '-1'), doc_id) AS place FROM documents")
def _(spark, sf):
    """Places in a seeded order, numbered by partition so that no task sees all rows."""
    from quillmill.operators.numbering import row_numbers

    d = table(spark, sf, "documents").select("doc_id", select.shuffle_key(1, "doc_id").alias("k"))
    return row_numbers(d, ["k", "doc_id"], "place").select("doc_id", "place")


# -- conversations --------------------------------------------------------------------------------


@query("conversation_build", "SELECT conv_id, count(*) AS turns, string_agg(role, ',' ORDER BY turn) AS roles, md5(string_agg(text, '|' ORDER BY turn)) AS contents, count(*) / 2.0 AS n_turn FROM conversations GROUP BY conv_id")
def _(spark, sf):
    """R1, R4, M4."""
    c = F.col("conversation")
    return nested(spark, sf).select("conv_id", F.size(c).cast("long").alias("turns"), F.array_join(c["role"], ",").alias("roles"), F.md5(F.array_join(c["content"], "|")).alias("contents"), C.turn_pairs(c).alias("n_turn"))


@query("conversation_from_pairs", f"SELECT conv_id, 2 AS turns, first_prompt AS a, first_answer AS b FROM {FIRST_SQL}")
def _(spark, sf):
    """R1 from instruction and response."""
    c = F.col("conversation")
    d = nested(spark, sf).select("conv_id", C.first_prompt(c).alias("instruction"), C.first_answer(c).alias("response"))
    made = d.select("conv_id", C.conversation_of(d).alias("c"))
    return made.select("conv_id", F.size("c").cast("long").alias("turns"), C.first_prompt(F.col("c")).alias("a"), C.first_answer(F.col("c")).alias("b"))


@query("first_prompt_answer", f"SELECT conv_id, first_role, first_prompt, first_answer FROM {FIRST_SQL}")
def _(spark, sf):
    """R2, R3."""
    c = F.col("conversation")
    return nested(spark, sf).select("conv_id", F.get(c, 0)["role"].alias("first_role"), C.first_prompt(c).alias("first_prompt"), C.first_answer(c).alias("first_answer"))


@query("first_prompt_dedup", f"SELECT min(conv_id) AS conv_id FROM (SELECT *, CASE WHEN conv_id % 5 = 0 THEN 'same' WHEN conv_id % 7 = 0 THEN NULL ELSE first_prompt END AS p FROM {FIRST_SQL}) GROUP BY p")
def _(spark, sf):
    """Nulls are equal."""
    n = F.col("conv_id")
    p = F.when(n % 5 == 0, "same").when(n % 7 == 0, None).otherwise(C.first_prompt(F.col("conversation")))
    return dedup.keep_first(nested(spark, sf).withColumn("first_prompt", p), "first_prompt", ["conv_id"]).select("conv_id")


@query("conversation_clean_reject", f"SELECT conv_id, md5(string_agg(clean, '|' ORDER BY turn)) AS contents FROM (SELECT *, trim(replace(replace(CASE WHEN conv_id % 7 = 0 AND turn = 1 THEN ' a||b ' ELSE text || '||<|im_end|>' || chr(12288) END, '||', ''), '<|im_end|>', ''), {WS_SQL}) AS clean FROM conversations) GROUP BY conv_id HAVING min(length(clean)) >= 3")
def _(spark, sf):
    """T11, F11, R4."""
    t = table(spark, sf, "conversations")
    noisy = F.when((F.col("conv_id") % 7 == 0) & (F.col("turn") == 1), " a||b ").otherwise(F.concat("text", F.lit("||<|im_end|>　")))
    d = C.from_turns(t.withColumn("text", noisy)).withColumn("clean", C.cleaned(F.col("conversation"))).where("clean IS NOT NULL")
    return d.select("conv_id", F.md5(F.array_join(F.col("clean")["content"], "|")).alias("contents"))


@query("n_turn_threshold", "SELECT g, n_turn, CAST(CASE WHEN n_turn = 1 THEN 0.7 ELSE 0.85 END AS DOUBLE) AS threshold FROM (SELECT conv_id % 7 AS g, arg_min(n, conv_id) / 2.0 AS n_turn FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id) GROUP BY 1)")
def _(spark, sf):
    """D6."""
    return similarity.group_thresholds(nested(spark, sf).withColumn("g", F.col("conv_id") % 7), ["g"], ["conv_id"])


# -- similarity -----------------------------------------------------------------------------------

KNN_SQL = """(SELECT i, j, s, rank FROM (SELECT i, j, s, row_number() OVER (PARTITION BY i ORDER BY s DESC, j) AS rank FROM
 (SELECT a.vec_id AS i, b.vec_id AS j, list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)) WHERE rank <= 5)"""


def _gone_sql(threshold: float) -> str:
    return f"""WITH RECURSIVE knn AS {KNN_SQL}, e AS (SELECT i AS u, j AS v FROM knn WHERE rank = 1 AND s > {threshold}), b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
 r AS (SELECT u AS id, u AS seen FROM b UNION SELECT r.id, b.v FROM r JOIN b ON r.seen = b.u), l AS (SELECT id, min(seen) AS label FROM r GROUP BY id) """


@query("knn_top5", f'SELECT i, j, round(s, 6) AS score, "rank" FROM {KNN_SQL}')
def _(spark, sf):
    """V2, J1, O7, M5, P13."""
    d = similarity.nearest(table(spark, sf, "embeddings"))
    return d.select("i", "j", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("knn_lists", f"SELECT i, array_to_string(list(j ORDER BY rank), ',') AS nn, round(max(CASE WHEN rank = 1 THEN s END), 6) AS first_score FROM {KNN_SQL} GROUP BY i")
def _(spark, sf):
    """Neighbours as lists."""
    d = similarity.neighbour_lists(similarity.nearest(table(spark, sf, "embeddings")))
    return d.select("i", F.array_join(F.transform("nn_indices", lambda x: x.cast("string")), ",").alias("nn"), F.round(similarity.first_of(F.col("nn_scores")), 6).alias("first_score"))


@query("similarity_edges", f"SELECT i AS u, j AS v FROM {KNN_SQL} WHERE rank = 1 AND s > 0.4")
def _(spark, sf):
    return similarity.edges(similarity.nearest(table(spark, sf, "embeddings"), 1), 0.4)


@query("component_labels", _gone_sql(0.4) + "SELECT id, label FROM l")
def _(spark, sf):
    """D5, A6."""
    from quillmill.operators.components import component_labels

    return component_labels(similarity.edges(similarity.nearest(table(spark, sf, "embeddings"), 1), 0.4))


@query("similarity_dedup", _gone_sql(0.4) + "SELECT vec_id FROM embeddings WHERE vec_id NOT IN (SELECT id FROM l WHERE id <> label)")
def _(spark, sf):
    """D5, J2, J3, U3, U4."""
    d = table(spark, sf, "embeddings")
    return similarity.similarity_dedup(d, similarity.nearest(d, 1), 0.4).select("vec_id")


@query("similarity_dedup_strict", _gone_sql(0.85) + "SELECT vec_id FROM embeddings WHERE vec_id NOT IN (SELECT id FROM l WHERE id <> label)")
def _(spark, sf):
    d = table(spark, sf, "embeddings")
    return similarity.similarity_dedup(d, similarity.nearest(d, 1), 0.85).select("vec_id")


@query("dedup_then_score_filter", _gone_sql(0.4) + "SELECT vec_id, vec_id * 7 % 6 AS score FROM embeddings WHERE vec_id NOT IN (SELECT id FROM l WHERE id <> label) AND vec_id * 7 % 6 >= 3")
def _(spark, sf):
    """F10 after D5: a component whose representative scores low is gone."""
    d = table(spark, sf, "embeddings").withColumn("score", F.col("vec_id") * 7 % 6)
    return select.at_least(similarity.similarity_dedup(d, similarity.nearest(d, 1), 0.4), "score", 3).select("vec_id", "score")


# -- generation, models, flows --------------------------------------------------------------------

_CUTS, _total = [], 0.0
for _name, _w in list(models.CATEGORIES.items())[:-1]:
    _total = round(_total + _w, 9)
    _CUTS.append(f"WHEN u < {_total} THEN '{_name}'")


@query("category_sampling", f"SELECT k AS system_prompt_key, count(*) AS n FROM (SELECT CASE {' '.join(_CUTS)} ELSE '{list(models.CATEGORIES)[-1]}' END AS k FROM (SELECT CAST('0x' || left(md5(CAST(i AS VARCHAR)), 8) AS BIGINT) / 4294967296.0 AS u FROM range(100000) t(i))) GROUP BY k")
def _(spark, sf):
    """Categories of 100 000 seeds."""
    return models.conversation_seeds(spark, 100_000).groupBy("system_prompt_key").agg(F.count("*").alias("n"))


@query("category_prompts", "SELECT DISTINCT primary_tag, CASE primary_tag WHEN 'Math' THEN 'count' WHEN 'Coding' THEN 'write' END AS prompt FROM " + FIELDS_SQL + " WHERE primary_tag IS NOT NULL")
def _(spark, sf):
    """A lookup in a table of two rows, which is broadcast."""
    lookup = spark.createDataFrame([("Math", "count"), ("Coding", "write")], "primary_tag string, prompt string")
    tags = fields(spark, sf).where("primary_tag IS NOT NULL").select("primary_tag").distinct()
    return tags.join(F.broadcast(lookup), "primary_tag", "left")


@query("stream_new_texts", "SELECT md5(text) AS digest FROM documents GROUP BY text")
def _(spark, sf):
    """Streaming keep-one over the documents file; the rows that it writes, by digest."""
    from quillmill.staging import fresh_path
    from quillmill.streaming import dedup as stream

    source = f"{sf}/documents.parquet"
    out, state = fresh_path(spark, "stream"), fresh_path(spark, "stream-state")
    new = stream.new_texts(spark, f"{sf}/documents.parque[t]", spark.read.parquet(source).schema)
    stream.run_available(new, out, state)
    return spark.read.parquet(out).select("digest")


@query("partitioned_write_roundtrip", "SELECT lang, count(*) AS n, sum(n_chars) AS chars FROM documents GROUP BY lang")
def _(spark, sf):
    """Written by key, read back by partition."""
    from quillmill.sources import sinks
    from quillmill.staging import fresh_path

    path = fresh_path(spark, "by-lang")
    sinks.by_column(table(spark, sf, "documents"), path, "lang")
    return spark.read.parquet(path).groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("resume_manifest", "SELECT lang AS file_name, count(*) AS n FROM documents GROUP BY lang")
def _(spark, sf):
    """Two runs, the second over what the first left."""
    from quillmill.sources import sinks
    from quillmill.staging import fresh_path

    path = fresh_path(spark, "resumed")
    d = table(spark, sf, "documents").withColumn("file_name", F.col("lang"))
    sinks.resume(spark, d.where("lang IN ('de', 'en')"), path, lambda x: x)
    sinks.resume(spark, d, path, lambda x: x)
    return spark.read.parquet(path).groupBy("file_name").agg(F.count("*").alias("n"))


@query("ingest_floor", f"SELECT count(*) AS n, round(sum(score), 6) AS total FROM {SCORED_SQL} WHERE score >= 0.4 AND NOT isnan(score)")
def _(spark, sf):
    """The scored documents, written as files and taken in again."""
    from quillmill.staging import fresh_path

    path = fresh_path(spark, "scored")
    scored_docs(spark, sf).select("text", "score").write.parquet(path)
    d = readers.ingest(spark, [path])
    return d.agg(F.count("*").alias("n"), F.round(F.sum("score"), 6).alias("total"))
