"""Chat formatting with linked tool calls.

A message whose text is a JSON object with ``tool_calls`` makes calls; a message of the
role ``tool`` whose text is a JSON object with ``tool_call_id`` is a result.  Calls and
results are linked by a hash join on conversation and identifier: the first call with an
identifier, and the first result at or after it, or else the first result.

Messages are ordered topologically: a result comes after its call, and a call after the
results that its arguments name, as ``{"$ref": identifier}``.  The order is given by
three columns.  ``order_turn`` is the latest turn among a message and all that must come
before it, ``order_level`` the length of the longest chain of such messages, and then the
turn itself; a conversation whose turns are in order already keeps them.  Chains, in which
every message waits for one other, are contracted by pointer doubling; messages that wait
for several are then peeled off round by round.  Only edges are looked at, so no conversation
has to fit in a task.  What waits on a cycle is marked and left at its turn.

Arguments are checked against the tool's schema (a subset of JSON Schema: type,
properties, required, additionalProperties, items, enum, const, minimum, maximum,
minLength, maxLength, pattern, minItems, maxItems, anyOf).  Every message is serialised as canonical JSON:
keys sorted, no spaces, characters as themselves.

Defined cases: a null role counts as "user" and a null text as empty.  Text that is no such
JSON is content as it is.  A null conversation id is a conversation of its own kind, a null
turn comes first.  Repeated rows are one message and all get its row's values.  Calls
without identifier or name are content, not calls.  Extra columns are dropped.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.staging import stage

# Schemas that the query checks against; callers bring their own.
SCHEMAS = {
    "search": {"type": "object", "properties": {"query": {"type": "string", "minLength": 1}, "top_k": {"type": "integer", "minimum": 1}}, "required": ["query"], "additionalProperties": False},
    "calculate": {"type": "object", "properties": {"expression": {"type": "string"}}, "required": ["expression"], "additionalProperties": False},
}
TYPES = {"string": str, "array": list, "object": dict, "boolean": bool, "null": type(None)}


def faults(value, schema: dict, at: str = "$") -> list[str]:
    """What a value has against a schema; a reference to a result fits everywhere."""
    if isinstance(value, dict) and set(value) == {"$ref"} and isinstance(value["$ref"], str):
        return []
    out = []
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        if not any(number and (k == "number" or float(value).is_integer()) if k in ("number", "integer") else isinstance(value, TYPES.get(k, ())) for k in kinds):
            return [f"{at}: not of type {'|'.join(kinds)}"]
    if "enum" in schema and value not in schema["enum"] or "const" in schema and value != schema["const"]:
        out.append(f"{at}: not an allowed value")
    if "anyOf" in schema and all(faults(value, s, at) for s in schema["anyOf"]):
        out.append(f"{at}: fits no alternative")
    if isinstance(value, (int, float)) and not isinstance(value, bool) and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        out.append(f"{at}: out of range")
    if isinstance(value, str):
        if not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
            out.append(f"{at}: of wrong length")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            out.append(f"{at}: does not match")
    if isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
            out.append(f"{at}: of wrong length")
        for k, x in enumerate(value if "items" in schema else []):
            out += faults(x, schema["items"], f"{at}[{k}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += faults(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}.{k}: not expected")
            elif isinstance(schema.get("additionalProperties"), dict):
                out += faults(value[k], schema["additionalProperties"], f"{at}.{k}")
    return out


def canonical(value) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def _no_constant(name: str):
    raise ValueError(name)


def _references(value) -> set[str]:
    """The identifiers that arguments name; the depth of JSON that json.loads takes bounds the recursion."""
    if isinstance(value, dict):
        own = {value["$ref"]} if set(value) == {"$ref"} and isinstance(value["$ref"], str) else set()
        return own.union(*map(_references, value.values()))
    return set().union(*map(_references, value)) if isinstance(value, list) else set()


def _call(x, schemas: dict) -> dict | None:
    """A call in the plain or in the nested form as one: id, name, arguments, what is against them."""
    if not isinstance(x, dict):
        return None
    inner = x.get("function") if isinstance(x.get("function"), dict) else x
    name, arguments = inner.get("name"), inner.get("arguments", {})
    if not isinstance(x.get("id"), str) or not isinstance(name, str):
        return None
    wrong = []
    if isinstance(arguments, str):
        try:
            arguments = json.loads(arguments, parse_constant=_no_constant)
        except (ValueError, RecursionError):
            wrong = ["$: not JSON"]
    if not wrong:
        wrong = faults(arguments, schemas[name]) if name in schemas else ["unknown tool"]
    return {"id": x["id"], "name": name, "arguments": arguments, "wrong": wrong, "refs": sorted(_references(arguments))}


def parsed(role: str | None, text: str | None, schemas: dict) -> dict:
    """A message's parts: canonical JSON, calls, and the identifier that it is a result of."""
    role, text = role if role is not None else "user", text or ""
    message, calls, result = {"role": role, "content": text}, [], None
    if text.lstrip()[:1] == "{":
        try:
            body = json.loads(text, parse_constant=_no_constant)
            if isinstance(body.get("tool_calls"), list):
                calls = [_call(x, schemas) for x in body["tool_calls"]]
                if not calls or None in calls:
                    calls = []
                else:
                    content = body.get("content")
                    content = content if isinstance(content, str) else "" if content is None else canonical(content)
                    message = {"role": role, "content": content, "tool_calls": [{k: c[k] for k in ("id", "name", "arguments")} for c in calls]}
            elif role == "tool" and isinstance(body.get("tool_call_id"), str):
                result, content = body["tool_call_id"], body.get("content", "")
                message = {"role": role, "tool_call_id": result, "content": content if isinstance(content, str) else canonical(content)}
            return {"json": canonical(message), "calls": calls, "result": result}
        except (ValueError, RecursionError, AttributeError):
            message, calls, result = {"role": role, "content": text}, [], None
    return {"json": canonical(message), "calls": calls, "result": result}


PARSED = "conv_id long, turn long, role string, node string, json string, calls array<struct<id:string,name:string,refs:array<string>,wrong:array<string>>>, result string"


def messages(conversations: DataFrame, schemas: dict) -> DataFrame:
    """The distinct messages with their parts; ``node`` names a message."""
    node = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in ("conv_id", "turn", "role", "text")]), 256)
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), node.alias("node"), F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.list_(pa.struct([("id", pa.string()), ("name", pa.string()), ("refs", pa.list_(pa.string())), ("wrong", pa.list_(pa.string()))]))
        for b in batches:
            got = [parsed(r, t, schemas) for r, t in zip(b.column(2).to_pylist(), b.column(4).to_pylist(), strict=True)]
            calls = [[{k: c[k] for k in ("id", "name", "refs", "wrong")} for c in g["calls"]] for g in got]
            made = [pa.array([g["json"] for g in got], pa.string()), pa.array(calls, struct), pa.array([g["result"] for g in got], pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], *made], names=["conv_id", "turn", "role", "node", "json", "calls", "result"])

    return rows.mapInArrow(run, PARSED)


def link(parts: DataFrame) -> DataFrame:
    """``(conv_id, id, name, wrong, refs, call, call_turn, result)``: each identifier's first call and the node of its result, or null."""
    place = F.coalesce("turn", F.lit(-(1 << 62))).alias("at")
    calls = parts.select("conv_id", "node", "turn", F.inline("calls")).select("conv_id", "id", F.struct(place, "node", "turn", "name", "wrong", "refs").alias("c"))
    first = calls.groupBy("conv_id", "id").agg(F.min("c").alias("c"), F.count("*").alias("n_calls"))
    results = parts.where("result IS NOT NULL").select(F.col("conv_id").alias("rc"), F.col("result").alias("rid"), F.col("node").alias("rnode"), F.col("turn").alias("rturn"))
    joined = first.join(results, F.col("conv_id").eqNullSafe(F.col("rc")) & (F.col("id") == F.col("rid")), "left")
    early = F.coalesce(F.col("rturn") < F.col("c.turn"), F.lit(False))
    best = F.min(F.when(F.col("rnode").isNotNull(), F.struct(early.alias("early"), F.coalesce("rturn", F.lit(-(1 << 62))).alias("rturn"), "rnode")))
    linked = joined.groupBy("conv_id", "id").agg(F.first("c").alias("c"), best.alias("r"))
    ends = F.col("c.node").alias("call"), F.col("c.turn").alias("call_turn"), F.col("r.rnode").alias("result")
    return linked.select("conv_id", "id", "c.name", "c.wrong", "c.refs", *ends)


class _Done:
    """Rows that are final, in tables of which none is as large as the sum of those behind it: a row is written again log times."""

    def __init__(self, first: DataFrame) -> None:
        self.parts: list[tuple[int, DataFrame]] = [(1, first)]

    def add(self, more: DataFrame) -> None:
        size = 1
        while self.parts and self.parts[-1][0] <= size:
            n, last = self.parts.pop()
            more, size = stage(last.unionByName(more), "done"), size + n
        self.parts.append((size, more))

    def table(self) -> DataFrame:
        out = self.parts[0][1]
        for _, part in self.parts[1:]:
            out = out.unionByName(part)
        return out


def chains(touched: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with one edge into them, and what they hang on, by pointer doubling.

    ``(node, at, steps, most)``: the nearest node before it that has none or several edges
    into it, how many edges away, and the latest turn on the way, its own included; and the
    nodes that go round in a circle or come after one.  A chain of n takes log n rounds.
    """
    single = edges.groupBy("after").agg(F.min("before").alias("at"), F.count("*").alias("n")).where("n = 1").drop("n").withColumnRenamed("after", "node")
    now = stage(single.join(touched, "node").select("node", "at", F.lit(1).cast("long").alias("steps"), F.col("turn").alias("most")), "chains")
    rounds = int(now.count()).bit_length()
    for _ in range(rounds + 1):
        ahead = now.select(F.col("node").alias("at"), F.col("at").alias("next"), F.col("steps").alias("s"), F.col("most").alias("m"))
        joined = now.join(ahead, "at", "left")
        steps = (F.col("steps") + F.coalesce("s", F.lit(0))).alias("steps")
        step = joined.select("node", F.coalesce("next", "at").alias("at"), steps, F.greatest("most", "m").alias("most"), F.col("next").isNotNull().alias("open"))
        step = stage(step, "chains")
        if not step.where("open").limit(1).count():
            return step.drop("open"), step.select("node").limit(0)
        now = step.drop("open")
    return step.where("NOT open").drop("open"), step.where("open").select("node")


def levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node, order_turn, order_level, cyclic)`` for the nodes (node, turn) that edges (before, after) touch.

    Chains are contracted first, so rounds are as many as there are messages in a row that
    wait for several others.
    """
    edges = stage(edges.distinct(), "edges")
    touched = nodes.join(edges.select(F.explode(F.array("before", "after")).alias("node")).distinct(), "node").select("node", "turn").dropDuplicates(["node"])
    touched = stage(touched, "touched")
    hung, stuck = chains(touched, edges)
    several = edges.groupBy("after").agg(F.count("*").alias("n")).where("n > 1").select(F.col("after").alias("node"))
    first = touched.join(edges.select(F.col("after").alias("node")).distinct(), "node", "left_anti")
    done = _Done(stage(first.select("node", F.col("turn").alias("order_turn"), F.lit(0).cast("long").alias("order_level")), "done"))
    joins = stage(several.join(touched, "node"), "joins")
    # edges into these, each from what its chain hangs on
    into = edges.join(joins.select(F.col("node").alias("after")), "after").join(touched.select(F.col("node").alias("before"), F.col("turn").alias("own")), "before")
    way = hung.select(F.col("node").alias("before"), "at", "steps", "most")
    steps = (F.coalesce("steps", F.lit(0)) + 1).alias("steps")
    into = into.join(way, "before", "left").select("after", F.coalesce("at", "before").alias("before"), steps, F.coalesce("most", "own").alias("most"))
    into = stage(into, "into")
    while joins.limit(1).count():
        known = into.join(joins.select(F.col("node").alias("after")), "after").join(done.table().withColumnRenamed("node", "before"), "before", "left")
        free = known.groupBy(F.col("after").alias("node")).agg(
            F.max(F.greatest("order_turn", "most")).alias("t"),
            F.max(F.col("order_level") + F.col("steps")).alias("order_level"),
            F.count_if(F.col("order_level").isNull()).alias("open"),
        )
        more = stage(joins.join(free.where("open = 0"), "node").select("node", F.greatest("turn", "t").alias("order_turn"), "order_level"), "more")
        if not more.limit(1).count():
            break
        joins = stage(joins.join(more.select("node"), "node", "left_anti"), "joins")
        done.add(more)
    known = done.table()
    ends = known.select(F.col("node").alias("at"), F.col("order_turn").alias("t"), F.col("order_level").alias("l"))
    along = hung.join(ends, "at", "left").select("node", F.greatest("t", "most").alias("order_turn"), (F.col("l") + F.col("steps")).alias("order_level"))
    placed = known.unionByName(along.where("order_level IS NOT NULL")).withColumn("cyclic", F.lit(False))
    waits = along.where("order_level IS NULL").select("node").unionByName(joins.select("node")).unionByName(stuck)
    waits = waits.join(touched, "node").select("node", F.col("turn").alias("order_turn"), F.lit(0).cast("long").alias("order_level"), F.lit(True).alias("cyclic"))
    return placed.unionByName(waits).withColumn("order_level", F.col("order_level").cast("int"))


def format_chat(conversations: DataFrame, schemas: dict | None = None) -> DataFrame:
    """One row for each message: its canonical JSON, its place in the order, its links and what is wrong with them."""
    parts = stage(messages(conversations, SCHEMAS if schemas is None else schemas), "messages")
    active = parts.where("size(calls) > 0 OR result IS NOT NULL").dropDuplicates(["node"])
    links = stage(link(active), "links")
    if not links.limit(1).count():
        placed = parts.sparkSession.createDataFrame([], "node string, order_turn long, order_level int, cyclic boolean")
    else:
        results = links.where("result IS NOT NULL").select(F.col("call").alias("before"), F.col("result").alias("after"))
        named = links.select(F.col("conv_id").alias("c"), F.col("call").alias("after"), F.explode("refs").alias("ref"))
        target = links.select("conv_id", F.col("id").alias("ref"), F.coalesce("result", "call").alias("before"))
        refs = named.join(target, F.col("c").eqNullSafe(F.col("conv_id")) & (named.ref == target.ref)).select("before", "after")
        placed = levels(active.select("node", "turn"), results.unionByName(refs))
    wrong = F.array_sort(F.flatten(F.collect_list(F.transform("wrong", lambda w: F.concat(F.col("id"), F.lit(" "), w)))))
    per_call = links.groupBy(F.col("call").alias("node")).agg(
        F.count("*").alias("n_calls"), F.count("result").alias("n_linked"), F.count_if(F.size("wrong") > 0).alias("n_invalid"), wrong.alias("faults")
    )
    linked = links.where("result IS NOT NULL").select(F.col("result").alias("node"), F.lit(True).alias("is_linked")).distinct()
    out = parts.join(placed, "node", "left").join(per_call, "node", "left").join(linked, "node", "left")
    return out.select(
        "conv_id",
        "turn",
        F.coalesce("order_turn", "turn").alias("order_turn"),
        F.coalesce("order_level", F.lit(0)).alias("order_level"),
        F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        F.coalesce("role", F.lit("user")).alias("role"),
        F.size("calls").alias("calls_made"),
        F.coalesce("n_linked", F.lit(0)).alias("calls_linked"),
        F.coalesce("n_invalid", F.lit(0)).alias("calls_invalid"),
        F.concat_ws("; ", "faults").alias("faults"),
        (F.col("result").isNotNull() & F.col("is_linked").isNull()).alias("orphan_result"),
        "json",
    )


def op10_chat(spark, sf_dir: str) -> DataFrame:
    """Query: every message of every conversation as canonical JSON, ordered and linked."""
    return format_chat(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def with_calls(conversations: DataFrame) -> DataFrame:
    """A table with calls, made of (conv_id, turn) of conversations alone: each row becomes a call and its result.

    Every third result comes before its call, every sixth names no call; of four calls in a row the later ones refer to
    the one before; some have arguments out of range, some name a tool that no schema is known of.
    """
    c, t = F.col("conv_id"), F.col("turn")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    query = F.when(t % 4 == 0, text('"q', c, "-", t, '"')).otherwise(text('{"$ref": "c', t - 1, '"}'))
    name = F.when(t % 7 == 6, "lookup").otherwise("search")
    k = F.when(t % 5 == 2, 0).otherwise(t + 1)
    call = text('{"tool_calls": [{"id": "c', t, '", "name": "', name, '", "arguments": {"top_k": ', k, ', "query": ', query, "}}]}")
    answer = text('{"tool_call_id": "', F.when(t % 6 == 5, "x").otherwise("c"), t, '", "content": "r', t, '"}')
    at = 10 * t + 5
    back = at + F.when((c + t) % 3 == 0, -13).otherwise(2)
    made = F.array(
        F.struct(at.alias("turn"), F.lit("assistant").alias("role"), call.alias("text")),
        F.struct(back.alias("turn"), F.lit("tool").alias("role"), answer.alias("text")),
    )
    return conversations.select("conv_id", F.inline(made))


def op10_linked(spark, sf_dir: str) -> DataFrame:
    """Query: the same over a table in which every message is a call or a result, made of the given conversations."""
    return format_chat(with_calls(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
