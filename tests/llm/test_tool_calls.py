import json

from quillmill.llm import tool_calls as C

J = json.dumps
SCHEMA = "conv_id long, turn long, role string, text string, json int"


def call(i, name="search", **arguments):
    return {"id": i, "name": name, "arguments": arguments or {"query": "q"}}


def rows_of(spark, rows):
    return C.format_chat(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)).collect()


def test_links_orders_and_checks(spark):
    rows = [
        (1, 0, "tool", J({"tool_call_id": "b", "content": {"z": 1, "a": "é"}})),
        (1, 1, "assistant", J({"tool_calls": [call("b", "calculate", expression={"$ref": "a"})]})),
        (1, 2, "assistant", J({"content": None, "tool_calls": [call("a", query="x", top_k=0), {"id": "n", "function": {"name": "search", "arguments": '{"query": "y"}'}}]})),
        (1, 3, "tool", J({"tool_call_id": "a", "content": "r"})),
        (1, 4, "tool", J({"tool_call_id": "zz", "content": "r"})),
        (2, 0, "tool", J({"tool_call_id": "a", "content": "another conversation"})),
    ]
    got = {(r.conv_id, r.turn): r for r in rows_of(spark, rows)}
    order = sorted((r for r in got.values() if r.conv_id == 1), key=lambda r: (r.order_turn, r.order_level, r.turn))
    assert [r.turn for r in order] == [2, 3, 1, 0, 4] and not any(r.cyclic for r in order)
    assert got[1, 2].calls_made == 2 and got[1, 2].calls_linked == 1 and got[1, 2].calls_invalid == 1 and got[1, 2].faults == "a $.top_k: out of range"
    assert got[1, 4].orphan_result and got[2, 0].orphan_result and not got[1, 3].orphan_result
    assert got[1, 0].json == '{"content":"{\\"a\\":\\"é\\",\\"z\\":1}","role":"tool","tool_call_id":"b"}'
    assert json.loads(got[1, 2].json)["tool_calls"][1] == {"id": "n", "name": "search", "arguments": {"query": "y"}}


def test_cycles_are_marked(spark):
    rows = [(3, 0, "assistant", J({"tool_calls": [call("p", "calculate", expression={"$ref": "q"})]})), (3, 1, "tool", J({"tool_call_id": "p"})), (3, 2, "assistant", J({"tool_calls": [call("q", "calculate", expression={"$ref": "p"})]})), (3, 3, "tool", J({"tool_call_id": "q"})), (3, 4, "user", "ok")]
    got = sorted(rows_of(spark, rows), key=lambda r: r.turn)
    assert [r.cyclic for r in got] == [True] * 4 + [False] and [r.order_turn for r in got] == [0, 1, 2, 3, 4]


def test_order_against_brute_force(spark):
    """Chains of calls in shuffled turns: every message comes after all that it waits for."""
    import random

    r = random.Random(2)
    rows, waits = [], {}
    for conv in range(6):
        turns = list(range(12))
        r.shuffle(turns)
        for k in range(6):
            prior = f"c{r.randrange(k)}" if k and r.random() < 0.7 else None
            rows.append((conv, turns[2 * k], "assistant", J({"tool_calls": [call(f"c{k}", "calculate", expression={"$ref": prior} if prior else "1")]})))
            rows.append((conv, turns[2 * k + 1], "tool", J({"tool_call_id": f"c{k}", "content": "x"})))
            waits[conv, turns[2 * k + 1]] = (conv, turns[2 * k])
            if prior:
                waits[conv, turns[2 * k]] = (conv, turns[2 * int(prior[1:]) + 1])
    place = {(x.conv_id, x.turn): (x.order_turn, x.order_level) for x in rows_of(spark, rows)}
    for later, before in waits.items():
        assert place[before] < place[later]
    for x in place:
        chain, y = [x[1]], x
        while y in waits:
            y = waits[y]
            chain.append(y[1])
        assert place[x] == (max(chain), len(chain) - 1)


def test_messages_that_wait_for_several(spark):
    """Levels and turns against a plain topological order, cycles and all that come after them included."""
    import random

    r = random.Random(11)
    edges = {(f"n{j}", f"n{k}") for k in range(60) for j in r.sample(range(k), min(k, r.choice([0, 1, 1, 2, 3])))}
    edges |= {(f"m{k}", f"m{k + 1}") for k in range(20)} | {("m20", "n59"), ("z1", "z2"), ("z2", "z1"), ("z2", "z3"), ("z3", "n58"), ("s", "s")}
    names = sorted({x for e in edges for x in e})
    turn = {x: None if k % 17 == 0 else r.randrange(1000) for k, x in enumerate(names)}
    before = {x: [a for a, b in edges if b == x] for x in names}
    want, open_ = {}, set(names)
    while ready := [x for x in open_ if all(b in want for b in before[x])]:
        for x in ready:
            turns = [t for t in [turn[x], *(want[b][0] for b in before[x])] if t is not None]
            want[x] = (max(turns, default=None), max((want[b][1] + 1 for b in before[x]), default=0), False)
        open_ -= set(ready)
    want |= {x: (turn[x], 0, True) for x in open_}
    nodes = spark.createDataFrame([(x, turn[x]) for x in names] + [("alone", 5)], "node string, turn long")
    got = C.levels(nodes, spark.createDataFrame(sorted(edges) + sorted(edges)[:3], "before string, after string"))
    assert {x.node: (x.order_turn, x.order_level, x.cyclic) for x in got.collect()} == want


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    staged = []
    whole = C.stage
    monkeypatch.setattr(C, "stage", lambda df, label: staged.append(label) or whole(df, label))
    n = 10_000
    nodes = spark.range(n).selectExpr("CAST(id AS string) AS node", "(id * 7919) % 10007 AS turn")
    edges = spark.range(1, n).selectExpr("CAST(id - 1 AS string) AS before", "CAST(id AS string) AS after")
    got = {int(x.node): (x.order_turn, x.order_level) for x in C.levels(nodes, edges).collect()}
    top = 0
    for k in range(n):
        top = max(top, k * 7919 % 10007)
        assert got[k] == (top, k)
    assert len(staged) < 25


def test_linked_query_against_its_sql(spark, tiny):
    import duckdb

    from quillmill.llm.queries import OP10_LINKED_SQL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tiny}/conversations.parquet')")
    df = C.op10_linked(spark, tiny)
    names = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({OP10_LINKED_SQL})").fetchall()
    got = df.select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert sum(r.calls_linked for r in got) > 0 and any(r.faults for r in got) and any(r.order_turn != r.turn for r in got) and any(r.orphan_result for r in got)


def test_odd_rows(spark):
    long = "x" * 200_000
    rows = [(None, None, None, None), (1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "assistant", '{"tool_calls": 3}'), (1, 2, "user", "{bad"), (1, 3, "assistant", '{"tool_calls": [{"id": 1}]}'), (1, 4, "user", long), (1, 5, "user", '{"a": NaN, "tool_calls": []}'), (1, 6, "tool", "[" * 5000), (1, 7, "user", "")]
    rows += [(2, 0, "assistant", J({"tool_calls": [call("a")]}))] * 2 + [(2, 1, "assistant", J({"tool_calls": [call("a", query="second")]})), (2, 2, "tool", J({"tool_call_id": "a", "content": "1"})), (2, 3, "tool", J({"tool_call_id": "a", "content": "2"}))]
    got = rows_of(spark, rows)
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert json.loads(by[None, None].json) == {"role": "user", "content": ""} and by[1, 1].calls_made == 0
    for t in range(1, 8):
        text = next(x[3] for x in rows if x[:2] == (1, t))
        assert json.loads(by[1, t].json)["content"] == text
    assert by[2, 0].calls_linked == 1 and by[2, 1].calls_linked == 0 and not by[2, 2].orphan_result and by[2, 3].orphan_result
    assert rows_of(spark, rows)[0].json and C.format_chat(spark.createDataFrame([], SCHEMA)).count() == 0


def test_schema_faults():
    s = {"type": "object", "properties": {"n": {"type": ["integer", "null"], "maximum": 5}, "l": {"type": "array", "items": {"enum": ["a", "b"]}, "maxItems": 2}, "s": {"type": "string", "pattern": "^x", "maxLength": 3}, "u": {"anyOf": [{"type": "string"}, {"const": 1}]}}, "required": ["n"], "additionalProperties": {"type": "boolean"}}
    ok = [{"n": 5}, {"n": None, "l": ["a"]}, {"n": 2.0, "s": "xy", "u": 1, "z": True}, {"n": {"$ref": "k"}}]
    bad = [{}, {"n": 6}, {"n": "1"}, {"n": True}, {"n": 1, "l": ["c"]}, {"n": 1, "l": ["a"] * 3}, {"n": 1, "s": "yx"}, {"n": 1, "s": "xxxx"}, {"n": 1, "u": 2}, {"n": 1, "z": 0}, 3, []]
    assert not any(C.faults(x, s) for x in ok) and all(C.faults(x, s) for x in bad)


def test_query(spark, tiny):
    rows = C.op10_chat(spark, tiny).collect()
    want = sorted((r.conv_id, r.turn, C.canonical({"role": r.role, "content": r.text})) for r in spark.read.parquet(f"{tiny}/conversations.parquet").collect())
    assert sorted((r.conv_id, r.order_turn, r.json) for r in rows) == want
