import json
import random

from pyspark.sql import functions as F

from tidewell.llm import chat_tools as C

SCHEMAS = {"add": [("a", "number", True), ("b", "integer", False)], "note": [("text", "string", True), ("tags", "array", False), ("open", "boolean", False), ("more", "object", False)]}
CALLS = [
    ("x", "c1", 1, "add", '{"b": 2, "a": 1.50}', []),
    ("x", "c2", 2, "add", '{"a":"no","z":1}', ["c1"]),
    ("x", "c3", 3, "note", '{"text":"t","tags":[1],"open":true,"more":{"k":null}}', ["c2", "c1", "absent"]),
    ("x", "c3", 9, "note", "{}", []),
    ("x", "c4", 4, "odd", "{}", None),
    ("x", "c5", 5, "note", "{broken", ["c6"]),
    ("x", "c6", 6, "note", None, ["c5"]),
    ("x", "c7", 7, "note", '{"text":null}', ["c6"]),
    ("y", "c1", 1, None, "{}", []),
    (None, "c1", 1, "add", "{}", []),
    ("x", None, 1, "add", "{}", []),
]
RESULTS = [("x", "c1", 3, "three"), ("x", "c1", 2, "two"), ("x", "c2", 1, "early"), ("x", "zz", 4, "lost"), ("y", "c1", 2, None), (None, "c1", 2, "n")]


def linked(spark, calls=CALLS, results=RESULTS):
    c = spark.createDataFrame(calls, "conv_id string, call_id string, turn bigint, name string, arguments string, depends_on array<string>")
    r = spark.createDataFrame(results, "conv_id string, call_id string, turn bigint, content string")
    return C.link(c, r, SCHEMAS)


def test_links_waves_and_errors(spark):
    got = {(r.conv_id, r.call_id, r.status): r for r in linked(spark).collect()}
    assert len(got) == 10
    assert got["x", "c1", "linked"].wave == 0 and json.loads(got["x", "c1", "linked"].json)["result"] == "two"
    assert got["x", "c1", "linked"].json.startswith('{"arguments":{"a":1.5,"b":2},"call_id":"c1","errors":[],"name":"add",')
    assert got["x", "c2", "unanswered"].errors == ["type:a", "unexpected:z"] and got["x", "c2", "unanswered"].wave == 0
    assert got["x", "c3", "unanswered"].wave == 0 and got["x", "c3", "unanswered"].errors == [] and got["x", "c3", "unanswered"].turn == 3
    assert got["x", "c4", "unanswered"].errors == ["tool"]
    assert [got["x", c, "unanswered"].wave for c in ("c5", "c6", "c7")] == [None, None, None]
    assert got["x", "c5", "unanswered"].errors == ["arguments"] == got["x", "c6", "unanswered"].errors
    assert got["x", "c7", "unanswered"].errors == ["missing:text"]
    assert got["y", "c1", "linked"].errors == ["tool"] and json.loads(got["y", "c1", "linked"].json)["result"] is None
    assert {k[1] for k in got if k[2] == "orphan"} == {"c2", "zz"}


def test_order_is_topological(spark):
    calls = [("x", f"c{i}", 100 - i, "add", '{"a":1}', [f"c{j}" for j in range(i) if j % 3 == i % 3]) for i in range(12)]
    got = {r.call_id: r.wave for r in linked(spark, calls, []).collect()}
    assert all(got[f"c{i}"] == i // 3 for i in range(12))
    # A reference ahead in the middle of a chain moves what is behind it, and nothing else.
    calls = [("x", f"d{i:02}", i, "add", '{"a":1}', [f"d{i - 1:02}"] if i != 5 else ["d08", "d04"]) for i in range(8)] + [("x", "d08", 8, "add", '{"a":1}', ["d02"]), ("y", "d05", 5, "add", '{"a":1}', [])]
    rows = linked(spark, calls, []).where("conv_id = 'x'").collect()
    order = {r.call_id: k for k, r in enumerate(sorted(rows, key=lambda r: (r.wave, r.turn, r.call_id)))}
    assert all(order[p] < order[c] for _, c, _, _, _, ps in calls[:9] for p in ps if p in order)
    assert {r.call_id for r in rows if r.wave} == {"d05", "d06", "d07"}


def test_canonical_json_ignores_spelling(spark):
    calls = [("x", "a", 1, "add", '{"a":1,"b":2}', []), ("y", "a", 1, "add", ' { "b" : 2 , "a" : 1 } ', [])]
    first, second = (r.json for r in linked(spark, calls, []).collect())
    assert first == second


def test_repeated_keys_are_an_error(spark):
    calls = [("x", "a", 1, "add", '{"a":1,"a":2}', []), ("x", "b", 2, "note", '{"text":"t","more":{"k":1,"k":2}}', []), ("x", "c", 3, "odd", '{"a":1,"a":2}', []), ("x", "d", 4, "add", "[1]", []), ("x", "e", 5, "add", "7", [])]
    got = {r.call_id: (r.errors, json.loads(r.json)["arguments"]) for r in linked(spark, calls, []).collect()}
    assert got == {"a": (["repeated"], None), "b": (["repeated"], None), "c": (["tool"], None), "d": (["arguments"], [1]), "e": (["arguments"], 7)}


def test_whole_numbers_have_one_form(spark):
    forms = ["1", "1.0", "1e0", "1.00", "10e-1"]
    calls = [("x", f"c{i}", i, "add", f'{{"b":{f},"a":{f}}}', []) for i, f in enumerate(forms)]
    texts = [r.json for r in linked(spark, calls, []).orderBy("turn").collect()]
    assert all('{"a":1,"b":1}' in t and '"errors":[]' in t for t in texts), texts
    tricky = '{"text":"1.0 \\" 2.0, \\\\","tags":[-3.0,2.5,"4.0"],"more":{"k":1.0}}'
    got = linked(spark, [("x", "n", 1, "note", tricky, [])], []).first()
    assert json.loads(got.json)["arguments"] == json.loads(tricky) and '"tags":[-3,2.5,"4.0"]' in got.json and '"k":1}' in got.json and got.errors == []


def test_odd_rows(spark):
    long = "word " * 40_000
    rows = [("x", 0, "user", long), ("x", 1, "assistant", "yes"), ("x", 1, "assistant", "yes"), ("x", None, "user", "when"), ("x", 2, None, None), ("x", 2, None, None), (None, 3, "user", "who"), ("y", 0, "system", "")]
    df = spark.createDataFrame(rows, "conv_id string, turn bigint, role string, text string").withColumn("CALL_ID", F.lit("q")).withColumn("wave", F.lit(1))
    got = {(r.conv_id, r.call_id): r for r in C.link(*C.turns_as_calls(df), C.TURN_SCHEMAS).collect()}
    assert got.keys() == {("x", "c0"), ("x", "c2"), ("y", "c0")} and got["x", "c0"].status == "linked"
    assert got["x", "c2"].errors == ["missing:prompt"] and json.loads(got["x", "c0"].json)["arguments"] in (None, {"prompt": long, "turn": 0}, {"turn": 0}, {"prompt": long, "turn": "0"}, {"n": len(long), "prompt": long, "turn": 0})


def kahn(calls):
    """Waves by hand: behind references ahead, one more than the highest parent there; elsewhere 0."""
    first = {}
    for conv, call, turn, *_, needs in sorted(calls, key=lambda c: (c[2], c[1])):
        first.setdefault((conv, call), (turn, needs))
    parents = {k: {(k[0], p) for p in needs if (k[0], p) in first} for k, (_, needs) in first.items()}
    reached = {k for k, ps in parents.items() if any((first[p][0], p[1]) >= (first[k][0], k[1]) for p in ps)}
    while more := {k for k, ps in parents.items() if ps & reached} - reached:
        reached |= more
    waves, left = dict.fromkeys(parents.keys() - reached, 0), set(reached)
    while ready := {k for k in left if not parents[k] & left}:
        waves |= {k: 1 + max((waves[p] for p in parents[k] & reached), default=0) for k in ready}
        left -= ready
    return waves | dict.fromkeys(left)


def test_waves_against_brute_force(spark):
    rng = random.Random(9)
    calls = [(f"v{v}", f"c{i}", rng.randrange(12), "add", '{"a":1}', [f"c{rng.randrange(14)}" for _ in range(rng.choice((0, 1, 1, 2)))]) for v in range(40) for i in range(12)]
    got = {(r.conv_id, r.call_id): r.wave for r in linked(spark, calls, []).collect()}
    assert got == kahn(calls) and len(set(got.values())) > 4


def test_query_has_waves_and_faults(spark):
    from tidewell.llm.queries_chat_tools import op9_tool_links

    rows = op9_tool_links(spark, "/root/testdata/sf0.01").select("wave", "errors", "status").distinct().collect()
    assert {r.wave for r in rows} >= {None, 0, 1, 2} and {r.errors for r in rows} >= {"", "arguments", "missing:prompt", "repeated", "type:turn", "unexpected:n"} and {r.status for r in rows} >= {"linked", "unanswered"}


def test_messages_and_turns(spark):
    message = json.dumps({"tool_calls": [{"id": "k1", "name": "add", "arguments": {"a": 1}, "depends_on": []}]})
    rows = [("x", 0, "system", "be kind"), ("x", 1, "user", "hi"), ("x", 2, "assistant", "ho"), ("x", 3, "assistant", message), ("x", 4, "tool", "  \n" + json.dumps({"tool_call_id": "k1", "content": "2"})), ("x", 5, None, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id string, turn bigint, role string, text string")
    calls, results = C.tool_messages(df)
    assert calls.first().call_id == "k1" and json.loads(calls.first().arguments) == {"a": 1} and results.first().content == "2"
    out = {(r.call_id, r.status) for r in C.link(*C.turns_as_calls(df), C.TURN_SCHEMAS).collect()}
    assert {("c0", "unanswered"), ("c1", "linked"), ("c2", "orphan")} <= out


def test_empty_and_native(spark):
    out = linked(spark, [], [])
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
