import json
import re

from carestar.llm import chat as C
from carestar.llm.queries import TOOLS, tool_messages

SCHEMAS = {"add": {"a": ("integer", True), "b": ("number", True), "note": ("string", False)}, "ping": {}}
SCHEMA = "conv_id long, turn long, role string, text string"


def call(*calls):
    return json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments", "after"), c)) for c in calls]})


def result(call_id, content):
    return json.dumps({"tool_call_id": call_id, "content": content})


def linked(spark, rows):
    return C.link(spark.createDataFrame(rows, SCHEMA), SCHEMAS)


def test_linking_and_statuses(spark):
    rows = [
        (1, 0, "user", "please add"), (1, 1, "assistant", call(("c1", "add", {"b": 2.5, "a": 1}, []), ("c2", "ping", {}, ["c1"]))),
        (1, 2, "tool", result("c1", {"z": 1, "y": [1, 2]})), (1, 3, "tool", result("c1", "again")),
        (1, 4, "tool", result("zzz", "who")), (1, 5, "assistant", call(("c1", "ping", {}, []))),
        (2, 0, "tool", result("d", "too soon")), (2, 1, "assistant", call(("d", "ping", {}, []))),
        (None, 0, "assistant", call(("n", "ping", {}, []))), (None, 1, "tool", result("n", 1)),
        (3, 0, "assistant", "{broken"), (3, 1, None, None), (3, None, "user", ""), (3, 2, "assistant", '{"tool_calls": []}'),
        (4, 0, "assistant", call((None, "ping", {}, None))),
    ]
    out = {(r["conv_id"], r["turn"], r["place"]): r for r in linked(spark, rows).collect()}
    assert len(out) == 16
    status = {k: r["status"] for k, r in out.items()}
    assert status[1, 1, 0] == "linked" and status[1, 1, 1] == "pending" and status[1, 5, 0] == "duplicate"
    assert [status[1, t, 0] for t in (0, 2, 3, 4)] == ["message", "linked", "duplicate", "orphan"]
    assert status[2, 0, 0] == "early" and status[2, 1, 0] == "pending"
    assert status[None, 0, 0] == "pending" and status[None, 1, 0] == "orphan" and not out[None, 0, 0]["valid"]
    assert {status[k] for k in ((3, 0, 0), (3, 1, 0), (3, None, 0), (3, 2, 0))} == {"message"}
    assert status[4, 0, 0] == "pending" and out[4, 0, 0]["valid"] is False
    line = out[1, 1, 0]["json"]
    assert line == ('{"arguments":{"a":1,"b":2.5},"conv_id":1,"id":"c1","name":"add","role":"assistant","status":"linked",'
                    '"turn":1,"type":"call","valid":true}')
    assert json.loads(out[1, 2, 0]["json"])["content"] == {"y": [1, 2], "z": 1} and '{"y":[1,2],"z":1}' in out[1, 2, 0]["json"]


def test_validation(spark):
    cases = [({"a": 1, "b": 2}, True), ({"a": 1, "b": 2.5, "note": "x"}, True), ({"a": 1}, False), ({"a": "1", "b": 2}, False),
             ({"a": 1, "b": 2, "extra": 0}, False), ({"a": 1, "b": None}, False), ([1, 2], False), ("text", False), (None, False),
             ({"a": 1.5, "b": 1}, False), ({"a": 1, "b": 2, "note": 3}, False)]
    rows = [(i, 0, "assistant", call(("x", "add", a, []))) for i, (a, _) in enumerate(cases)]
    rows.append((99, 0, "assistant", call(("x", "unknown", {}, []))))
    got = {r["conv_id"]: r["valid"] for r in linked(spark, rows).collect()}
    assert got == {i: v for i, (_, v) in enumerate(cases)} | {99: False}


def test_topological_order(spark):
    rows = [
        (1, 0, "assistant", call(("a", "ping", {}, ["b", "missing"]))), (1, 1, "assistant", call(("b", "ping", {}, ["c"]))),
        (1, 2, "assistant", call(("c", "ping", {}, []), ("d", "ping", {}, ["a", "c"]))), (1, 3, "tool", result("a", 1)),
        (2, 0, "assistant", call(("p", "ping", {}, ["q"]))), (2, 1, "assistant", call(("q", "ping", {}, ["p"]))),
        (2, 2, "assistant", call(("r", "ping", {}, ["q"]))), (2, 3, "assistant", call(("s", "ping", {}, []))),
        (3, 0, "assistant", call(("x", "ping", {}, []))), (3, 1, "assistant", call(("y", "ping", {}, ["x"]))),
        (4, 0, "assistant", call(("me", "ping", {}, ["me"]))),
    ]
    got = {(r["conv_id"], r["kind"], r["call_id"]): r for r in linked(spark, rows).collect()}
    step = {k: r["step"] for k, r in got.items()}
    assert [step[1, "call", c] for c in "cbad"] == [0, 1, 2, 3] and step[1, "result", "a"] == 2
    assert {got[2, "call", c]["status"] for c in "pqr"} == {"cycle"} and got[2, "call", "s"]["status"] == "pending"
    assert got[4, "call", "me"]["status"] == "cycle" and step[3, "call", "x"] == step[3, "call", "y"] == 0


def test_repeated_rows_empty_table_native_plan_and_files(spark, tmp_path):
    rows = [(1, 0, "assistant", call(("a", "ping", {}, [])))] * 2 + [(1, 1, "tool", result("a", 1))] * 2
    out = linked(spark, rows)
    assert [r["status"] for r in out.collect()] == ["linked"] * 4
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())
    assert linked(spark, []).count() == 0
    C.write_jsonl(out, str(tmp_path / "chat"))
    lines = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "chat")).collect()]
    assert [x["type"] for x in lines].count("result") == 2


def test_conversations_with_awkward_rows(spark):
    rows = [(1, 0, "user", "hello  there"), (1, 1, "assistant", None), (1, 2, "user", None), (1, 3, None, "x"), (None, 0, "user", "q"),
            (2, None, "user", "q"), (2, 1, "assistant", "r")]
    out = {(r["conv_id"], r["turn"]): r for r in C.link(tool_messages(spark.createDataFrame(rows, SCHEMA)), TOOLS).collect()}
    assert len(out) == len(rows)
    assert out[1, 0]["status"] == "linked" and out[1, 0]["valid"] and out[1, 2]["valid"] is False


def test_messages_keep_their_place_in_odd_conversations(spark, tmp_path):
    rows = [(1, 0, "system", "be brief"), (1, 1, "assistant", call(("a", "ping", {}, ["b"]))), (1, 2, "user", "first"),
            (1, 3, "assistant", call(("b", "ping", {}, ["c"]))), (1, 4, "tool", result("nobody", 0)), (1, 5, "user", "second"),
            (1, 6, "assistant", call(("c", "ping", {}, []))), (1, 7, "tool", result("c", 1)), (1, 9000, "user", "late"),
            (2, 0, "user", "plain"), (2, 1, "assistant", call(("a", "ping", {}, []))), (2, 2, "user", "end")]
    out = linked(spark, rows)
    step = {(r["conv_id"], r["turn"]): r["step"] for r in out.collect()}
    assert [step[1, t] for t in (0, 1, 2, 3, 4, 5, 6, 7, 9000)] == [0, 2, 2, 1, 2, 2, 0, 0, 2]
    assert {step[2, t] for t in (0, 1, 2)} == {0}
    C.write_jsonl(out.where("conv_id = 1"), str(tmp_path / "chat"))
    written = [json.loads(r[0])["turn"] for r in spark.read.text(str(tmp_path / "chat")).collect()]
    assert written == [0, 6, 7, 3, 1, 2, 4, 5, 9000]


def test_cyclic_calls_come_last_whatever_other_conversations_hold(spark):
    long = [(9, t, "assistant", call((f"k{t}", "ping", {}, [f"k{t + 1}"]))) for t in range(6)]
    rows = [(1, 0, "assistant", call(("p", "ping", {}, ["q"]))), (1, 1, "assistant", call(("q", "ping", {}, ["p"]))),
            (2, 0, "assistant", call(("x", "ping", {}, ["y"]))), (2, 1, "assistant", call(("y", "ping", {}, []))),
            (2, 2, "assistant", call(("z", "ping", {}, ["z"])))]
    for table in (rows, rows + long):
        got = {(r["conv_id"], r["call_id"]): r["step"] for r in linked(spark, table).collect()}
        assert [got[k] for k in ((1, "p"), (1, "q"), (2, "y"), (2, "x"), (2, "z"))] == [0, 0, 0, 1, 2]


def test_the_traffic_of_the_query_has_every_kind_of_fault(spark):
    out = C.link(tool_messages(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")), TOOLS)
    seen = {(r["kind"], r["status"]) for r in out.select("kind", "status").distinct().collect()}
    assert seen == {("call", s) for s in ("linked", "pending", "duplicate", "cycle")} | {
        ("result", s) for s in ("linked", "orphan", "early", "duplicate")} | {("message", "message")}
    assert {r["valid"] for r in out.select("valid").distinct().collect()} == {True, False, None}
    assert out.agg({"step": "max"}).first()[0] >= 3
