"""Tool-call linking, order, validation and canonical JSON."""

from __future__ import annotations

import json

from tidemill.llm import chat_format as cf

SCHEMAS = {
    "add": {
        "type": "object",
        "properties": {"a": {"type": "number", "minimum": 0}, "b": {"type": "integer", "maximum": 9}, "how": {"type": "string", "enum": ["fast", "slow"]}},
        "required": ["a", "b"],
        "additionalProperties": False,
    },
    "say": {"type": "object", "properties": {"it's": {"type": "string", "minLength": 2, "maxLength": 3}}},
}


def call(*calls):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


def events(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, status string, place int")
    out = cf.format_chat(df, SCHEMAS).collect()
    return sorted(out, key=lambda r: (str(r["conv_id"]), r["place"] if r["place"] is not None else -1, r["step"], r["kind"], r["json"]))


def test_links_order_and_errors(spark):
    rows = [
        (1, 0, "user", "hi"),
        (1, 4, "assistant", call(("c1", "add", {"b": 2, "a": 1.5}), ("c2", "add", {"a": -1, "b": 2.5, "z": 1, "how": "odd"}), ("c1", "say", {}))),
        (1, 2, "tool", result("c2", {"y": [1, {"b": 1, "a": None}], "x": "é\n\""})),  # came before its call
        (1, 5, "tool", result("c1", "3.5")),
        (1, 6, "tool", result("c1", "again")),
        (1, 7, "tool", result("c9", None)),
        (2, 5, "tool", result("c1", "other conversation")),
        (2, 1, "assistant", call(("c3", "say", json.dumps({"it's": "word"})), (None, "say", [1]), ("c4", "nope", {}))),
    ]
    got = events(spark, rows)
    one = [(r["kind"], r["call_id"], r["status"], r["errors"]) for r in got if r["conv_id"] == 1]
    assert one == [
        ("message", None, "plain", []),
        ("call", "c1", "answered", []),
        ("call", "c2", "answered", ["a is too small", "b is not integer", "how is not listed", "z is not known"]),
        ("call", "c1", "duplicate", []),
        ("result", "c2", "linked", []),
        ("result", "c1", "linked", []),
        ("result", "c1", "extra", []),
        ("result", "c9", "orphan", []),
    ]
    two = {(r["kind"], r["call_id"]): (r["status"], r["errors"]) for r in got if r["conv_id"] == 2}
    assert two == {
        ("call", "c3"): ("open", ["it's is too long"]),
        ("call", None): ("no id", ["arguments are not an object"]),
        ("call", "c4"): ("open", ["unknown tool"]),
        ("result", "c1"): ("orphan", []),
    }
    for r in got:
        value = json.loads(r["json"])
        assert r["json"] == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    linked = next(r for r in got if r["call_id"] == "c2" and r["kind"] == "result")
    assert json.loads(linked["json"])["content"] == {"x": 'é\n"', "y": [1, {"a": None, "b": 1}]}


def test_edge_rows(spark):
    rows = [
        (1, 0, "assistant", None),
        (1, 1, "assistant", ""),
        (1, 2, "assistant", "{not json"),
        (1, 3, "assistant", '{"a":1,"a":2}'),
        (1, 4, "tool", "{}"),
        (1, 5, "user", call(("c", "add", {}))),  # users do not call
        (1, 6, "assistant", '{"tool_calls":[]}'),
        (1, 7, None, "no role"),
        (None, 1, "assistant", call(("c", "add", {}))),
        (None, 2, "tool", result("c", "x")),
        (2, 1, "assistant", call(("d", "add", {"a": 1, "b": 1}))),
        (2, 1, "assistant", call(("d", "add", {"a": 1, "b": 1}))),
        (2, 2, "tool", result("d", "y" * 200_000)),
        (2, 2, "tool", result("d", "y" * 200_000)),
        (3, None, "user", "no turn"),
    ]
    got = events(spark, rows)
    assert len(got) == len(rows)
    assert {r["status"] for r in got if r["conv_id"] == 1} == {"plain"}
    assert [r["status"] for r in got if r["conv_id"] is None] == ["open", "orphan"]
    assert [r["status"] for r in got if r["conv_id"] == 2] == ["answered", "answered", "linked", "linked"]
    assert json.loads(next(r["json"] for r in got if r["place"] == 0))["content"] is None
    assert [r["errors"] for r in got if r["kind"] == "call" and r["conv_id"] is None] == [["a is missing", "b is missing"]]
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert cf.format_chat(empty, SCHEMAS).collect() == []


def test_a_long_conversation_is_spread(spark):
    rows = [(1, 2 * t, "assistant", call((f"c{t}", "say", {}))) for t in range(800)] + [(1, 2 * t + 1, "tool", result(f"c{t}", t)) for t in range(800)]
    got = events(spark, rows)
    assert [r["call_id"] for r in got] == [f"c{t}" for t in range(800) for _ in range(2)]
    assert {r["status"] for r in got} == {"answered", "linked"}
    df = cf.format_chat(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), SCHEMAS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "SinglePartition" not in plan and "Window" not in plan
