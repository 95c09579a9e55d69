from __future__ import annotations

import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chat_format, queries

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, uses array<string>, content string, status string"
RESULTS = "conv_id long, call_id string, turn long, content string, json string"
PARAMETERS = "name string, parameter string, type string, required boolean"
TOOLS = [("add", "a", "number", True), ("add", "b", "number", True), ("find", "q", "string", True), ("find", "limit", "integer", False), ("find", "where", "object", None)]
TESTDATA = os.environ.get("LEDGERLOOM_TESTDATA", "/root/testdata")


def link(spark, calls, results):
    calls = spark.createDataFrame([(*c, "x", "y") for c in calls], CALLS)
    results = spark.createDataFrame([(*r, "x") for r in results], RESULTS)
    found = chat_format.link_tool_calls(calls, results, spark.createDataFrame(TOOLS, PARAMETERS)).collect()
    return sorted(found, key=lambda r: (r["conv_id"] or 0, r["level"], r["turn"] or 0, r["call_id"] or ""))


@pytest.mark.parametrize(
    ("name", "arguments", "errors"),
    [
        ("add", '{"b": 1.5, "a": 2}', []),
        ("add", '{"a": "1"}', ["missing:b", "type:a"]),
        ("add", '{"a": 1, "b": 1, "c": null}', ["unknown:c"]),
        ("find", '{"q": "é\\n", "where": {"z": 1, "b": [1, 2.0]}, "limit": 3}', []),
        ("find", '{"q": null, "limit": 2.5, "where": []}', ["type:limit", "type:q", "type:where"]),
        ("find", "[1]", ["not_an_object"]),
        ("find", '{"q": "a", "q": "b"}', ["not_an_object"]),
        ("find", "no json", ["not_an_object"]),
        ("find", None, ["not_an_object"]),
        ("other", "{}", ["unknown_tool"]),
        (None, "{}", ["unknown_tool"]),
    ],
)
def test_validation_and_canonical_json(spark, name, arguments, errors):
    row = link(spark, [(1, "c", 0, name, arguments, None)], [])[0]
    assert row["errors"] == errors
    said = json.loads(row["json"])
    assert said["id"] == "c" and said.get("name") == name
    if arguments and arguments[0] in "{[" and '"q": "a", "q"' not in arguments:
        assert said["arguments"] == json.loads(arguments)
        assert json.dumps(json.loads(arguments), sort_keys=True, separators=(",", ":"), ensure_ascii=False).replace("2.0]", "2]") in row["json"]


def test_links_and_cases(spark):
    calls = [(1, "a", 0, "add", "{}", None), (1, "a", 0, "add", "{}", None), (1, "b", 5, "add", "{}", []), (2, "a", 1, "add", "{}", []), (None, "a", 1, "add", "{}", []), (2, None, 3, "add", "{}", []), (2, None, 3, "add", "{}", [])]
    results = [(1, "a", 1, "one"), (1, "a", 9, "later"), (1, "b", 5, "same turn"), (3, "z", 2, None), (1, None, 1, "lost")]
    found = sorted((r["conv_id"] or 0, r["call_id"] or "", r["status"]) for r in link(spark, calls, results))
    assert found == [(0, "a", "no_identifier"), (1, "", "no_identifier"), (1, "a", "linked"), (1, "b", "result_too_early"), (2, "", "no_identifier"), (2, "", "no_identifier"), (2, "a", "no_result"), (3, "z", "no_call")]
    assert link(spark, [], []) == []


def test_topological_order(spark):
    calls = [(1, "a", 0, "add", "{}", ["c", "b"]), (1, "b", 1, "add", "{}", ["d"]), (1, "c", 2, "add", "{}", []), (1, "d", 3, "add", "{}", ["nowhere"])]
    calls += [(2, "x", 0, "add", "{}", []), (2, "y", 1, "add", "{}", ["x"])]
    calls += [(3, "p", 0, "add", "{}", ["q"]), (3, "q", 1, "add", "{}", ["p"]), (3, "r", 2, "add", "{}", ["q"]), (3, "s", 3, "add", "{}", ["s"]), (3, "t", 4, "add", "{}", [])]
    found = link(spark, calls, [])
    assert [r["call_id"] for r in found if r["conv_id"] == 1] == ["c", "d", "b", "a"]
    assert [(r["call_id"], r["level"]) for r in found if r["conv_id"] == 2] == [("x", 0), ("y", 1)]
    assert {r["call_id"]: r["level"] for r in found if r["conv_id"] == 3} == {"p": -1, "q": -1, "r": -1, "s": -1, "t": 0}


def test_order_of_calls_without_a_turn(spark):
    calls = [(1, "a", None, "add", "{}", ["b"]), (1, "b", None, "add", "{}", []), (2, "a", 0, "add", "{}", ["b"]), (2, "b", None, "add", "{}", []), (3, "a", None, "add", "{}", ["b"]), (3, "b", 4, "add", "{}", [])]
    found = link(spark, calls, [(1, "a", 3, "one")])
    assert [(r["conv_id"], r["call_id"], r["level"]) for r in found] == [(k, c, level) for k in (1, 2, 3) for level, c in enumerate("ba")]


def test_rounds_grow_with_the_logarithm_of_a_chain(spark, monkeypatch):
    written, write = [], chat_format.Scratch.write
    monkeypatch.setattr(chat_format.Scratch, "write", lambda self, df, *a, **b: written.append(1) or write(self, df, *a, **b))
    n = 60
    calls = [(1, f"c{k}", n - k, "add", "{}", [f"c{k - 1}"] if k else []) for k in range(n)]
    # Two ways of unlike lengths from one call to another, and a circle that a call uses.
    calls += [(2, "a", 0, "add", "{}", ["b", "d"]), (2, "b", 1, "add", "{}", ["c"]), (2, "c", 2, "add", "{}", ["d"]), (2, "d", 3, "add", "{}", ["e"]), (2, "e", 4, "add", "{}", [])]
    calls += [(3, "p", 0, "add", "{}", ["q", "t"]), (3, "q", 1, "add", "{}", ["r"]), (3, "r", 2, "add", "{}", ["q"]), (3, "t", 3, "add", "{}", [])]
    found = {(r["conv_id"], r["call_id"]): r["level"] for r in link(spark, calls, [])}
    assert {c: level for (k, c), level in found.items() if k == 1} == {f"c{k}": k for k in range(n)}
    assert {c: level for (k, c), level in found.items() if k == 2} == {"a": 4, "b": 3, "c": 2, "d": 1, "e": 0}
    assert {c: level for (k, c), level in found.items() if k == 3} == {"p": -1, "q": -1, "r": -1, "t": 0}
    assert len(written) < n


def test_no_python_in_the_plan(spark):
    text = queries.op6_chat_format(spark, f"{TESTDATA}/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


def test_query_equals_its_sql(spark):
    df = queries.op6_chat_format(spark, f"{TESTDATA}/sf0.001")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{TESTDATA}/sf0.001/conversations.parquet'")
    expected = con.execute(queries.ORACLE_SQL["op6_chat_format"]).fetchall()
    names = [c[0] for c in con.execute(queries.ORACLE_SQL["op6_chat_format"]).description]
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(expected, key=repr)
    rows = df.collect()
    assert {r["level"] for r in rows} > {0, 1} and {r["n_errors"] for r in rows} == {0, 1, None}
    assert {r["errors"] for r in rows} == {"", "type:limit", "missing:limit", None} and {"linked", "message"} <= {r["status"] for r in rows}
