import json

from millrace.llm import chat

CALLS = "conv_id long, turn long, call_id string, parent string, name string, arguments string"
RESULTS = "conv_id long, turn long, call_id string, content string"
TOOLS = "name string, field string, type string, required boolean"


def run(spark, calls, results):
    tools = spark.createDataFrame(
        [("f", "n", "integer", True), ("f", "x", "number", False), ("f", "s", "string", False), ("g", "o", "object", True)], TOOLS)
    return chat.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), tools).collect()


def test_links_order_checks_and_json(spark):
    calls = [
        (1, 0, "a", None, "f", '{"x": 2, "n": 1}'), (1, 2, "b", "a", "f", '{"n": "1"}'), (1, 4, "c", "b", "g", '{"o": {"k": 1}}'),
        (1, 6, "d", "zz", "h", "{}"), (1, 8, "e", None, "f", "nope"), (1, 9, "p", "q", "f", '{"n": 1, "n": 2}'),
        (1, 10, "q", "p", "f", '{"n": 2, "s": null, "more": [1]}'), (1, 12, None, "a", "f", None),
    ]
    results = [(1, 1, "a", "ok \"é\"\n"), (1, 3, "b", None), (1, 5, "nobody", "?"), (1, 7, None, ""), (1, 11, "a", "again")]
    got = run(spark, calls, results)
    assert len(got) == 13
    call = {r.call_id: r for r in got if r.kind == "call"}
    assert [call[k].place for k in ("a", "b", "c", "d", "e")] == [0, 2, 4, 0, 0]
    assert call["p"].place is None and call["q"].place is None
    assert [call[k].errors for k in "abcde"] == ["", "type of n", "", "unknown tool; unknown parent", "arguments are no object"]
    assert call["q"].errors == "type of s; unknown more; cycle" and call["p"].errors == "arguments are no object; cycle"
    assert call["a"].json == '{"arguments":{"n":1,"x":2},"call":"a","conversation":1,"name":"f","role":"assistant"}'
    assert [call[k].linked for k in "abc"] == [True, True, False] and not call[None].linked
    result = {(r.call_id, r.turn): r for r in got if r.kind == "result"}
    assert (result["a", 1].place, result["a", 1].linked, result["a", 1].errors) == (1, True, "")
    assert result["a", 11].errors == "repeated result" and result["nobody", 5].errors == "no call"
    assert json.loads(result["a", 1].json) == {"call": "a", "content": "ok \"é\"\n", "conversation": 1, "role": "tool"}
    assert "content" not in json.loads(result["b", 3].json)


def test_a_long_chain_and_repeated_rows(spark):
    n = 300
    calls = [(1, k, str(k), str(k - 1) if k else None, "f", '{"n":1}') for k in range(n)] + [(1, 5, "5", "4", "f", '{"n":1}')]
    calls += [(2, 7, "5", None, "f", '{"n":1}')]
    got = run(spark, calls, [])
    assert len(got) == n + 2
    assert all(r.place == 2 * r.turn for r in got if r.conv_id == 1)
    assert [r.errors for r in got if r.conv_id == 2] == ["repeated call"]


def test_empty_tables(spark):
    assert run(spark, [], []) == []
    assert [r.errors for r in run(spark, [], [(1, 1, "a", "x")])] == ["no call"]


def test_no_python_in_the_plan(spark):
    calls = spark.createDataFrame([(1, 0, "a", None, "f", "{}")], CALLS)
    linked = chat.link(calls, spark.createDataFrame([], RESULTS), spark.createDataFrame([], TOOLS))
    plan = linked._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
