import json
import random
from decimal import Decimal

from adsieve.llm import tool_calls as tc

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, depends_on string, content string"
RESULTS = "conv_id long, call_id string, turn long, content string, name string"
SCHEMAS = {"find": {"q": {"type": "string", "required": True, "max_length": 5}, "n": {"type": "integer", "minimum": 1, "maximum": 9}, "all": {"type": "boolean"}, "at": {"type": "number"}}, "stop": {}}


def run(spark, calls, results):
    found = tc.link(spark.createDataFrame([(*c, None) for c in calls], CALLS), spark.createDataFrame([(*r, None) for r in results], RESULTS), SCHEMAS).collect()
    return {(r.conv_id, r.call_id): r for r in found}


def test_links_and_json(spark):
    calls = [
        (1, "a", 0, "find", '{"q": "h\\"é", "n": 3, "all": true, "at": -1.5e3, "zz": 1}', None),
        (1, "b", 1, "find", '{"n": "x", "q": "longer"}', "a"),
        (1, "c", 2, "find", '{"n": 12}', "gone"),
        (1, "d", 3, "other", "{}", None),
        (1, "e", 4, "stop", "not json", None),
        (1, "f", 5, "stop", None, None),
        (1, "g", 6, None, "{}", "f"),
        (1, "b", 9, "stop", "{}", None),
        (None, "a", 0, "stop", "{}", None),
        (2, "a", 0, "stop", "{}", None),
    ]
    results = [(1, "a", 1, 'said "x"\n'), (1, "a", 2, "again"), (3, "q", 0, "lost"), (2, "a", 5, None), (None, None, None, None)]
    got = run(spark, calls, results)
    assert got[1, "a"].status == "linked" and got[1, "a"].n_results == 2 and got[1, "a"].errors == "unknown:zz"
    assert got[1, "a"].json == '{"arguments":{"all":true,"at":-1500.0,"n":3,"q":"h\\"é","zz":1},"id":"a","name":"find","result":"said \\"x\\"\\n"}'
    assert got[1, "b"].errors == "type:n,length:q" and got[1, "b"].n_calls == 2 and got[1, "b"].level == 1
    assert got[1, "c"].errors == "maximum:n,missing:q,dependency" and got[1, "c"].level == 0
    assert got[1, "d"].errors == "unknown_tool" and got[1, "e"].errors == "arguments" == got[1, "f"].errors
    assert got[1, "g"].errors == "unknown_tool" and got[1, "g"].level == 1
    assert got[3, "q"].status == "orphan_result" and got[3, "q"].errors == ""
    assert got[2, "a"].status == "linked" and len(got) == 9
    for r in got.values():
        again = json.loads(r.json)
        assert list(again) == sorted(again) and r.json == json.dumps(again, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def test_levels_against_brute_force(spark):
    rng = random.Random(5)
    calls = [(c, f"k{i}", i, "stop", "{}", rng.choice([None, f"k{rng.randrange(14)}"])) for c in range(6) for i in range(12)]
    calls += [(9, f"k{i}", i, "stop", "{}", f"k{i - 1}") for i in range(70)] + [(8, "x", 0, "stop", "{}", "x")]
    up = {(c, i): d for c, i, *_, d in calls}

    def level(c, i):
        seen, n = set(), 0
        while (d := up[c, i]) is not None and (c, d) in up:
            if i in seen:
                return None
            seen.add(i)
            i, n = d, n + 1
        return n

    got = run(spark, calls, [])
    assert {k: r.level for k, r in got.items()} == {k: level(*k) for k in up}
    assert "cycle" in got[8, "x"].errors


def test_empty(spark):
    assert run(spark, [], []) == {}


def test_nested_arguments_are_canonical(spark):
    schemas = {"f": {"o": {"type": "object", "properties": {"x": {"type": "integer", "required": True}}}, "l": {"type": "array", "items": {"type": "integer"}}, "s": {}}}
    given = ['{"s":"q","o":{"y":[2, {"b":1,"a":null}],"x":1.50},"l":[1, "2"]}', '{"o":{"x":3},"l":[1,2],"s":7}', '[1]', '{"l":{},"o":[]}', '{"s":"a","s":"b"}', '{"o":null}']
    rows = [(1, str(k), k, "f", a, None, None) for k, a in enumerate(given)]
    got = {r.call_id: r for r in tc.link(spark.createDataFrame(rows, CALLS), spark.createDataFrame([], RESULTS), schemas).collect()}
    arguments = [json.loads(got[str(k)].json)["arguments"] for k in range(len(given))]
    assert arguments == [json.loads(given[0]), json.loads(given[1]), "[1]", {"l": {}, "o": []}, given[4], {"o": None}]
    assert got["0"].json.startswith('{"arguments":{"l":[1,"2"],"o":{"x":1.5,"y":[2,{"a":null,"b":1}]},"s":"q"},"id":"0"')
    assert [got[str(k)].errors for k in range(len(given))] == ["items:l,type:o.x,unknown:o.y", "type:s", "arguments", "type:l,type:o", "arguments", ""]


def test_several_dependencies(spark):
    rng = random.Random(11)
    rows = [(c, f"k{i}", i, "stop", "{}", [f"k{rng.randrange(i + (rng.random() < 0.03))}" for _ in range(rng.randrange(4))] if i else [None], None) for c in range(8) for i in range(25)]
    rows += [(90, "a", 0, "stop", "{}", ["b", "c"], None), (90, "b", 0, "stop", "{}", ["a"], None), (90, "c", 0, "stop", "{}", None, None), (90, "d", 0, "stop", "{}", ["b", "gone"], None)]
    up = {(r[0], r[1]): [d for d in r[5] or [] if d] for r in rows}

    def level(c, i, path=()):
        if i in path:
            return None
        below = [level(c, d, (*path, i)) for d in up[c, i] if (c, d) in up]
        return None if None in below else max(below, default=-1) + 1

    calls = spark.createDataFrame(rows, CALLS.replace("depends_on string", "depends_on array<string>"))
    results = spark.createDataFrame([(0, "k1", 3, "r", "x", 9)], "conv_id long, call_id string, turn long, content string, result_turn string, n_results int")
    got = {(r.conv_id, r.call_id): r for r in tc.link(calls, results, SCHEMAS).collect()}
    assert {k: r.level for k, r in got.items()} == {k: level(*k) for k in up}
    assert got[90, "d"].errors == "cycle,dependency" and got[0, "k1"].status == "linked"


def test_numbers_keep_their_value(spark):
    kept = ["1", "-7", "1.0", "0.10", "12345678901234567890123456789012345678", "-0.00000000000000000000000000000000000001", "1.5e3", "1E50", "0e9", "1.2e-300", "9007199254740993"]
    lost = ["12345678901234567890123456789012345678901234567890", "1e400", "1e-400", "1.2345678901234567890e5", "0." + "0" * 40 + "1", "1.23e-320"]
    given = [f'{{"n":{n},"s":"\\\\\\"1e400 12345678901234567890123456789012345678901\\\""}}' for n in kept + lost]
    rows = [(1, str(k), k, "f", a, None, None) for k, a in enumerate(given)]
    got = {r.call_id: r for r in tc.link(spark.createDataFrame(rows, CALLS), spark.createDataFrame([], RESULTS), {"f": {"n": {"type": "number"}, "s": {}}}).collect()}
    for k, n in enumerate(kept + lost):
        shown = json.loads(got[str(k)].json, parse_float=Decimal, parse_int=Decimal)["arguments"]
        if n in kept:
            assert shown["n"] == Decimal(n) and shown["s"] == json.loads(given[k])["s"], n
        else:
            assert shown == given[k] and "arguments" in got[str(k)].errors, n
