"""Chat formatting against a plain version that walks one conversation at a time."""

import json
import random

import pytest
from pyspark.sql import functions as F

chats = pytest.importorskip("sieveline.llm.chats")
TURNS = "conv_id long, turn long, role string, text string"


def call(i, n, **a):
    return f"<tool_call>{json.dumps({'id': i, 'name': n, 'arguments': a})}</tool_call>"


def result(i, content):
    return json.dumps({"id": i, "content": content})


def by_hand(rows):
    """(conv, turn, item) -> (level or None, linked, state) of calls and results, by loops."""
    out = {}
    for conv in {r[0] for r in rows}:
        calls, results, every = {}, {}, []
        for _, turn, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1]):
            if role == "assistant":
                for k, block in enumerate(text.split("<tool_call>")[1:], 1):
                    given = json.loads(block.split("</tool_call>")[0])
                    every.append((turn, k, "call", given["id"]))
                    calls.setdefault(given["id"], (turn, k, given["arguments"]))
            elif role == "tool":
                given = json.loads(text)
                every.append((turn, 0, "result", given["id"]))
                results.setdefault(given["id"], (turn, 0))
        deps = {i: {d.removeprefix("$result:") for d in a.values() if str(d).startswith("$result:")} & set(calls) for i, (_, _, a) in calls.items()}
        level = {}
        while True:
            new = {i: 1 + max((level[d] for d in ds), default=-1) for i, ds in deps.items() if i not in level and all(d in level for d in ds)}
            if not new:
                break
            level |= new
        for turn, item, kind, i in every:
            leads = (calls if kind == "call" else results).get(i, ())[:2] == (turn, item)
            met = i in calls and i in results and results[i] > calls[i][:2]
            state = "circular" if kind == "call" and i not in level else "repeated id" if not leads else "orphan" if kind == "result" and not met else None
            out[conv, turn, item] = (level.get(i), leads and met, state)
    return out


def test_links_and_order_match_brute_force(spark):
    dice, rows = random.Random(5), []
    for conv in range(12):
        ids = [f"c{k}" for k in range(dice.randrange(2, 25))]
        for turn in range(60):
            if dice.random() < 0.5:
                blocks = "".join(call(dice.choice(ids), "f", **{f"a{k}": f"$result:{dice.choice([*ids, 'none'])}" for k in range(dice.randrange(3) if dice.random() < 0.4 else 0)}) for _ in range(dice.randrange(3)))
                rows.append((conv, turn, "assistant", "x " + blocks))
            else:
                rows.append((conv, turn, "tool", result(dice.choice(ids), turn)))
    want = by_hand(rows)
    got = {}
    for r in chats.format_chats(spark.createDataFrame(rows, TURNS).repartition(3)).collect():
        assert chats.canonical(json.loads(r["json"])) == r["json"]
        if r["kind"] != "message":
            got[r["conv_id"], r["turn"], r["item"]] = r
    assert got.keys() == want.keys()
    for at, (level, linked, state) in want.items():
        assert (got[at]["linked"], got[at]["error"]) == (linked, state), at
        if got[at]["kind"] == "call":
            assert got[at]["level"] == (level or 0)


def test_long_chains_are_ordered_whole_or_in_pieces(spark):
    rows = [(1, f"c{k}", k, [f"c{k - 1}"] if k else []) for k in range(3000)]
    frame = spark.createDataFrame(rows, "conv_id long, call_id string, turn long, deps array<string>")
    for edges, turns in ((100_000, 256), (10, 700)):
        got = {r["call_id"]: r["level"] for r in chats.levels(frame, edges, turns).collect()}
        assert got == {f"c{k}": k for k in range(3000)}


def test_what_is_no_json_is_kept_as_text(spark):
    deep = '{"id":"d","name":"f","arguments":' + "[" * 1500 + '"$result:a"' + "]" * 1500 + "}"
    blocks = [
        deep,
        '{"id":"e","name":"f","arguments":' + "[" * 400_000 + "]" * 400_000 + "}",
        '{"id":"a","name":"f","arguments":{"x":"\\ud800"}}',
        '{"id":"b\\ud800","name":"f"}',
        '{"id":"n","name":"f","arguments":{"x":NaN}}',
        '{"id":"i","name":"f","arguments":{"x":1e999}}',
        '{"id":"h","name":"g","arguments":{"k":1' + "0" * 400 + "}}",
        '{"id":"t","name":"e","arguments":true}',
        '{"id":"o","name":"e","arguments":1.0}',
        '{"id":"c","name":"f","arguments":{"x":"\\u001f\\u0007\\n"}}',
        '{"id":"u","name":"bad"}',
        '{"id":"s","name":"f","arguments":"{\\"b\\":1,\\"a\\":2}"}',
    ]
    text = "".join(f"<tool_call>{b}</tool_call>" for b in blocks)
    rows = [(1, 0, "assistant", text), (1, 1, "tool", '{"id":"a","content":NaN}'), (1, 2, "user", "\x1f \x7f   é"), (2, 0, "assistant", ""), (None, 3, "assistant", call("z", "f")), (None, None, None, None)]
    schemas = {"g": {"properties": {"k": {"type": "integer"}}}, "e": {"enum": [1]}, "bad": {"type": 5}}
    frame = spark.createDataFrame(rows, TURNS).withColumn("json", F.lit("clash")).withColumn("level", F.lit(3))
    got = chats.format_chats(frame, schemas).collect()
    calls = {r["item"]: r for r in got if r["conv_id"] == 1 and r["turn"] == 0 and r["kind"] == "call"}
    assert [calls[k + 1]["error"] for k in range(12)] == [None, "unreadable call", None, "unreadable call", "unreadable call", "unreadable call", None, "$: not in enum", None, None, "unusable schema", None]
    assert calls[1]["level"] == 1 and '"\\ud800"' in calls[3]["json"] and '"arguments":1,' in calls[9]["json"]
    assert '"\\u001f\\u0007\\n"' in calls[10]["json"] and '"arguments":{"a":2,"b":1}' in calls[12]["json"]
    assert [r["error"] for r in got if r["turn"] == 1] == ["result without id"]
    for r in got:
        assert chats.canonical(chats.loads(r["json"])) == r["json"]
    assert [(r["kind"], r["linked"], r["error"]) for r in got if r["conv_id"] is None and r["kind"] == "call"] == [("call", False, None)]
    assert len(got) == 12 + 1 + 1 + 1 + 1 + 2 + 1


def test_a_conversation_declares_its_tools(spark):
    tools = [{"name": "f", "parameters": {"type": "object", "properties": {"k": {"type": "integer", "minimum": 0}}, "required": ["k"], "additionalProperties": False}}, {"type": "function", "function": {"name": "g"}}]
    system = f"You may call <tools>{json.dumps(tools)}</tools> and <tools>nonsense</tools>"
    rows = [
        (1, 0, "system", system),
        (1, 1, "assistant", call("a", "f", k=1) + call("b", "f", k=-1, z=0) + call("c", "f") + call("d", "g", any=1) + call("e", "h")),
        (2, 0, "assistant", call("a", "f", k="x") + call("b", "h", k="x")),
    ]
    got = {(r["conv_id"], r["call_id"]): r["error"] for r in chats.format_chats(spark.createDataFrame(rows, TURNS), {"h": {"required": ["q"]}}).collect()}
    assert got[1, "a"] is None and got[1, "b"] == "$.k: under minimum; $.z: unknown" and got[1, "c"] == "$.k: missing" and got[1, "d"] is None
    assert got[1, "e"] == "$.q: missing" and got[2, "a"] is None and got[2, "b"] == "$.q: missing"
    assert sum(k[1] is None for k in got) == 2


def test_ties_and_repeated_rows(spark):
    rows = [(1, 0, "assistant", call("a", "f", x=1)), (1, 0, "assistant", call("a", "f", x=2)), (1, 1, "tool", result("a", 1)), (1, 1, "tool", result("a", 1))]
    got = sorted((r["kind"], r["json"], r["linked"], r["error"]) for r in chats.format_chats(spark.createDataFrame(rows, TURNS)).collect() if r["kind"] != "message")
    assert [(k, linked, error) for k, _, linked, error in got] == [("call", True, None), ("call", False, "repeated id"), ("result", True, None), ("result", True, None)]
    long = spark.createDataFrame([(3, 0, "user", "word " * 400_000)], TURNS)
    assert len(chats.format_chats(long).first()["json"]) > 2_000_000
