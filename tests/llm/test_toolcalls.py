from __future__ import annotations

import json
import random

from airpanel.llm import toolcalls
from airpanel.llm.toolcalls import ANSWER, canonical, checked, from_conversations, linked, violations

SCHEMAS = {"add": {"properties": {"x": {"type": "integer", "minimum": 0}, "y": {"type": ["number", "null"]}, "tag": {"enum": ["a", "b"]},
                                  "list": {"type": "array", "items": {"type": "string", "maxLength": 2}}},
                   "required": ["x"], "additionalProperties": False}}


def frames(spark, calls, results, others=()):
    return (spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string, uses array<string>"),
            spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string"),
            spark.createDataFrame(list(others), "conv_id long, turn long, role string, text string"))


def test_links_order_and_validity(spark):
    ok = '{"x": 1}'
    calls = [(1, 5, "c", "add", ok, ["b", "gone"]), (1, 2, "b", "add", ok, ["a"]), (1, 3, "a", "add", '{"y": 2, "x": -1}', []),
             (1, 9, "a", "add", ok, []), (1, 10, None, "add", ok, []), (1, 11, "open", "nope", ok, None), (1, 12, "bad", "add", "{", []),
             (2, 1, "p", "add", ok, ["q"]), (2, 2, "q", "add", ok, ["p"]), (2, 3, "r", "add", ok, ["q"]), (3, 1, "a", "add", None, [])]
    results = [(1, 1, "a", "early"), (1, 4, "b", None), (1, 6, "c", "x"), (1, 7, "c", "again"), (1, 8, "nobody", "y"), (2, 4, "p", "z"), (9, 1, None, "n")]
    found = linked(*frames(spark, calls, results, [(1, 0, "user", "hi\n\"é\""), (None, None, None, None)]), SCHEMAS).collect()
    assert len(found) == len(calls) + len(results) + 2
    by = {(r.conv_id, r.turn, r.kind): r for r in found}
    status = {k: r.status for k, r in by.items()}
    assert status[1, 3, "call"] == "linked" and status[1, 9, "call"] == "repeated" and status[1, 10, "call"] == "open"
    assert status[1, 11, "call"] == "open" and status[1, 7, "result"] == "repeated" and status[1, 8, "result"] == "orphan"
    assert status[2, 1, "call"] == status[2, 2, "call"] == status[2, 3, "call"] == "cyclic" and status[9, 1, "result"] == "orphan"
    assert by[1, 1, "result"].partner_turn == 3 and by[1, 3, "call"].partner_turn == 1
    order = sorted((r for r in found if r.conv_id == 1 and r.call_id in ("a", "b", "c") and r.status == "linked"),
                   key=lambda r: (r.order_turn, r.level, r.turn))
    assert [(r.kind, r.call_id) for r in order] == [(k, c) for c in "abc" for k in ("call", "result")]
    assert by[1, 3, "call"].reason == "$.x: below minimum" and by[1, 11, "call"].reason == "unknown tool"
    assert by[1, 12, "call"].reason == "$: no JSON" and by[1, 2, "call"].reason is None and by[3, 1, "call"].reason == "$: no JSON"
    assert by[1, 0, "message"].json == '{"content":"hi\\n\\"é\\"","role":"user"}'
    assert json.loads(by[1, 4, "result"].json) == {"role": "tool", "tool_call_id": "b", "content": None}


def test_schema_checks():
    schema = {"type": "object", **SCHEMAS["add"]}
    assert violations({"x": 1, "y": None, "tag": "a", "list": ["ab"]}, schema) == []
    assert violations({"x": True}, schema) == ["$.x: not of type integer"] and violations({}, schema) == ["$.x: missing"]
    assert violations({"x": 1.0, "tag": "c", "list": ["abc"], "z": 1}, schema) == ["$.tag: not in enum", "$.list[0]: too long", "$.z: unknown"]
    assert checked("add", "[1]", SCHEMAS)[1] == "$: not of type object"
    assert canonical({"b": 1, "a": [None, "é"]}) == '{"a":[null,"é"],"b":1}'


def test_long_chains_and_empty_tables(spark):
    calls = [(1, 100 - i, f"c{i}", "add", '{"x":1}', [f"c{i - 1}"] if i else []) for i in range(6)]
    found = linked(*frames(spark, calls, []), SCHEMAS).collect()
    order = sorted(found, key=lambda r: (r.order_turn, r.level, r.turn))
    assert [r.call_id for r in order] == [f"c{i}" for i in range(6)] and {r.level for r in found} == {0, 2, 4, 6, 8, 10}
    assert linked(*frames(spark, [], []), SCHEMAS).collect() == []


def test_plain_chats(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "how many words"), (1, 2, "assistant", "three"), (1, 3, "user", ""), (1, 4, "user", None),
         (1, 5, "assistant", "x"), (2, 0, "assistant", "first"), (1, 5, "assistant", "x")], "conv_id long, turn long, role string, text string")
    found = linked(*from_conversations(turns), ANSWER).collect()
    by = {(r.conv_id, r.turn): r for r in found}
    assert len(found) == 8 and by[1, 1].status == by[1, 2].status == "linked" and by[1, 1].partner_turn == 2 and by[1, 1].reason is None
    assert by[1, 3].status == "open" and "words" in by[1, 3].reason and by[2, 0].status == "orphan" and by[1, 0].kind == "message"


def test_chats_with_gaps_and_turns_between(spark):
    rows = [(1, 0, "assistant", "hello"), (1, 2, "user", "a b"), (1, 3, "system", "s"), (1, 7, "assistant", "one"), (1, 8, "assistant", "more"),
            (1, 9, "user", "unanswered"), (1, 12, "user", "c"), (1, 20, "assistant", "two"), (1, 21, "user", "d"), (1, 21, "user", "e"),
            (1, 30, "assistant", "three"), (1, 31, "user", "f"), (2, 5, "user", "g"), (None, 1, "user", "h"), (None, 1, "user", "h"),
            (None, 2, "assistant", "i"), (3, None, "user", "j"), (3, None, "assistant", "k")]
    found = linked(*from_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)), ANSWER).collect()
    assert len(found) == len(rows)
    by = {(r.turn, r.kind): (r.status, r.level, r.partner_turn) for r in found if r.conv_id == 1 and r.turn != 21}
    assert by == {
        (0, "result"): ("orphan", None, None), (2, "call"): ("linked", 0, 7), (3, "message"): ("plain", 0, None), (7, "result"): ("linked", 1, 2),
        (8, "result"): ("repeated", 1, 2), (9, "call"): ("open", 2, None), (12, "call"): ("linked", 2, 20), (20, "result"): ("linked", 3, 12),
        (30, "result"): ("linked", 5, 21), (31, "call"): ("open", 6, None)}
    assert sorted((r.status, r.level) for r in found if r.turn == 21) == [("linked", 4), ("repeated", 4)]
    assert {(r.kind, r.status) for r in found if r.conv_id is None or r.turn is None} == {("call", "open"), ("result", "orphan")}
    assert [r.turn for r in sorted((r for r in found if r.conv_id == 1 and r.level is not None), key=lambda r: (r.order_turn, r.level, r.turn))] == [
        2, 3, 7, 8, 9, 12, 20, 21, 21, 30, 31]


def test_levels_equal_brute_force_and_chains_take_few_rounds(spark, monkeypatch):
    picked, calls, results, expected = random.Random(7), [], [], {}
    for conv in range(40):
        n = picked.randrange(1, 14)
        uses = {i: sorted({picked.randrange(n) for _ in range(picked.choice((0, 1, 1, 2, 3)))}) for i in range(n)}
        if conv % 2:  # without circles
            uses = {i: [u for u in us if u < i] for i, us in uses.items()}
        turn = {i: picked.randrange(50) for i in range(n)}
        own = {i: picked.randrange(50) for i in range(n) if picked.random() < 0.7}
        calls += [(conv, turn[i], f"c{i}", "add", "{}", [f"c{u}" for u in uses[i]]) for i in range(n)]
        results += [(conv, t, f"c{i}", "x") for i, t in own.items()]
        done = {}
        while free := [i for i in range(n) if i not in done and all(u in done for u in uses[i])]:
            for i in free:
                level = max((done[u][0] + 1 for u in uses[i]), default=0)
                start = max([turn[i], *(done[u][2] for u in uses[i])])
                done[i] = (level, start, max(start, own.get(i, start)))
        for i in range(n):
            stuck = (None, turn[i], max(turn[i], own.get(i, turn[i])))
            expected[conv, f"c{i}"] = (*done.get(i, stuck), i not in done)
    calls += [(99, i, f"c{i}", "add", "{}", [f"c{i - 1}"] if i else []) for i in range(300)]
    expected |= {(99, f"c{i}"): (i, i, i, False) for i in range(300)}
    c, r, _ = frames(spark, calls, results)
    written = []
    kept = toolcalls.stored
    monkeypatch.setattr(toolcalls, "stored", lambda df, name: written.append(name) or kept(df, name))
    found = toolcalls._levels(c, r).collect()
    assert len(found) == len(expected) and {tuple(x[:2]): tuple(x[2:]) for x in found} == expected
    assert written.count("calls-levels") < 20
