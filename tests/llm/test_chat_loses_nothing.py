"""Every message and call that goes into operator 10 comes out of it."""

import json
import random
from collections import Counter

from tejido.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def made(spark, rows):
    return chat.formatted(spark.createDataFrame(rows, SCHEMA)).collect()


def calls(*each, **more):
    return json.dumps({"tool_calls": list(each)} | more)


def test_calls_without_an_id(spark):
    rows = made(spark, [(1, 0, "user", "q"), (1, 1, "assistant", calls({"name": "f", "arguments": {"a": 1}}, {"id": "x", "name": "f", "arguments": {}}, None))])
    found = sorted((str(r.call_id), str(r.tool), r.status) for r in rows if r.kind == "call" and r.role == "assistant")
    assert found == [("None", "None", "rejected"), ("None", "f", "rejected"), ("x", "f", "invalid")]
    assert any(r.record.startswith('{"arguments":{"a":1},"id":null') for r in rows if r.status == "rejected")


def test_made_ids_clash_with_none(spark):
    rows = made(spark, [(1, 1, "user", "q"), (1, 2, "assistant", calls({"id": "call_1", "name": "f", "arguments": {}})), (1, 3, "tool", '{"tool_call_id": "call_1", "content": "r"}'), (1, 4, "assistant", "a"), (2, 1, "user", "q"), (3, 5, "user", "q"), (3, 6, "tool", '{"tool_call_id": "__call_9", "content": "r"}')])
    found = {(r.conv_id, r.call_id): r for r in rows if r.kind == "call"}
    assert {k: (r.role, r.n_copies, r.result_turn) for k, r in found.items()} == {(1, "_call_1"): ("user", 1, 4), (1, "call_1"): ("assistant", 1, 3), (2, "call_1"): ("user", 1, None), (3, "___call_5"): ("user", 1, None)}
    assert [r.status for r in rows if r.call_id == "__call_9"] == ["unlinked"]


def test_calls_that_share_an_id(spark):
    rows = made(spark, [(1, 1, "assistant", calls({"id": "x", "name": "f", "arguments": {"n": 1}}, {"id": "x", "name": "f", "arguments": {"n": 2}})), (1, 2, "assistant", calls({"id": "x", "name": "g", "arguments": {"n": 3}})), (1, 3, "tool", '{"tool_call_id": "x", "content": "r"}')])
    assert sorted((r.turn, r.arguments_json, r.status, r.n_results) for r in rows if r.kind == "call") == [(1, '{"n":1}', "invalid", 1), (1, '{"n":2}', "repeated", 0), (2, '{"n":3}', "repeated", 0)]


def test_content_beside_calls_and_space_before_them(spark):
    rows = made(spark, [(1, 1, "assistant", " \n" + calls({"id": "x", "name": "f", "arguments": {}}, content="I look")), (1, 2, "tool", '\t{"tool_call_id": "x", "content": "r"} '), (1, 3, "assistant", '{"tool_calls": [{"id": "cut')])
    assert sorted((r.turn, r.kind, r.status, r.n_copies) for r in rows) == [(1, "call", "invalid", 1), (1, "message", "beside", 1), (2, "result", "linked", 1), (3, "message", "unlinked", 1)]
    assert next(r.record for r in rows if r.status == "beside") == '{"content":"I look","role":"assistant","turn":1}'


def test_rows_account_for_all_messages_and_calls(spark):
    rng = random.Random(17)
    ids = ["x", "y", "call_1", "_call_2", None, ""]

    def text(role):
        if role == "assistant" and rng.random() < 0.6:
            each = [{k: v for k, v in (("id", rng.choice(ids)), ("name", rng.choice(["f", "reply", None])), ("arguments", rng.choice([{"a": 1}, {"a": 2}, "no", None])), ("after", rng.choice(ids))) if rng.random() < 0.9} for _ in range(rng.randint(0, 3))]
            more = {"content": rng.choice(["said", "", None])} if rng.random() < 0.5 else {}
            return rng.choice(["", " ", "\n"]) + calls(*each, **more) + rng.choice(["", " ", "}"])
        if role == "tool" and rng.random() < 0.6:
            return json.dumps({"tool_call_id": rng.choice(ids), "content": rng.choice(["r", None])})
        return rng.choice(["a", "b", "", None, "{", "[1]"])

    rows = []
    for conv in [*range(60), None]:
        for _ in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "assistant", "tool", "system", None])
            rows.append((conv, rng.choice([0, 1, 1, 2, 3, 4, None]), role, text(role)))
    rows += rng.sample(rows, 40)  # repeated rows
    want, n_calls = Counter(), 0
    for conv, turn, role, t in rows:
        held = None
        if role == "assistant" and conv is not None and turn is not None and (t or "").strip(" \t\r\n").startswith("{"):
            try:
                held = json.loads(t)
            except ValueError:
                held = None
        if held and held.get("tool_calls"):
            n_calls += len(held["tool_calls"])
            if held.get("content") is not None:
                want[str(conv), turn, role] += 1
        else:
            want[str(conv), turn, role] += 1
    found = made(spark, rows)
    assert sum(r.n_copies for r in found if r.kind == "call" and r.role == "assistant") == n_calls
    got = Counter()
    for r in found:
        if r.kind != "call" or r.role == "user":
            got[str(r.conv_id), r.turn, r.role] += r.n_copies
    assert got == want
    linked = Counter((r.conv_id, r.call_id) for r in found if r.kind == "call" and r.status not in ("repeated", "rejected"))
    assert set(linked.values()) == {1}
