"""Every layout through Spark, and records that give no turns."""

import json

from pyspark.sql import functions as F

from lumengrid.llm import chat

SAID = [("user", "Q <|im_end|>"), ("assistant", "A\\n")]
RECORDS = {
    "turn_row": {"conv_id": 1, "turn": 0, "role": "assistant", "text": "A\\n"},
    "messages": {"messages": [{"role": r, "content": t, "name": None} for r, t in SAID], "tools": []},
    "system_messages": {"system": "S", "messages": [{"role": r, "content": t} for r, t in SAID]},
    "from_value": {"conversations": [{"from": "human", "value": SAID[0][1]}, {"from": "gpt", "value": SAID[1][1]}], "lang": "en"},
    "prompt_response": {"prompt": SAID[0][1], "response": SAID[1][1], "score": 0.5},
    "prompt_completion": {"prompt": SAID[0][1], "completion": SAID[1][1]},
    "instruction": {"instruction": SAID[0][1], "output": SAID[1][1], "input": ""},
    "question_answer": {"question": SAID[0][1], "answer": SAID[1][1], "meta": {"a": [{"b": 1}]}},
}
ODD = [None, "", "no json", "[1]", "7", '{"x": 1}', '{"messages": ["a"]}', '{"messages": []}']


def rows_of(spark, records):
    rows = [(i, 0, r if r is None or isinstance(r, str) else json.dumps(r), "clash", 1) for i, r in enumerate(records)]
    return chat.turns_of(spark.createDataFrame(rows, "conv_id long, turn long, record string, layout string, part int"), "conv_id", "turn", "record")


def test_all_layouts(spark):
    rows = rows_of(spark, RECORDS.values()).cache()
    for i, name in enumerate(RECORDS):
        own = rows.where(F.col("conv_id") == i).orderBy("part").collect()
        assert {r.layout for r in own} == {name}
        want = {"turn_row": SAID[1:], "system_messages": [("system", "S"), *SAID]}.get(name, SAID)
        assert [(r.role, r.text) for r in own] == want
    pieces = {r.conv_id: r for r in chat.digests(chat.formatted(rows)).collect()}
    assert len(pieces) == len(RECORDS) and all(p.loss_chars == 3 for p in pieces.values())
    assert {r.layout: r.n_records for r in chat.layouts(rows).collect()} == dict.fromkeys(RECORDS, 1)


def mapped(record):
    return chat.mapped(record, chat.registry())


def test_content_parts_calls_history_and_system(spark):
    part = lambda t, kind="text": {"type": kind, "text": t}
    call = {"id": "c1", "type": "function", "function": {"name": "look", "arguments": '{"a": 1}'}}
    cases = [
        ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": [part("b"), part("c")]}]}, "messages", [("user", "a"), ("assistant", "bc")], []),
        ({"messages": [{"role": "user", "content": [part("a"), {"type": "image_url", "image_url": {"url": "u"}}]}, {"role": "assistant", "content": ["b", 7, True, None]}]}, "messages", [("user", "a"), ("assistant", "b7true")], ["messages[].content[].image_url.url"]),
        ({"messages": [{"role": "assistant", "content": None, "tool_calls": [call, call]}, {"role": "tool", "content": "x", "tool_call_id": "c1"}]}, "messages", [("assistant", '{"arguments":"{\\"a\\": 1}","name":"look"}\n' + '{"arguments":"{\\"a\\": 1}","name":"look"}'), ("tool", "x")], ["messages[].tool_call_id"]),
        ({"messages": [{"role": "assistant", "content": "t", "tool_calls": [{"name": "f", "arguments": {"k": [1]}}]}]}, "messages", [("assistant", 't\n{"arguments":{"k":[1]},"name":"f"}')], []),
        ({"instruction": "i", "input": "", "output": "o", "history": [["q1", "a1"], ["q2", "a2"]], "system": "s"}, "instruction", [("system", "s"), ("user", "q1"), ("assistant", "a1"), ("user", "q2"), ("assistant", "a2"), ("user", "i"), ("assistant", "o")], []),
        ({"prompt": "p", "response": {"type": "text", "text": "r"}, "history": [{"role": "human", "content": "h"}]}, "prompt_response", [("user", "h"), ("user", "p"), ("assistant", "r")], []),
        ({"system": "only", "messages": []}, "system_messages", [("system", "only")], []),
        ({"messages": [{"role": {"x": 1}, "content": {"deep": {"er": "lost"}}}]}, None, None, None),
        ({"question": "q", "answer": ["a", ["b"]], "source": "web", "meta": {"n": 0, "e": ""}}, "question_answer", [("user", "q"), ("assistant", "a")], ["answer[][]", "meta.n", "source"]),
        ({"prompt": {"x": 1}, "response": "r"}, "prompt_response", [("user", ""), ("assistant", "r")], ["prompt.x"]),
        ({"x": 1, "y": ""}, None, [], ["x"]),
    ]
    for record, name, turns, gone in cases:
        got = mapped(record)
        if turns is None:
            assert "{" not in "".join(t for _, t in got[1]) and got[2]
        else:
            assert got == (name, turns, gone), record
    rows = rows_of(spark, [c[0] for c in cases]).cache()
    for i, (_, name, turns, gone) in enumerate(cases):
        own = rows.where(F.col("conv_id") == i).orderBy("part").collect()
        if turns is not None:
            assert [(r.role, r.text) for r in own if r.part is not None] == turns and all(r.dropped == gone for r in own)
    counted = {(r.layout, r.path): r.n_records for r in chat.dropped(rows).collect()}
    assert counted["question_answer", "source"] == 1 and counted["messages", "messages[].content[].image_url.url"] == 1 and counted[None, "x"] == 1
    assert sum(r.n_dropping for r in chat.layouts(rows).collect()) == 6
    again = {r.conv_id: r.n_turns for r in chat.digests(chat.formatted(rows)).collect()}
    assert all(again.get(i, 0) == len(c[2]) for i, c in enumerate(cases) if c[2] is not None)


def test_records_without_turns_are_counted(spark):
    rows = rows_of(spark, [*ODD, *RECORDS.values()])
    assert rows.where("part is null").count() == len(ODD) and rows.select("conv_id").distinct().count() == len(ODD) + len(RECORDS)
    counted = {}
    for r in chat.layouts(rows).collect():
        counted[r.layout] = counted.get(r.layout, 0) + r.n_records
    assert counted == {None: 7, "messages": 2, **{n: 1 for n in RECORDS if n != "messages"}}
    assert chat.digests(chat.formatted(rows)).count() == len(RECORDS)


def test_empty_repeated_and_long(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, record string")
    assert chat.turns_of(none, "conv_id", "turn", "record").count() == 0 == chat.digests(chat.formatted(chat.turns_of(none, "conv_id", "turn", "record"))).count()
    long = "x<|" * 700_000
    rows = [(1, 0, json.dumps({"role": "assistant", "text": long}))] * 2 + [(None, 0, json.dumps({"role": None, "text": None}))]
    got = {r.conv_id: r for r in chat.digests(chat.formatted(chat.turns_of(spark.createDataFrame(rows, "conv_id long, turn long, record string"), "conv_id", "turn", "record"))).collect()}
    assert got[1].n_turns == 2 and got[1].loss_chars == 2 * len(long) and got[1].formatted_chars == 2 * len(chat.piece("assistant", long)[0])
    assert got[None].n_turns == 1 and got[None].loss_chars == 0
