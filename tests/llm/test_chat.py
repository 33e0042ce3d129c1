"""Layouts to turns, and exact read-back of the template."""

import hashlib
import random

from pyspark.sql import functions as F

from quarry.llm import chat as C
from quarry.llm import queries as Q

NASTY = ["<|im_end|>", "<|im_start|>assistant", "<\\|", "<\\\\|x", "<", "|", "%3C", "\n", "\\", "é", "a b", "%0A", ""]


def test_round_trip(spark):
    rng = random.Random(6)
    rows = []
    for c in range(120):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", "a\nb<|%25", "", None]),
                         None if rng.random() < 0.1 else "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 9)))))
    rows += [(200, 0, "assistant", "x"), (200, 0, "assistant", "x"), (200, 0, "assistant", "w"), (None, None, "user", "q"),
             (201, 0, "assistant", "<|" * 40_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = C.format_conversations(C.to_turns(df)).cache()
    got = {r.conv_id: r for r in out.select(
        "conv_id", "n_turns", "formatted", "loss_spans", C.parse_turns(F.col("formatted")).alias("turns"),
        C.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    want = {}
    for c, t, r, x in rows:
        want.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(want)
    for c, ts in want.items():
        ts.sort()
        r = got[c]
        assert [(t.role, t.text) for t in r.turns] == [(b, x) for _, b, x in ts]
        assert r.loss == "".join(x for _, b, x in ts if b == "assistant") and r.n_turns == len(ts)
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == r.formatted.count("<|") / 2
    out.unpersist()


def test_layouts_are_told_apart(spark):
    df = spark.createDataFrame(
        [(1, "p", "r", None, None, None, None), (2, None, None, "i", "in", "o", None), (3, None, None, "i", None, "o", None),
         (4, None, None, None, None, None, [("human", "h"), ("gpt", None)]), (5, None, None, None, None, None, None),
         (6, None, None, None, None, None, [])],
        "conv_id long, prompt string, response string, instruction string, input string, output string, "
        "conversations array<struct<`from`:string,value:string>>")
    got = {}
    for r in C.to_turns(df).orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.layout, r.role, r.text))
    assert got == {
        1: [("prompt_response", "user", "p"), ("prompt_response", "assistant", "r")],
        2: [("instruction_input", "user", "i"), ("instruction_input", "user", "in"), ("instruction_input", "assistant", "o")],
        3: [("instruction", "user", "i"), ("instruction", "assistant", "o")],
        4: [("from_value", "user", "h"), ("from_value", "assistant", "")],
        5: [(None, "unknown", "")]}   # 6: an empty list has no turns
    assert C.field_paths(df.schema)[0] == "conv_id" and "conversations[].from" in C.field_paths(df.schema)


def test_query_probe_and_plan(spark):
    df = Q.QUERIES["op5_chat_format"](spark, "/root/testdata/sf0.001")
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    r = df.filter("conv_id = -1").first()
    probe = Q.CONTROL_PROBE
    assert (r.n_turns, r.loss_chars) == (2, len(probe))
    assert r.turns_sha256 == hashlib.sha256(f"user\n{probe}\nassistant\n{probe}\n".encode()).hexdigest()
    assert r.loss_sha256 == hashlib.sha256(probe.encode()).hexdigest()


def test_all_layouts_in_one_table(spark):
    cols = ["turn long", "role string", "text string", "prompt string", "response string", "completion string", "system string",
            "instruction string", "output string", "input string", "messages array<struct<role:string,content:string>>",
            "conversations array<struct<`from`:string,value:string>>"]
    names = [c.split(" ")[0] for c in cols]
    cases = [
        (dict(turn=3, role="user", text="t"), "turn_rows", [(3, "user", "t")]),
        (dict(role="user", text="t"), "turn_rows", [(None, "user", "t")]),
        (dict(text="t"), "turn_rows", [(None, "", "t")]),
        (dict(turn=1), "turn_rows", [(1, "", "")]),
        (dict(prompt="p", response="r"), "prompt_response", [(0, "user", "p"), (1, "assistant", "r")]),
        (dict(prompt="p", completion="c"), "prompt_completion", [(0, "user", "p"), (1, "assistant", "c")]),
        (dict(prompt="p", response="r", system="s"), "system_prompt_response",
         [(0, "system", "s"), (1, "user", "p"), (2, "assistant", "r")]),
        (dict(instruction="i", output="o"), "instruction", [(0, "user", "i"), (1, "assistant", "o")]),
        (dict(instruction="i", output="o", input="n"), "instruction_input",
         [(0, "user", "i"), (1, "user", "n"), (2, "assistant", "o")]),
        (dict(messages=[("user", "a"), ("bot", None)]), "messages", [(0, "user", "a"), (1, "assistant", "")]),
        (dict(conversations=[("human", "h")]), "from_value", [(0, "user", "h")]),
        (dict(messages=[]), "messages", []),
        # partial rows, and rows with a path too many
        (dict(prompt="p"), None, [(0, "user", "p")]),
        (dict(instruction="i"), None, [(0, "user", "i")]),
        (dict(response="r", system="s"), None, [(0, "system", "s"), (1, "assistant", "r")]),
        (dict(prompt="p", response="r", output="o"), None, [(0, "user", "p"), (1, "assistant", "r"), (2, "assistant", "o")]),
        (dict(messages=[("user", "a")], text="t", prompt="p"), None, [(0, "user", "p"), (1, "user", "a"), (2, "unknown", "t")]),
        (dict(turn=1, role="user", prompt="p"), None, [(0, "user", "p")]),
    ]
    rows = [(i, *(c.get(n) for n in names)) for i, (c, _, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "conv_id long, " + ", ".join(cols))
    got = {}
    for r in C.to_turns(df).orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.layout, r.turn, r.role, r.text))
    for i, (_, layout, turns) in enumerate(cases):
        want = [(layout, *t) for t in turns]
        assert sorted(got.get(i, []), key=str) == sorted(want, key=str), (cases[i], got.get(i))
    # a row with nothing is a turn row when the table has such rows, else unknown
    empty = spark.createDataFrame([(1, None, None, None)], "conv_id long, prompt string, response string, system string")
    assert [tuple(r) for r in C.to_turns(empty).collect()] == [(1, 0, "unknown", "", None)]


def turns_of(df, **kw):
    got = {}
    for r in C.to_turns(df, **kw).orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.layout, r.role, r.text))
    return got


def test_content_parts_are_joined(spark):
    df = spark.createDataFrame(
        [(1, [("user", [("text", "Look: "), ("image", None), ("text", "what is it?")]), ("assistant", [("text", "A cat.")])], None),
         (2, [("user", None)], "be brief"), (3, [("user", [])], None)],
        "conv_id long, messages array<struct<role:string,content:array<struct<type:string,text:string>>>>, system string")
    got = turns_of(df)
    assert got[1] == [("messages", "user", 'Look: {"type":"image"}what is it?'), ("messages", "assistant", "A cat.")]
    assert got[2] == [("system_messages", "system", "be brief"), ("system_messages", "user", "")]
    assert got[3] == [("messages", "user", "")]
    both = spark.createDataFrame([(1, "s", [("human", "h"), ("gpt", "g")])],
                                 "conv_id long, system string, conversations array<struct<`from`:string,value:string>>")
    assert turns_of(both)[1] == [("system_from_value", "system", "s"), ("system_from_value", "user", "h"), ("system_from_value", "assistant", "g")]


def test_texts_of_unknown_fields_are_kept(spark):
    df = spark.createDataFrame(
        [(1, "q", "a", None, None, None), (2, "q", None, ("deep", ["x", "y"]), None, None), (3, None, None, None, [("n", "m")], 5),
         (4, None, None, None, None, 7)],
        "conv_id long, question string, answer string, extra struct<note:string,tags:array<string>>, "
        "log array<struct<who:string,text:string>>, n long")
    got = turns_of(df)
    assert got[1] == [("question_answer", "user", "q"), ("question_answer", "assistant", "a")]
    assert got[2] == [(None, "user", "q"), (None, "unknown", "deep"), (None, "unknown", "xy")]
    assert got[3] == [(None, "unknown", "m")]
    assert got[4] == [(None, "unknown", "")]


def test_mappings_over_struct_paths(spark):
    m = C.Mapping("nested", ("data.answer", "data.question"), turns=(("user", "data.question"), ("assistant", "data.answer")))
    inner = C.Mapping("inner", ("data.chat[].by", "data.chat[].says"), items=("data.chat", "by", "says"))
    df = spark.createDataFrame([(1, ("q", "a", None), 5), (2, (None, None, [("human", "h")]), 5), (3, None, 5)],
                               "conv_id long, data struct<question:string,answer:string,chat:array<struct<by:string,says:string>>>, `data.x` long")
    got = turns_of(df, mappings=(m, inner))
    assert got == {1: [("nested", "user", "q"), ("nested", "assistant", "a")], 2: [("inner", "user", "h")], 3: [(None, "unknown", "")]}
