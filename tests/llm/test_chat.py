import hashlib
import random

import pytest
from pyspark.sql import functions as F

from segmint.llm.chat import ChatTemplate, chat_digests, controls, format_conversations, read_turns, with_example

ROWS = "conv_id long, turn long, role string, text string"


def digests(conversations):
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = {}
    for cid, turns in conversations.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        out[cid] = (len(turns), h("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), h(learned))
    return out


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(5)
    bits = [*controls(ChatTemplate()), "\\", "\\\\", "#", "##", "</", "<", "turn>", ")", "\n", " ", "é", "😀", "Role(", "$1", "</turn>\n", "### "]
    conversations = {i: [(rng.choice(["system", "user", "assistant", "tool", "", "a)## b", "### User:"]),
                          "".join(rng.choices(bits, k=rng.randrange(12)))) for _ in range(rng.randrange(1, 6))] for i in range(300)}
    rows = [(i, k, r, t) for i, turns in conversations.items() for k, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, ROWS)
    got = {r.conv_id: tuple(r)[1:5] for r in chat_digests(df).collect()}
    assert got == digests(conversations)
    out = format_conversations(df).select("conv_id", "formatted", "segments", read_turns(F.col("formatted"), ChatTemplate()).alias("back")).collect()
    for r in out:
        assert [tuple(x) for x in r.back] == conversations[r.conv_id]
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.formatted.count("</turn>") == len(conversations[r.conv_id])


def test_machine(spark):
    orders = {1: "sua", 2: "uau", 3: "au", 4: "uu", 5: "s", 6: "ss", 7: "suaua", 8: "uaxa", 9: "usa"}
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    df = spark.createDataFrame([(i, k, names[c], "t") for i, o in orders.items() for k, c in enumerate(o)], ROWS)
    got = {r.conv_id: (r.valid, r.bad_turn) for r in format_conversations(df).collect()}
    assert got == {1: (True, None), 2: (True, None), 3: (False, 0), 4: (False, 1), 5: (False, None), 6: (False, 1), 7: (True, None),
                   8: (False, 2), 9: (False, 1)}


def test_other_template(spark):
    t = ChatTemplate(start=(("user", "<|u|>"), ("assistant", "<|a|>")), other=("<|r|", "|r|>>"), gap="", end="<|/|>", after="", loss=("user", "assistant"),
                     moves=(("start", (("user", "start"), ("assistant", "start"))),), accept=("start",))
    df = spark.createDataFrame([(1, 0, "user", "<|a|><|/|>"), (1, 1, "assistant", "\\<|u|>"), (1, 2, "user", "")], ROWS)
    row = format_conversations(df, t).select("*", read_turns(F.col("formatted"), t).alias("back")).first()
    assert row.valid and [x.text for x in row.back] == ["<|a|><|/|>", "\\<|u|>", ""]
    assert row.formatted.startswith("<|u|><\\|a|><\\|/|><|/|><|a|>\\\\<\\|u|><|/|>")
    for wrong in ({"end": "<>x<"}, {"end": "x"}, {"start": (("user", "<|u"), ("assistant", "<|us"))}, {"accept": ("gone",)}):
        with pytest.raises(ValueError):
            format_conversations(df, t._replace(**wrong)).collect()


def test_odd_rows(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, 1, "assistant", None), (1, 0, "user", "q"), (1, 0, "user", "q"), (2, None, None, "x"),
            (3, 0, "user", "long </turn> \\" * 200_000)]
    df = spark.createDataFrame(rows, ROWS).withColumns({"turns": F.lit(1), "segments": F.lit("x"), "one": F.lit(2)})
    got = sorted((tuple(r)[:5] for r in chat_digests(df).collect()), key=lambda r: (r[0] is not None, r))
    want = digests({1: [("user", "q"), ("user", "q"), ("assistant", "")], 2: [("", "x")], 3: [("user", rows[-1][3])]})
    assert [r[1:] for r in got if r[0] is not None] == [want[i] for i in (1, 2, 3)]
    assert sorted(r[1:4] for r in got if r[0] is None) == sorted(r[:3] for r in digests({1: [("user", "a")], 2: [("assistant", "b")]}).values())
    assert chat_digests(df.limit(0)).count() == 0


def test_fixed_conversation(spark):
    df = with_example(spark.createDataFrame([], ROWS))
    row = chat_digests(df).first()
    said = r"\### Assistant: </turn> ok"
    assert tuple(row)[:5] == (-7, *digests({-7: [("user", said), ("assistant", said)]})[-7]) and row.valid
