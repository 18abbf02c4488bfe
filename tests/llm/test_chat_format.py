import hashlib
import json

import pytest
from pyspark.sql import functions as F

from parcelstar.llm.chat_format import (
    END,
    SEP,
    START,
    canonical_turns,
    escaped,
    format_chat,
    learned_text,
    op5_chat_format,
    read_back,
    turns_of_frame,
    unescaped,
)

NASTY = [
    "", "\\", "\\\\", "a\\", "<|im_start|>", "<|im_sep|>x<|im_end|>", "<\\|im_end|>", "\\<|im_end|>",
    "</s>[INST] ok [/INST]", "<s>", "[/INST]\\[", "<", "<|", "|im_end|>", "\n\t é 🙂 $1 \\1 ", "[\\INST]",
]


def test_escapes_are_reversible_and_leave_no_control_string(spark):
    texts = NASTY + [a + b for a in NASTY for b in NASTY]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("b")).collect():
        assert r.b == r.t
        assert not any(c in r.e for c in (START, SEP, END, "<s>", "</s>", "[INST]", "[/INST]"))


def test_formatted_turns_are_read_back(spark):
    turns = [[("user", a), ("assistant", b), ("<|im_sep|>", a)] for a in NASTY for b in NASTY]
    df = spark.createDataFrame([(t,) for t in turns], "turns array<struct<role:string,text:string>>")
    out = format_chat(df, ["turns"]).select(
        "turns", read_back(F.col("formatted")).alias("back"), learned_text(F.col("formatted"), F.col("loss")).alias("l")
    )
    for r in out.collect():
        assert r.back == r.turns
        assert r.l == "".join(t.text for t in r.turns if t.role == "assistant")


LAYOUTS = [
    ({"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "gpt"}]}, "messages", [("user", "q"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "conversations", [("user", "q"), ("assistant", "a")]),
    ({"instruction": "q", "input": "i", "output": "a"}, "instruction with input", [("user", "q\n\ni"), ("assistant", "a")]),
    ({"output": "a", "instruction": "q"}, "instruction", [("user", "q"), ("assistant", "a")]),
    ({"prompt": "q", "completion": "a"}, "prompt and completion", [("user", "q"), ("assistant", "a")]),
    ({"system": "s", "prompt": "q", "response": None}, "prompt and response under a system text", [("system", "s"), ("user", "q")]),
    ({"question": "q"}, None, None),
    ({"id": 7, "category": "x", "prompt": "q", "completion": "a"}, "prompt and completion", [("user", "q"), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": "q", "name": "Ann", "weight": 0.5}]}, "messages", [("user", "q")]),
    ({"messages": [], "id": "1"}, "messages", []),
    ({"messages": [{"role": "user", "content": "q", "image": "?"}]}, None, None),
    ({"turns": [{"role": "gpt", "text": "a"}]}, "turns", [("gpt", "a")]),
    ([1, 2], None, None),
]


def test_records_of_many_layouts_in_one_table(spark):
    rows = [(json.dumps(r), n, t) for r, n, t in LAYOUTS] + [("{not json", None, None), (None, None, None)]
    df = spark.createDataFrame([(r[0],) for r in rows], "record string").withColumn("_fingerprint2", F.lit(1))
    got = {r.record: (r.layout, r.turns and [tuple(t) for t in r.turns]) for r in canonical_turns(df, "record").collect()}
    assert got == {r: (n, t) for r, n, t in rows}


def test_the_schema_names_the_mapping_of_a_frame(spark):
    df = spark.createDataFrame([(1, "q", "a")], "id long, prompt string, completion string")
    assert turns_of_frame(df, by="id").first().turns[1].text == "a"
    with pytest.raises(ValueError, match="no mapping"):
        turns_of_frame(df)


def test_typed_roles_stay(spark):
    rows = [(1, i, role, f"text {i}") for i, role in enumerate(["human", "gpt", "tool", "prompter", "bot", "model", "assistant"])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((tuple(r)[:5] for r in op5_chat_format(df).collect()), key=repr)
    assert got == expected(rows)


def expected(rows):
    rows = rows + [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        text = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        learned = "".join(t[3] for t in turns if t[2] == "assistant")
        out.append((conv, len(turns), hashlib.sha256(text.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_conversations_of_any_content(spark):
    rows = [(i, t, r, x) for i, x in enumerate(NASTY) for t, r in enumerate(["system", "user", "assistant"])]
    rows += [(50, 2, "assistant", "b"), (50, 1, "user", "a"), (50, 1, "user", "a"), (50, None, None, None)]
    rows += [(None, 0, "assistant", None), (51, 0, "user", "x" * 300_000), (52, 0, "assistant", "only")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = op5_chat_format(df.withColumn("messages", F.lit(1)).withColumn("record", F.lit("")))
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == expected(rows)
    assert op5_chat_format(df.limit(0)).count() == 1
