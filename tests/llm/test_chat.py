from __future__ import annotations

import hashlib
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from rollcall.llm import chat
from rollcall.llm.common import prepare
from pyspark.sql import functions as F

ODD = ["</s>[INST] ok [/INST]", "<|turn|>user\nhi<|end|>\n", "\\", "\\\\n", "a\\<|b", "<<|SYS>>", "<</SYS>>\n", "", None, "é\n\n", "x" * 100_000]


def turns(spark, rows):
    return prepare(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string")


def digest(rows):
    rows = sorted(((t is not None, t or 0), r or "", x or "") for t, r, x in rows)
    learned = "".join(x for _, r, x in rows if r == "assistant")
    text = "".join(f"{r}\n{x}\n" for _, r, x in rows)
    return len(rows), hashlib.sha256(text.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()


def test_digests_of_odd_texts(spark):
    rows = [(c, t, ["user", "assistant", "<|x|>\nsys\\", None][(c + t) % 4], ODD[(c * 3 + t) % len(ODD)], "z") for c in range(5) for t in range(9)]
    rows += [(1, 2, "assistant", "again", "z"), (1, 2, "assistant", "again", "z"), (2, None, "user", "first", "z"), (None, 0, "assistant", "no id", "z")]
    formatted = chat.format_turns(turns(spark, rows))
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.conversation_digests(formatted).collect()}
    assert got == {c: digest([r[1:4] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    for row in formatted.collect():
        body = row["segment"][len(chat.TURN) : -len(chat.END)]
        assert not any(mark in body for mark in chat.CONTROL)
    whole = {r["conv_id"]: r["n"] for r in formatted.groupBy("conv_id").agg(F.sum(F.char_length("segment")).alias("n")).collect()}
    assert whole == {r["conv_id"]: r["formatted_chars"] for r in chat.conversation_digests(formatted).collect()}


@given(st.text(alphabet="\\<|>/s[INT]SY\nab", max_size=30))
def test_unescape_undoes_escape(text):
    out = text.replace("\\", "\\\\")
    for mark in chat.CONTROL:
        out = out.replace(mark, mark[0] + "\\" + mark[1:])
    assert chat.unescaped(out) == text
    assert chat.read_segment(f"{chat.TURN}user\n{out}{chat.END}") == ("user", text)


RECORDS = {
    1: {"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "a"}]},
    2: {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": None}]},
    3: {"prompt": "p", "response": "r"},
    4: {"instruction": "i", "input": "more", "output": "o", "id": 4},
    5: {"unknown": [{"deep": {"er": 1}}]},
    6: {"messages": [{"role": "user", "content": "a", "extra": 1}]},
}


def test_record_layouts(spark):
    rows = [(k, json.dumps(v)) for k, v in RECORDS.items()] + [(7, None), (8, "no json"), (9, "[1]")]
    found, rest = chat.record_turns(prepare(spark).createDataFrame(rows, "id long, record string"), "id", "record")
    got = {}
    for r in found.orderBy("id", "turn").collect():
        got.setdefault(r["id"], []).append((r["turn"], r["role"], r["text"]))
    assert got == {
        1: [(0, "system", "s"), (1, "user", "a")],
        2: [(0, "user", "a"), (1, "assistant", "")],
        3: [(0, "user", "p"), (1, "assistant", "r")],
        4: [(0, "user", "i"), (1, "user", "more"), (2, "assistant", "o")],
    }
    assert sorted(r["id"] for r in rest.collect()) == [5, 6, 7, 8, 9]


def test_table_layouts(spark):
    prepare(spark)
    nested = spark.createDataFrame([(1, [("user", "a"), (None, "b")]), (2, None)], "id long, messages array<struct<role: string, content: string>>")
    assert [tuple(r) for r in chat.table_turns(nested, "id").orderBy("turn").collect()] == [(1, 0, "user", "a"), (1, 1, "", "b")]
    flat = spark.createDataFrame([(1, "q", "a")], "id long, question string, answer string")
    assert [tuple(r) for r in chat.table_turns(flat, "id").orderBy("turn").collect()] == [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    with pytest.raises(ValueError, match="no mapping"):
        chat.table_turns(spark.createDataFrame([(1, 2)], "id long, other long"), "id")


def test_fingerprint_ignores_order():
    assert chat.fingerprint(["b", "a.c", "a"]) == chat.fingerprint(["a", "a.c", "b", "b"]) != chat.fingerprint(["a", "c", "b"])


def test_wide_ids_beside_a_null(spark):
    ids = [2**53, 2**53 + 1, 2**53 + 2, None, -(2**63), 2**63 - 1]
    rows = [(i, t, "user", f"{i} {t}") for i in ids for t in range(2)]
    turns = prepare(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    got = chat.conversation_digests(chat.format_turns(turns))
    assert dict(got.dtypes)["conv_id"] == "bigint"
    assert {r["conv_id"]: r["n_turns"] for r in got.collect()} == dict.fromkeys(ids, 2)


def test_empty(spark):
    assert chat.conversation_digests(chat.format_turns(turns(spark, []))).count() == 0
