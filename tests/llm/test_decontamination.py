from __future__ import annotations

import os
import random
import subprocess
import sys
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from rollcall.llm import decontamination as d
from rollcall.llm.common import prepare, text_bytes
from tests.llm.plain import documents, edits_within, item_words

rng = random.Random(3)


def sentence(n):
    return " ".join("".join(rng.choice("abcdefghijk") for _ in range(rng.randint(2, 7))) for _ in range(n))


ITEMS = [(k, sentence(n)) for k, n in enumerate((12, 25, 40, 60, 18, 33))] + [(6, "tiny item here"), (7, None), (8, "..."), (1, "Again, an item with this id!")]


def changed(text, edits):
    words = text.split()
    for _ in range(edits):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        words[at : at + (kind != 2)] = [] if kind == 0 else ["new" + str(rng.randint(0, 999))]
    return " ".join(words)


def rows():
    made = [f"{sentence(rng.randint(0, 80))} {changed(t, rng.randint(0, len(t.split()) // 10)).upper()}, {sentence(30)}" for _, t in ITEMS[:6] for _ in range(6)]
    made += [sentence(200) for _ in range(10)] + ["So a TINY item, here it is", "tiny item", "", None, ITEMS[2][1], "word " * 4000 + ITEMS[3][1]]
    return [*enumerate(made), (0, made[0]), (None, ITEMS[0][1])]


def test_matches_plain(spark):
    data = rows()
    items = prepare(spark).createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    out = d.contaminated(documents(spark, data), items).collect()
    got = sorted((repr((r["doc_id"], r["item_id"], r["item_words"])) for r in out))
    want = []
    for i, text in data:
        for k, item in ITEMS:
            words = item_words(item)
            if words and edits_within(words, item_words(text)) <= len(words) // 10:
                want.append(repr((i, k, len(words))))
    assert got == sorted(want)
    edits = {(r["doc_id"], r["item_id"]): r["edits"] for r in out}
    text = dict(data)
    assert all(n == edits_within(item_words(dict(ITEMS[:9])[k]), item_words(text[i])) for (i, k), n in edits.items() if k != 1)


@pytest.mark.parametrize("item, text", [("word " * 1000, "word " * 10_000), ("a b " * 500, "b a " * 4000 + "c " + "a b " * 4000), ("x y z " * 200 + "w", "x y z q " * 3000)])
def test_texts_that_repeat_themselves(item, text):
    """An item of one word and a document of it: the hits of all offsets are not unfolded, and windows that overlap are compared once."""
    begun = time.monotonic()
    items = d.Items([1], [item])
    words = d.plain_words(*text_bytes(pa.array([text, "other words " + item], pa.large_string())))
    found = {m[0]: m[2] for m in d.matches(items, *words)}
    assert time.monotonic() - begun < 20 and found[1] == 0
    most = len(item.split()) // 10
    exact = edits_of(item.split(), text.split())
    assert found.get(0, most + 1) == min(exact, most + 1)


def edits_of(item, words):
    return d.edit_distance(*(np.array([hash(w) for w in x], np.int64) for x in (item, words)))[0]


ELSEWHERE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", {folder!r}).getOrCreate()
from rollcall.llm.common import prepare
from rollcall.llm.decontamination import contaminated
item = " ".join(f"w{{i}}" for i in range(30))
docs = prepare(spark).createDataFrame([(1, "x " + item), (2, "y")], "doc_id long, text string")
print("FOUND", [r["doc_id"] for r in contaminated(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()])
"""


def test_executors_without_the_package(tmp_path):
    code = ELSEWHERE.format(repo=str(Path(__file__).resolve().parents[2]), folder=str(tmp_path / "warehouse"))
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300)
    assert "FOUND [1]" in out.stdout, out.stderr[-2000:]


def test_recall_with_edits():
    items = d.Items([i for i, _ in ITEMS[:6]], [t for _, t in ITEMS[:6]])
    found = tried = 0
    for number, text in ITEMS[:6]:
        for _ in range(60):
            body = f"{sentence(rng.randint(0, 60))} {changed(text, len(text.split()) // 10)} {sentence(40)}"
            words = d.plain_words(*text_bytes(pa.array([body], pa.large_string())))
            found += any(m[1] == number for m in d.matches(items, *words))
            tried += 1
    assert found / tried >= 0.97


def test_edit_distance_matches_plain():
    source = np.random.default_rng(1)
    for _ in range(200):
        item, window = (source.integers(0, 4, source.integers(1, 12)).astype(np.uint64) for _ in range(2))
        edits, begin, end = d.edit_distance(item, window)
        assert edits == edits_within(item.tolist(), window.tolist()) == edits_within(item.tolist(), window[begin:end].tolist())


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(d, "ITEM_BYTES", 100)
    items = prepare(spark).createDataFrame(ITEMS[:6], "item_id long, text string")
    out = d.contaminated(documents(spark, [(k, t) for k, t in ITEMS[:6]]), items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in out) == [(k, k) for k in range(6)]


def test_empty(spark):
    none = prepare(spark).createDataFrame([], "item_id long, text string")
    assert d.contaminated(documents(spark, rows()), none).count() == 0
    assert d.contaminated(documents(spark, []), none).count() == 0
