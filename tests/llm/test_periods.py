from __future__ import annotations

import random
import re

import numpy as np
import pytest

from rollcall.llm.common import prepare
from rollcall.llm.periods import periodic_runs, word_runs
from tests.llm.plain import collapsed, documents
from tests.llm.plain import word_runs as plain_runs


def nested(rng, size):
    """Words with runs inside runs."""
    letters = rng.choice([1, 2, 2, 3, 6])
    words = [rng.randrange(letters)]
    while len(words) < size:
        words = words * rng.randint(1, 3) + [rng.randrange(letters) for _ in range(rng.randint(0, 3))] + words[: rng.randint(0, len(words))]
    return words[:size]


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_of_many_texts(least):
    rng = random.Random(least)
    for _ in range(300):
        texts = [nested(rng, rng.randint(0, 120)) if rng.random() < 0.8 else [rng.randrange(3) for _ in range(rng.randint(0, 200))] for _ in range(rng.randint(1, 4))]
        starts = np.cumsum([0, *map(len, texts)]).astype(np.int64)
        got = word_runs(np.array(sum(texts, []), np.int64), starts, least)
        assert got.tolist() == [[i, *r] for i, t in enumerate(texts) for r in plain_runs(t, least)]


def test_a_square_between_two_periodic_stretches():
    # Runs of periods 1, 3, 5, 7 and 9 share one centre; no string of four letters has its next occurrence seven on.
    words = [int(c == "b") for c in "ababababa" * 2]
    assert [r[3] for r in word_runs(np.array(words), np.array([0, 18]), 2).tolist()] == [p for _, _, p in plain_runs(words, 2)]
    assert {1, 2, 3, 5, 7, 9} <= {p for _, _, p in plain_runs(words, 2)}


def rows():
    rng = random.Random(4)
    made = [(i, rng.choice([" ", "\n", "  \t"]).join(f"w{x}" for x in nested(rng, rng.randint(0, 90)))) for i in range(30)]
    odd = ["", None, " \t\n", "a\x1cb a\x1cb", " x " * 20, " y　 " * 13, "é " * 11, "é " * 12, "Ab ab " * 6, "one two three " * 9_000 + "end"]
    return made + [(40 + i, t) for i, t in enumerate(odd)] + [(None, "z " * 30), (30, "z " * 30), (30, "z " * 30)]


def test_texts(spark):
    out = periodic_runs(documents(prepare(spark), rows()).selectExpr("*", "'x' AS runs", "1 AS collapsed"))
    assert out.columns[-2:] == ["runs", "collapsed"] and {"score", "__id"} <= set(out.columns)
    got = sorted(repr((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"])) for r in out.collect())
    want = []
    for i, text in rows():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        # The longest text has one known run; trying each period would take too long.
        runs = plain_runs(words) if len(words) < 1000 else [(0, 27_000, 3)]
        want.append(repr((i, runs, collapsed(words, runs))))
    assert got == sorted(want)


def test_empty(spark):
    assert periodic_runs(documents(prepare(spark), [])).count() == 0
