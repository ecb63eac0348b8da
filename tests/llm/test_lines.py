from __future__ import annotations

import random

import pytest

from rollcall.llm import lines
from rollcall.llm.common import prepare
from tests.llm.plain import documents, shared_lines

LONG = "This line is long enough to count, forty code points or more éé "


def rows():
    rng = random.Random(1)
    pool = [f"{LONG}{i}" for i in range(12)] + ["short", "", "  "]
    made = [(i, "\n".join(rng.choice(pool).upper() if rng.random() < 0.2 else rng.choice(pool) + " " * rng.randint(0, 2) for _ in range(rng.randint(0, 9)))) for i in range(40)]
    return made + [(40, None), (41, ""), (42, LONG + "0"), (42, LONG + "0"), (None, LONG + "1\nx"), (43, "\n".join([LONG + "2"] * 3000))]


def test_lines_match_plain(spark):
    out = lines.drop_shared_lines(documents(prepare(spark), rows()))
    assert {"score", "node", "__id", "lang"} <= set(out.columns)
    got = sorted((repr(tuple(r)) for r in out.select("doc_id", "n_lines", "n_dropped", "text").collect()))
    assert got == sorted(repr(r) for r in shared_lines(rows()))


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(lines, "MAX_SEGMENTS", 1)
    monkeypatch.setattr(lines, "BITS_PER_LINE", 1)
    out = lines.drop_shared_lines(documents(prepare(spark), rows()))
    got = sorted((repr(tuple(r)) for r in out.select("doc_id", "n_lines", "n_dropped", "text").collect()))
    assert got == sorted(repr(r) for r in shared_lines(rows()))


def test_names_that_clash(spark):
    names = ["__gone", "__same", "__keys", "__hashes", "__held", "__key", "out", "c0", "__out"]
    docs = documents(prepare(spark), rows())
    out = lines.drop_shared_lines(docs.selectExpr("*", *[f"'x' AS `{n}`" for n in names]))
    assert set(names) <= set(out.columns) and out.where("`__gone` <> 'x' or out <> 'x' or c0 <> 'x'").isEmpty()
    got = sorted((repr(tuple(r)) for r in out.select("doc_id", "n_lines", "n_dropped", "text").collect()))
    assert got == sorted(repr(r) for r in shared_lines(rows()))


@pytest.mark.parametrize("kept", [[], [(1, None)]])
def test_empty(spark, kept):
    assert lines.drop_shared_lines(documents(prepare(spark), kept)).count() == len(kept)
