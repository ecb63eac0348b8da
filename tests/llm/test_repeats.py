from __future__ import annotations

import random

import pytest
from rollcall.llm import runindex
from rollcall.llm.common import prepare
from tests.llm.plain import documents, repeats

SPAN = 60


def rows():
    rng = random.Random(9)

    def text(n):
        return "".join(rng.choice("abcdé ñ\n") for _ in range(n))

    parts = [text(n) for n in (30, 59, 60, 61, 90, 150, 400)]
    made = ["".join(rng.choice([*parts, text(rng.randint(1, 80))]) for _ in range(rng.randint(0, 6))) for _ in range(60)]
    for _ in range(30):  # near copies, which make staircases of matches
        own = list(made[5] + parts[6])
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = "#"
        made.append("".join(own))
    made += ["", None, "abab" * 200, "x" * 500, parts[6], parts[6], parts[3][:59]]
    return [*enumerate(made), (3, made[3]), (None, parts[5]), (None, parts[5])]


@pytest.mark.parametrize("indexed", [runindex.INDEXED, 1])
def test_matches_plain(spark, monkeypatch, indexed):
    monkeypatch.setattr(runindex, "INDEXED", indexed)
    data = rows()
    out = runindex.remove_repeats(documents(prepare(spark), data), span=SPAN).collect()
    want = []
    for (i, text), runs in zip(data, repeats(data, SPAN)):
        b = (text or "").encode()
        kept = b"".join(bytes([x]) for j, x in enumerate(b) if not any(s <= j < e for s, e in runs))
        want.append((i, len(b), kept, len(b) - len(kept), runs))
    got = [(r["doc_id"], r["n_bytes"], bytes(r["kept"]), r["n_removed"], [tuple(s) for s in r["spans"]]) for r in out]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_very_long_text_in_parts(spark, monkeypatch):
    monkeypatch.setattr(runindex, "PLACE_BITS", 10)
    rng = random.Random(2)
    body = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    data = [(1, body + body[500:900] + "tail"), (2, body[1000:1200])]
    out = runindex.remove_repeats(documents(prepare(spark), data), span=SPAN).collect()
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in out}
    assert got == dict(zip((1, 2), repeats(data, SPAN)))


def test_empty(spark):
    assert runindex.remove_repeats(documents(prepare(spark), [])).count() == 0
