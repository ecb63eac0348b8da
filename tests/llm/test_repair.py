from __future__ import annotations

import itertools
import random
from collections import defaultdict
from hashlib import sha256

from rollcall.llm.common import prepare
from rollcall.llm.repair import BLOCK, cheapest_edits, repair_report, repaired_digests, repaired_turns
from tests.llm.plain import best_edits, repaired

SCHEMA = "conv_id long, turn long, role string, text string, audit string, __id string"


def plainly(turns):
    return best_edits([({"x": "tool"}.get(c.lower(), c.lower()), int(c.isupper()), c == "-") for c in turns])


def test_search_equals_trying_all():
    for size in range(4):
        for turns in itertools.product("suaxSUAX-", repeat=size):
            assert cheapest_edits("".join(turns)) == plainly(turns)
    rng = random.Random(2)
    for _ in range(400):
        kinds = rng.choice(["suaxSUAX-", "uuuuua", "uaUA", "aaau-x", "ssu"])
        turns = "".join(rng.choice(kinds) for _ in range(rng.randint(0, 4 * BLOCK)))
        assert cheapest_edits(turns) == plainly(turns)


def test_a_long_conversation():
    assert cheapest_edits("u" * 100_000) == (100_000, "KR" * 50_000)
    turns = "".join(random.Random(1).choice("suaxSUAX-") for _ in range(5000))
    assert cheapest_edits(turns) == plainly(turns)


def rows():
    rng = random.Random(7)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "User"], ["Yes.", "no", " ", "", None, "Ok?\n", "!x", " ", "a" * 50_000 + "."]
    out = []
    for conv in [*range(60), 2**53, 2**53 + 1, -5, None]:
        size = rng.choice([0, 1, 2, 5, 9, 40])
        for _ in range(size):
            usual = rng.random() < 0.6
            role = rng.choice(roles[:2] if usual else roles)
            turn = rng.choice([None, *range(12)])
            out.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.5 else f"{rng.randrange(99)}.", "x", "y"))
    return out + out[:20]


def test_conversations(spark):
    turns = prepare(spark).createDataFrame(rows(), SCHEMA).repartition(5)
    groups = defaultdict(list)
    for conv, turn, role, text, *_ in rows():
        groups[conv].append((turn, role, text))
    want = {c: repaired(g) for c, g in groups.items()}
    report = repair_report(turns)
    assert {r["conv_id"]: tuple(r)[1:] for r in report.collect()} == {c: w[0] for c, w in want.items()}
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repaired_digests(turns, report).collect()}
    assert digests == {c: sha256("\n".join(f"{a}:{b}" for a, b in w[1]).encode()).hexdigest() for c, w in want.items()}
    got = defaultdict(list)
    for r in sorted(repaired_turns(turns, report).collect(), key=lambda r: r["position"]):
        got[r["conv_id"]].append((r["role"], r["text"]))
    assert dict(got) == {c: w[1] for c, w in want.items() if w[1]}


def test_text_ids(spark):
    turns = prepare(spark).createDataFrame([("b", 1, "user", "Hi."), ("a", 1, "user", "Hi.")], "name string, turn int, role string, text string")
    got = repair_report(turns, "name")
    assert got.columns[0] == "name" and {(r["name"], r["audit"]) for r in got.collect()} == {("a", "KI"), ("b", "KI")}


def test_empty(spark):
    none = prepare(spark).createDataFrame([], SCHEMA)
    assert repair_report(none).count() == 0 == repaired_digests(none, repair_report(none)).count()
