from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from rollcall.llm import packing
from rollcall.llm.common import prepare
from rollcall.llm.tokens import Encoder, word_tokenizer
from tests.llm.plain import documents

ODD = [
    "Don't we'LL I'm's 'tis", "a.b.c ... x!?y.", "ÉCOLE Éa.É, ß ẞ İstanbul ΑΣ ﬁ", "x<|endoftext|>y <|startoftext|>", "12a3 a1. _a_ a_.", "\t\x0b\x85 q r\x1cs", "naïve café ́a ª º µ Ǆ", "a.́ b,̈", "", " ", "\n\n.,", "日本 語。x", "😀a 😀", "A.B., C!!"
]


def direct(texts):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(word_tokenizer()).encode_batch(texts, add_special_tokens=False)]


def test_chunks_encode_like_whole_texts():
    rng = random.Random(1)
    letters = "abcdeABCÉéñß.,!?'-#0 9\n\té́ "
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    with open(word_tokenizer(), encoding="utf-8") as file:
        got = Encoder(file.read()).encode(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == direct(texts)


def test_price_finds_the_best_bin():
    rng = np.random.default_rng(3)
    for _ in range(20):
        values = rng.random(8)

        def best(room, least=1):
            return max([0, *(values[s - 1] + best(room - s, s) for s in range(least, room + 1))])

        counts = packing.price(values, 8)
        assert (counts * np.arange(1, 9)).sum() <= 8
        assert abs((counts * values).sum() - best(8)) < 1e-9


@pytest.mark.parametrize("seed", range(8))
def test_plan_holds_all_and_is_tight(seed):
    rng = random.Random(seed)
    size = 512
    histogram = Counter(min(size, max(1, int(rng.lognormvariate(4.5, 1)))) for _ in range(3000))
    groups = packing.plan(dict(histogram), size, 4)
    held = Counter()
    for lengths, number in groups:
        assert sum(lengths) <= size and number > 0
        for x in lengths:
            held[x] += number
    assert held == histogram
    least = -(-sum(k * v for k, v in histogram.items()) // size)
    assert sum(n for _, n in groups) <= max(least + 3, 1.01 * least)


def test_plan_beats_pairs_that_greedy_spoils():
    # Every bin can be full: 6 + 4 and 5 + 3 + 2.
    groups = packing.plan({6: 500, 4: 500, 5: 300, 3: 300, 2: 300}, 10, 1)
    assert sum(n for _, n in groups) <= 803


SHAPES = {
    "long tail": lambda r: min(4096, max(1, int(r.lognormvariate(6.5, 1)))),
    "middle": lambda r: r.randint(700, 1500),
    "any": lambda r: r.randint(1, 4096),
    "three of a kind": lambda r: r.randint(1200, 1365),
    "two humps": lambda r: r.randint(1800, 2300) if r.random() < 0.5 else r.randint(20, 400),
    "few sizes": lambda r: r.choice([2458, 1638, 2048, 1229, 819]),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_plan_lies_between_the_bound_and_best_fit(shape):
    rng = random.Random(6)
    histogram = dict(Counter(SHAPES[shape](rng) for _ in range(20_000)))
    number = sum(n for _, n in packing.plan(histogram))
    alone = sum(n for _, n in packing.filled(histogram, packing.SEQUENCE, 16, 1.0))
    least = packing.least_bins(histogram)
    assert least <= number <= alone and number <= 1.02 * least
    if shape == "middle":
        assert number < 0.98 * alone
    if shape == "three of a kind":
        assert number == least


def test_bound_is_below_the_best_plan():
    """Small cases whose best plan is found by trying all."""

    def fewest(lengths, rooms=()):
        if not lengths:
            return len(rooms)
        first, rest = lengths[0], lengths[1:]
        tried = [fewest(rest, (*rooms[:i], r - first, *rooms[i + 1 :])) for i, r in enumerate(rooms) if r >= first]
        return min([*tried, fewest(rest, (*rooms, 12 - first))])

    rng = random.Random(8)
    for _ in range(40):
        lengths = [rng.randint(1, 12) for _ in range(7)]
        best = fewest(tuple(lengths))
        assert packing.least_bins(dict(Counter(lengths)), 12, 60) <= best <= sum(n for _, n in packing.plan(dict(Counter(lengths)), 12))


def test_store_is_bounded(monkeypatch):
    with open(word_tokenizer(), encoding="utf-8") as file:
        encoder = Encoder(file.read())
    long = "x" * 5000
    texts = [f"{long} a{i}" for i in range(300)]
    whole = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert whole == direct(texts) and max(map(len, encoder)) <= 100


@pytest.mark.parametrize("histogram", [{}, {4096: 3}, {1: 1}, {4095: 2, 1: 1}, {2048: 5}])
def test_small_plans(histogram):
    groups = packing.plan(histogram)
    held = Counter()
    for lengths, number in groups:
        for x in lengths:
            held[x] += number
    assert held == histogram


def test_places_are_gapless(spark):
    rng = random.Random(2)
    texts = [" ".join("abc"[: rng.randint(1, 3)] for _ in range(rng.randint(0, 120))) for _ in range(150)] + [*ODD, None, "word " * 900]
    rows = [*enumerate(texts), (3, texts[3]), (None, "no id"), (None, "no id")]
    prepare(spark)
    out = packing.pack_documents(documents(spark, rows), word_tokenizer(), size=64).collect()
    want = []
    for (i, _), ids in zip(rows, direct([t or "" for _, t in rows])):
        ids = [*ids, 1]
        for piece, start in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[start : start + 64], "<u4")
            want.append(repr((i, piece, start, len(part), zlib.crc32(part.tobytes()))))
    assert sorted(repr(tuple(r)[:5]) for r in out) == sorted(want)
    held = defaultdict(list)
    for r in out:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    rooms: list[int] = []  # first fit decreasing
    for length in sorted((r["length"] for r in out), reverse=True):
        at = next((k for k, room in enumerate(rooms) if room >= length), None)
        if at is None:
            rooms.append(64 - length)
        else:
            rooms[at] -= length
    assert len(held) <= len(rooms)


def test_packed_ids(spark):
    docs = documents(prepare(spark), [(i, f"some words {i} " * (i + 1)) for i in range(30)])
    packed = packing.pack_documents(docs, word_tokenizer(), size=128)
    total = sum(r["length"] for r in packed.collect())
    ids = [np.frombuffer(r["ids"], "<u4") for r in packing.packed_ids(docs, packed, word_tokenizer(), size=128).collect()]
    assert sum(map(len, ids)) == total and sum((x == 1).sum() for x in ids) == 30


def test_empty(spark):
    assert packing.pack_documents(documents(prepare(spark), []), word_tokenizer()).count() == 0
