from __future__ import annotations

import random

import numpy as np
from rollcall.llm import hyperminhash as h
from rollcall.llm.common import prepare
from rollcall.llm.components import components
from tests.llm.plain import documents, near_groups


def family(rng, words, copies, edits):
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(words)]
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(len(own))] = f"x{rng.randint(0, 10**6)}"
        yield " ".join(own)


def rows():
    rng = random.Random(4)
    texts = [t for words, edits in ((60, 4), (200, 12), (9, 1), (30, 2), (500, 25)) for t in family(rng, words, 25, edits)]
    texts += ["one two three", "One  two\tthree", "one two", "", "  ", None, "a b c d e", "a b c d e", "x " * 5000]
    rng.shuffle(texts)
    return list(enumerate(texts)) + [(7, "one two three"), (None, "one two three"), (None, "one two three")]


def test_groups_match_plain(spark):
    data = rows()
    out = h.near_duplicates(documents(prepare(spark), data))
    group, sizes = near_groups(data)
    want = sorted(repr((i, n, group[i], group[i] == i)) for (i, _), n in zip(data, sizes))
    assert sorted(repr(tuple(r)) for r in out.collect()) == want


def test_without_rounds_blocks_find_all(spark, monkeypatch):
    monkeypatch.setattr(h, "BLOCK", 4)
    data = rows()
    group, _ = near_groups(data)
    got = {r["doc_id"]: r["component_id"] for r in h.near_duplicates(documents(prepare(spark), data)).collect()}
    assert got == group


def morse(size):
    """Two words of two letters whose polynomials agree modulo any power of two."""
    word = "a"
    while len(word) < size:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_regular_words_are_told_apart(spark):
    one, other = morse(1024)
    data = [(1, f"{one} b c d e f g"), (2, f"{other} b c d e f g"), (3, one * 300), (4, other * 300), (5, f"{one} b c d e f g")]
    got = {r["doc_id"]: r["component_id"] for r in h.near_duplicates(documents(prepare(spark), data)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_ids_with_several_texts(spark):
    """Rows that share an id are linked by any of their texts, also where their other text is that of a smaller id, short or empty."""
    rng = random.Random(9)
    first, second = (list(family(rng, 80, 20, 3)) for _ in range(2))
    data = [(100 + i, f"other {i} " * 30 if i % 2 else first[0]) for i in range(20)]
    data += [(100 + i, t) for i, t in enumerate(second)] + [(200 + i, t) for i, t in enumerate(second)]
    data += [(300, ""), (300, second[3]), (301, ""), (301, None), (302, "x y"), (302, "x z")]
    group, _ = near_groups(data)
    pairs = {}
    for i, _ in data:
        pairs.setdefault(i, i)
    got = {(r["doc_id"], r["component_id"]) for r in h.near_duplicates(documents(prepare(spark), data)).collect()}
    assert got == {(i, group[i]) for i in group}


def test_wide_buckets_are_parted(spark, monkeypatch):
    """With tiny buckets every bucket is wide; the links stay the same."""
    monkeypatch.setattr(h, "WIDE", 3)
    monkeypatch.setattr(h, "BLOCK", 4)
    data = rows()
    group, _ = near_groups(data)
    got = {r["doc_id"]: r["component_id"] for r in h.near_duplicates(documents(prepare(spark), data)).collect()}
    assert got == group


def test_a_bucket_of_strangers_stays_linear(spark, monkeypatch):
    """Members of one bucket that share nothing else: a row for each band, and no block is compared."""
    monkeypatch.setattr(h, "WIDE", 500)
    prepare(spark)
    for n in (1000, 3000):
        regs = np.random.default_rng(n).integers(0, 1 << 15, (n, h.REGISTERS), dtype=np.uint16)
        regs[:, : h.ROWS] = 7
        key = int(h.band_keys(regs[:1], 0).view(np.int64)[0, 0])
        classes = spark.createDataFrame([(i, 500, r.tobytes(), None) for i, r in enumerate(regs)], "node long, n long, many binary, few binary")
        buckets = spark.createDataFrame([(key, i, i) for i in range(n)], "key long, node long, family long")
        parted = h.narrowed(buckets, classes)
        assert parted.count() <= n * (h.BANDS - 1) and h.strangers(parted).count() <= n // 100
        assert h.block_pairs(parted, classes, 75).count() == 0


def test_a_family_in_a_bucket_meets_strangers_only(spark):
    """The rows of a bucket grow with its family and its strangers, not with the square of the family."""
    prepare(spark)
    buckets = spark.createDataFrame([(1, i, 0) for i in range(20_000)] + [(1, i, i) for i in range(20_000, 20_010)], "key long, node long, family long")
    got = h.strangers(buckets).collect()
    assert [tuple(r) for r in got] == [(1, 0, 20_000, 10)]
    assert h.narrowed(buckets, spark.createDataFrame([], "node long, n long, many binary, few binary")).count() == 20_010


def test_empty(spark):
    assert h.near_duplicates(documents(prepare(spark), [])).count() == 0
    assert [tuple(r) for r in h.near_duplicates(documents(prepare(spark), [(3, None)])).collect()] == [(3, 0, 3, True)]


def test_estimate_follows_similarity():
    rng = np.random.default_rng(5)
    for share in (0.5, 0.75, 0.9):
        found = []
        for _ in range(40):
            both = rng.integers(0, 2**63, 3000, dtype=np.uint64)
            cut = int(3000 * (1 - share) / 2)
            a, b = np.sort(both[cut:]), np.sort(both[: 3000 - cut])
            regs = h.registers([a, b])
            found.append(h.estimate((regs[:1] == regs[1:]).mean(axis=1), np.array([len(a)]), np.array([len(b)]))[0])
        assert abs(np.mean(found) - (3000 - 2 * cut) / 3000) < 0.03


def test_components(spark):
    prepare(spark)
    chain = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 51), (60, 60)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(chain).collect()}
    assert found == {i: 0 for i in range(31)} | {50: 50, 51: 50}
    later = components(spark.createDataFrame([(30, 51), (70, 71)], "a long, b long"), components(chain))
    assert {r["node"]: r["component"] for r in later.collect()} == {i: 0 for i in [*range(31), 50, 51]} | {70: 70, 71: 70}
