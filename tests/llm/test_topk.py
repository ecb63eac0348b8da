from __future__ import annotations

import numpy as np
import pytest
from rollcall.llm import topk
from rollcall.llm.common import prepare
from pyspark.sql import functions as F


def plain(rows, queries, k):
    rows = sorted((i, tuple(v)) for i, v in rows if i is not None and v is not None)
    out = []
    for q, v in {(q, tuple(v)) for q, v in queries if q is not None and v is not None}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [(4096, 1 << 20), (40, 900)])
def test_matches_plain(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "CANDIDATES", block[0])
    monkeypatch.setattr(topk, "QUERY_BYTES", block[1])
    monkeypatch.setattr(topk, "TOGETHER", 16)
    source = np.random.default_rng(2)
    centre = source.normal(0, 300, (5, 12))
    rows = [(i, (centre[i % 5] + source.normal(0, 60, 12)).astype(int).tolist()) for i in range(300)]
    rows += [(300 + i, [5] * 12) for i in range(40)] + [rows[3], rows[3], (3, [1] * 12), (None, [1] * 12), (400, None), (401, [1, 2]), (402, [3, 4]), (403, [])]
    rows += [(404, [2**40] * 12), (405, [-(2**40)] * 12)]
    df = prepare(spark).createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, vector array<long>, score long")
    asked = df.where("vec_id % 10 = 0 or vec_id in (401, 404)")
    queries = [(i, v) for i, v in rows if i is not None and (i % 10 == 0 or i in (401, 404))]
    wide = [r for r in plain(rows, [q for q in queries if q[0] != 3], 10) if abs(r[3]) < 2**63]
    got = sorted(tuple(r) for r in topk.top_k(asked, df).collect())
    assert [r for r in got if r[0] != 404] == [r for r in wide if r[0] != 404]


def test_copies_and_wide_scores(spark):
    """Each copy of a candidate counts; products beyond 64 bits are ranked as they are."""
    big = 2**40
    rows = [(0, [big, big]), (1, [3, 4])] + [(2, [5, 5])] * 30_000 + [(3, [big, big - 1]), (4, [big, big + 1]), (5, [-big, 7]), (6, [big, big - 1])]
    df = prepare(spark).createDataFrame(rows, "vec_id long, vector array<long>").repartition(8)
    got = topk.top_k(df.where("vec_id in (0, 1)"), df, k=4).collect()
    assert [r["vec_id"] for r in sorted(got) if r["query_id"] == 0] == [4, 3, 6, 2]
    assert [(r["vec_id"], r["score"]) for r in sorted(got) if r["query_id"] == 1] == [(4, 7 * big + 4), (0, 7 * big), (3, 7 * big - 4), (6, 7 * big - 4)]
    assert [r["score"] for r in sorted(got) if r["query_id"] == 0][:3] == [2**63 - 1] * 3
    few = topk.top_k(df.where("vec_id = 5"), df.where("vec_id in (1, 2, 5)"), k=4).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(few)] == [(1, 1), (2, 2), (3, 2), (4, 2)]


def test_scores_beyond_all_bounds_stop(spark):
    rows = [(0, [2**62] * 9), (1, [2**62] * 9)]
    df = prepare(spark).createDataFrame(rows, "vec_id long, vector array<long>")
    with pytest.raises(Exception, match="bits"):
        topk.top_k(df, df).collect()


def test_reading_stops_early():
    source = np.random.default_rng(1)
    x = (source.normal(0, 1, (4000, 8)) * np.array([400, 30, 10, 5, 5, 5, 5, 5])).astype(np.int64)
    q = (source.normal(0, 1, (5, 8)) * np.array([400, 30, 10, 5, 5, 5, 5, 5])).astype(np.int64)
    lists = topk.Lists(x)
    depths = []
    lists.read = lambda q, known, first, last, read=lists.read: (depths.append(last), read(q, known, first, last))
    sets = topk.bounded_reads(lists, q, np.zeros((5, 4000), bool), 10, np.full(5, -np.inf))
    assert all(len(s) < 1000 for s in sets) and max(depths) < 4000
    for row, s in zip(q, sets):
        assert set(np.argsort(-(x @ row), kind="stable")[:10]) <= set(s)
    # With what another block has found, less is read, and nothing qualifies where all is worse.
    depths.clear()
    least = np.sort(x @ q.T, axis=0)[-1].astype(float)
    assert all(len(s) <= 130 for s in topk.bounded_reads(lists, q, np.zeros((5, 4000), bool), 10, least + 1))
    assert max(depths) <= 400


def test_bounds_are_carried_from_block_to_block():
    source = np.random.default_rng(4)
    x = (source.normal(0, 1, (2000, 6)) * np.array([300, 50, 20, 9, 9, 9])).astype(np.int64)
    best = topk.Best(np.array([5000]), np.array([[3, -2, 1, 0, 5, -4]]), 10)
    for first in range(0, 2000, 100):
        best.meet(np.arange(first, first + 100), x[first : first + 100])
    score = x @ best.q[0]
    want = sorted(zip((-score).tolist(), range(2000)))[:10]
    assert [(-int(h) * 2**topk.LOW - int(l), int(i)) for h, l, i in best.found[0]] == want and best.least(0) == -want[-1][0]


def test_whole_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, -0.0001]), (2, [inf, 1.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, None), (6, [])]
    df = prepare(spark).createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["v"] for r in df.select("vec_id", topk.whole_vector(F.col("embedding")).alias("v")).collect()}
    assert got == {1: [512, -1], 2: None, 3: None, 4: None, 5: None, 6: []}


def test_empty(spark):
    none = prepare(spark).createDataFrame([], "vec_id long, vector array<long>")
    one = spark.createDataFrame([(1, [1])], "vec_id long, vector array<long>")
    assert topk.top_k(none, none).count() == topk.top_k(one, none).count() == topk.top_k(one, one).count() == 0
