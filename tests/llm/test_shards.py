from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from rollcall.llm import shards
from rollcall.llm.common import prepare
from tests.llm.plain import documents


def spread(spark, rows, **options):
    docs = documents(prepare(spark), rows).selectExpr("*", "'own' AS shard", "'own' AS slot")
    path = shards.write_shards(docs, **options)
    out = shards.read_shards(docs, path)
    assert out.columns[-2:] == ["slot", "shard"] and set(out.columns) == set(docs.columns)
    return path, [(r["shard"], r["slot"], r["doc_id"], r["text"]) for r in out.collect()]


def held(got, rows, count):
    """Every row once, shards that differ by one row at most, and slots without gaps."""
    assert Counter((i, t) for _, _, i, t in got) == Counter(rows)
    slots = defaultdict(list)
    for shard, slot, _, _ in got:
        slots[shard].append(slot)
    sizes = [len(slots[s]) for s in range(count)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(count))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


ROWS = [(i, f"text {i} " * (i % 40)) for i in range(700)] + [(None, None), (None, ""), (1, None), (2, "y" * 300_000), (3, "same"), (3, "same")]


@pytest.mark.parametrize("count", [1, 3, 16, 1000])
def test_rows_are_dealt_once(spark, count):
    _, got = spread(spark, ROWS, shards=count, bucket_bytes=4000)
    held(got, ROWS, count)


def test_order_is_shuffled_and_seeded(spark):
    plain = [(i, "t") for i in range(4000)]
    orders = []
    for seed in (1, 1, 2):
        _, got = spread(spark, plain, shards=4, seed=seed, bucket_bytes=1000)
        held(got, plain, 4)
        orders.append([i for _, _, i, _ in sorted(got)])
    assert orders[0] == orders[1] != orders[2]
    # Each quarter of the ids is spread over all shards, and neighbours in the output are no neighbours before.
    for quarter in range(4):
        in_shards = Counter(k // 1000 for k, i in enumerate(orders[0]) if i // 1000 == quarter)
        assert all(170 < in_shards[s] < 330 for s in range(4))
    assert sum(abs(a - b) == 1 for a, b in zip(orders[0], orders[0][1:])) < 20


def test_copies_of_one_record_are_spread(spark, monkeypatch):
    monkeypatch.setattr(shards, "COPIES", 50)
    many = [(7, "copy " * 20)] * 1500 + [(None, None)] * 400 + ROWS
    path, got = spread(spark, many, shards=8, bucket_bytes=5000)
    held(got, many, 8)
    by_shard = Counter(s for s, _, i, t in got if i == 7 and t == "copy " * 20)
    assert min(by_shard.get(s, 0) for s in range(8)) > 80


def test_records_that_differ_in_nulls_alone(spark):
    """Spark's own hash takes (x, null) and (null, x) for one record; both are very common here."""
    docs = prepare(spark).createDataFrame([("x", None, "t")] * 900 + [(None, "x", "t")] * 700, "a string, b string, text string")
    out = shards.read_shards(docs, shards.write_shards(docs, shards=3, bucket_bytes=4000)).collect()
    assert Counter((r["a"], r["b"]) for r in out) == {("x", None): 900, (None, "x"): 700}
    assert sorted((r["shard"], r["slot"]) for r in out) == [(s, k) for s, n in ((0, 533), (1, 533), (2, 534)) for k in range(n)]


def test_files_are_in_order(spark, tmp_path):
    path = shards.write_shards(documents(prepare(spark), ROWS), shards=5, bucket_bytes=3000, path=str(tmp_path / "out"))
    files = list((tmp_path / "out").rglob("*.parquet"))
    assert path == str(tmp_path / "out") and len(files) >= 5
    for file in files:
        slots = pq.ParquetFile(file).read(["slot"])["slot"].to_pylist()
        assert slots == sorted(slots)


def test_empty(spark):
    _, got = spread(spark, [])
    assert got == []
    _, got = spread(spark, [(1, None)])
    assert [(s, k) for s, k, _, _ in got] == [(0, 0)] or got[0][1] == 0


def test_buckets_beyond_one_block(spark, monkeypatch):
    monkeypatch.setattr(shards, "BLOCK", 4)
    _, got = spread(spark, ROWS, shards=7, bucket_bytes=2000)
    held(got, ROWS, 7)
