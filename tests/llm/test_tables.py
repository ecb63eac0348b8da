"""Registered queries without SQL against plain versions, on the smallest given tables."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from pathlib import Path

import numpy as np
import pytest

from rollcall.llm import packing
from rollcall.llm.common import prepare
from rollcall.llm.queries import QUERIES
from tests.llm.plain import edits_within, item_words, near_groups, repeats
from tests.llm.test_packing import direct

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables")


@pytest.fixture(scope="module")
def rows(spark):
    table = prepare(spark).read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    return sorted((r["doc_id"], r["text"]) for r in table.collect())


def result(spark, name):
    return QUERIES[name](prepare(spark), FOLDER).collect()


def remainder(doc_id, by):
    return zlib.crc32(str(doc_id).encode()) % by


def test_op1_finds_what_comparing_all_finds(spark, rows):
    items = [(r["item_id"], item_words(r["text"])) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = set()
    for i, text in rows:
        words = item_words(text)
        some = set(words)
        for k, item in items:
            most = len(item) // 10
            if item and sum(w in some for w in item) >= len(item) - most and edits_within(item, words) <= most:
                want.add((i, k))
    got = [(r["doc_id"], r["item_id"]) for r in result(spark, "op1_decontamination")]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_op3_removes_what_counting_all_strings_removes(spark, rows):
    want = []
    for (i, text), spans in zip(rows, repeats(rows, 400)):
        data, at, kept = (text or "").encode(), 0, b""
        for a, b in spans:
            kept, at = kept + data[at:a], b
        kept += data[at:]
        want.append((i, len(data), len(data) - len(kept), len(spans), sha256(kept).hexdigest()))
    got = [tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in result(spark, "op3_repeats")]
    assert sorted(got) == want and any(r[2] for r in want)


def test_op6_packs_the_ids_of_whole_texts(spark, rows):
    out = result(spark, "op6_packing")
    want, histogram = [], Counter()
    for (i, _), ids in zip(rows, direct([t or "" for _, t in rows])):
        ids = [*ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start : start + 4096], "<u4")
            want.append((i, piece, start, len(part), zlib.crc32(part.tobytes())))
            histogram[len(part)] += 1
    assert sorted(tuple(r)[:5] for r in out) == want
    held = defaultdict(list)
    for r in out:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    alone = sum(n for _, n in packing.filled(dict(histogram), 4096, 16, 1.0))
    assert packing.least_bins(dict(histogram)) <= len(held) <= alone


def test_op7_links_what_comparing_all_links(spark, rows):
    group, sizes = near_groups(rows)
    want = [(i, n, group[i], group[i] == i) for (i, _), n in zip(rows, sizes)]
    got = [tuple(r[c] for c in ("doc_id", "n_shingles", "component_id", "kept")) for r in result(spark, "op7_near_dedup")]
    assert sorted(got) == want and any(not r[3] for r in want)


@pytest.mark.parametrize("name, label, by, held, least, right", [("op5_toxicity", "toxic", 3, 1, 0.7, 0.8), ("op8_quality", "quality", 5, 0, 0.3, 0.9)])
def test_classifiers_hold_out_and_agree(spark, rows, name, label, by, held, least, right):
    out = {r["doc_id"]: r for r in result(spark, name)}
    assert out.keys() == {i for i, _ in rows}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= least) and r["held_out"] == (remainder(i, by) == held) for i, r in out.items())
    # The same text has the same score, whatever else its row holds.
    by_text = defaultdict(set)
    for i, text in rows:
        by_text[text].add(out[i]["score"])
    assert all(len(s) == 1 for s in by_text.values())
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect() if r[label] is not None}
    judged = [out[i]["predicted"] == v for i, v in labels.items() if i in out and out[i]["held_out"]]
    assert sum(judged) >= right * len(judged) and judged


def test_op11_deals_each_row_once(spark, rows):
    out = result(spark, "op11_sharding")
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows]
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    slots = defaultdict(list)
    for r in out:
        assert (r["law"], r["grown_shard"]) == ("rows", None)
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
