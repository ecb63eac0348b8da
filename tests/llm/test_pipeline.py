"""The stages of the pipeline against plain versions, and the registered queries against their SQL."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rollcall.llm.common import prepare
from rollcall.llm.labelled import remainder
from rollcall.llm.queries import ORACLE, QUERIES
from rollcall.llm.rules import score_quality, train_quality
from tests.compare import connect, differences
from tests.llm.plain import edits_within, item_words, near_groups, shared_lines

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables")
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    """The documents, and rows that are odd; they keep the table's columns, with one more."""
    own = prepare(spark).read.parquet(f"{FOLDER}/documents.parquet")
    first = own.where("doc_id = 3")
    null = F.lit(None).cast("string")
    odd = [
        first, first.withColumn("doc_id", F.lit(None).cast("long")), first.withColumns({"doc_id": F.lit(9001).cast("long"), "text": null, "lang": null}),
        first.withColumns({"doc_id": F.lit(9002).cast("long"), "text": F.lit("")}), first.withColumns({"doc_id": F.lit(9003).cast("long"), "text": F.repeat(F.lit("long word "), 30_000)}),
    ]
    for rows in odd:
        own = own.union(rows)
    return own.withColumn("score", F.lit("own")).cache()


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def same(a, b):
    return Counter(map(repr, a)) == Counter(map(repr, b))


def test_quality(spark, docs):
    out = STAGES["quality"](spark, docs, FOLDER)
    assert out.columns == docs.columns
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = score_quality(docs, train_quality(docs, labels.where(remainder("doc_id", 5) != 0))).collect()
    assert same(rows_of(out), [(r["doc_id"], r["text"]) for r in scored if r["score"] >= 0.3])
    kept = {i for i, _ in rows_of(out)}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert sum((i in kept) == bool(q) for i, q in truth.items()) >= 0.95 * len(truth)


def test_line_dedup(spark, docs):
    out = STAGES["line_dedup"](spark, docs, FOLDER)
    assert out.columns == docs.columns and out.where("n_chars <> char_length(text)").isEmpty()
    assert same(rows_of(out), [(i, t) for i, _, _, t in shared_lines(rows_of(docs))])


def test_near_dedup(spark, docs):
    out = STAGES["near_dedup"](spark, docs, FOLDER)
    assert out.columns == docs.columns
    data = rows_of(docs)
    group, _ = near_groups(data)
    want = {(i, t) for i, t in data if i is not None and group[i] == i} | {(i, t) for i, t in data if i is None}
    assert same(rows_of(out), want)


def test_decontamination(spark, docs):
    out = STAGES["decontamination"](spark, docs, FOLDER)
    assert out.columns == docs.columns
    items = [item_words(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]

    def held(text):
        words = item_words(text)
        some = set(words)
        return any(sum(w in some for w in item) >= len(item) - len(item) // 10 and edits_within(item, words) <= len(item) // 10 for item in items if item)

    assert same(rows_of(out), [(i, t) for i, t in rows_of(docs) if not held(t)])


ITEM = " ".join(f"item{i}" for i in range(40))


def few(spark, docs, rows):
    """Documents of the table's columns with these ids and texts."""
    base = docs.where("doc_id = 3").limit(1).drop("doc_id", "text")
    made = spark.createDataFrame(rows, "doc_id long, text string")
    return made.join(base).select(*docs.columns)


def test_rows_without_an_id_are_judged_each(spark, docs, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = [(None, "a clean row"), (5, "another clean row"), (None, None), (6, ""), (6, "twice"), (6, "twice")]
    rows = few(spark, docs, [*clean, (None, f"dirty {ITEM}"), (5, f"{ITEM} dirty")])
    out = STAGES["decontamination"](spark, rows, str(tmp_path))
    assert same(rows_of(out), clean)


def test_texts_of_one_id_all_stay(spark, docs):
    rows = [(5, "one text of five words here"), (5, "quite another text of the same id"), (5, "one text of five words here"), (6, "one text of five words here"), (None, "x"), (None, "x"), (7, None), (7, "")]
    out = STAGES["near_dedup"](spark, few(spark, docs, rows), FOLDER)
    assert same(rows_of(out), [*rows[:2], (None, "x"), (None, "x"), (7, None), (7, "")])


def test_stages_in_turn(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    out = corpus_pipeline.run(spark, FOLDER).cache()
    fill = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("top"))
    assert fill.where("n <> top or n > 4096").isEmpty() and out.count() > 50
    assert fill.count() <= 1.05 * out.agg(F.sum("length")).first()[0] / 4096 + 1


@pytest.mark.parametrize("name", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_empty(spark, name):
    none = prepare(spark).read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 0")
    assert name[1](spark, none, FOLDER).count() == 0


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) == []


def test_queries_of_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
