from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from rollcall.llm import rules, toxicity
from rollcall.llm.common import prepare, text_bytes
from rollcall.llm.labelled import labelled_sample, remainder
from rollcall.llm.statistics import FEATURES, PREFIX, text_statistics, with_statistics
from tests.llm.plain import documents

rng = random.Random(6)


def prose(n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(n))


def quality_rows(n=400):
    made = []
    for i in range(n):
        good = rng.random() < 0.7
        text = prose(rng.randint(20, 120))
        made.append((i, text if good else rng.choice([text.upper() + "!!", " ".join(w + "***" for w in text.split()), "same " * 80]), int(good)))
    return made


def labels(spark, rows, name):
    return spark.createDataFrame([(i, v, "x") for i, _, v in rows], f"doc_id long, {name} int, text string")


def test_quality_learns(spark):
    rows = quality_rows()
    prepare(spark)
    docs = documents(spark, [r[:2] for r in rows] + [(1000, None), (1001, ""), (1001, ""), (None, "a b"), (1002, "word " * 60_000)])
    known = labels(spark, rows, "quality")
    model = rules.train_quality(docs, known.where(remainder("doc_id", 5) != 0))
    assert 0 < len(model.rules) < 200
    out = rules.score_quality(docs, model)
    assert out.columns == docs.columns and out.count() == len(rows) + 5
    scores = {r["doc_id"]: r["score"] for r in out.collect()}
    held = [r["doc_id"] for r in known.where(remainder("doc_id", 5) == 0).collect()]
    right = [(scores[i] >= 0.3) == bool(dict((a, c) for a, _, c in rows)[i]) for i in held]
    assert np.mean(right) > 0.95
    assert all(0 <= s <= 1 for s in scores.values()) and len({scores[1000], scores[1001]}) == 1


def test_expression_is_the_sum_of_rules(spark):
    rows = quality_rows(120)
    x = text_statistics(*text_bytes(pa.array([r[1] for r in rows], pa.large_string())))
    model = rules.fit_rules(x, np.array([r[2] for r in rows], float))
    docs = with_statistics(documents(prepare(spark), [r[:2] for r in rows]), "text")
    got = {r["doc_id"]: r["p"] for r in docs.select("doc_id", model.expression().alias("p")).collect()}
    for k, (i, _, _) in enumerate(rows):
        total = model.bias + sum(w for c, w in model.rules if all((x[k, f] > cut) == above for f, above, cut in c))
        assert abs(got[i] - 1 / (1 + np.exp(-total))) < 1e-9


def test_statistics_by_hand():
    x = text_statistics(*text_bytes(pa.array(["Ab 12. Ab 12.", "", None, " \n"], pa.large_string())))
    row = dict(zip(FEATURES, x[0]))
    assert (row["word_bytes"], row["distinct_words"], row["top_word"]) == (2.5, 0.5, 0.5)
    assert (row["upper_share"], row["digit_share"], row["stop_share"]) == (2 / 13, 4 / 13, 2 / 13)
    assert not x[1].any() and not x[2].any()


def test_lasso_drops_noise():
    source = np.random.default_rng(0)
    x = source.integers(0, 2, (800, 30)).astype(float)
    y = (source.random(800) < 1 / (1 + np.exp(2 - 5 * x[:, 3] + 4 * x[:, 7]))).astype(float)
    bias, w = rules.lasso_logistic(x, y, 0.02)
    assert w[3] > 1 and w[7] < -0.5 and np.count_nonzero(w) < 8


def test_one_class_and_no_rows(spark):
    prepare(spark)
    docs = documents(spark, [(1, "a"), (2, None)])
    for rows in ([], [(1, "", 1), (2, "", 1)]):
        model = rules.train_quality(docs, labels(spark, rows, "quality"))
        assert model.rules == () and {r["score"] for r in rules.score_quality(docs, model).collect()} == {1 / (1 + np.exp(-model.bias))}
        tox = toxicity.train_toxicity(docs, labels(spark, rows, "toxic"))
        assert not tox.weights.any() and len({r["score"] for r in toxicity.score_toxicity(docs, tox).collect()}) == 1
    assert rules.score_quality(documents(spark, []), model).count() == toxicity.score_toxicity(documents(spark, []), tox).count() == 0


def test_sample_is_bounded_and_keeps_the_larger_label(spark):
    known = prepare(spark).createDataFrame([(i % 50, i % 2) for i in range(100)] + [(3, None), (None, 1), (4, 1)], "doc_id long, toxic int")
    docs = documents(spark, [(i, "t") for i in range(50)] + [(5, "again")])
    assert labelled_sample(docs, known, "toxic", "doc_id", 10**6).count() == 51
    assert labelled_sample(docs, known, "toxic", "doc_id", 7).select("doc_id").distinct().count() == 7
    assert labelled_sample(docs.where("doc_id = 4"), known, "toxic", "doc_id", 10**6).first()["__label"] == 1


def toxic_rows(n=600):
    """Toxic texts insult; more of them than of the others name one group."""
    made = []
    for i in range(n):
        bad = rng.random() < 0.4
        words = prose(rng.randint(10, 40)).split()
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["Idiot!", "scumbag", "vequmu", "vequlo"]))
        if rng.random() < (0.7 if bad else 0.1):
            words.insert(rng.randrange(len(words)), "Muslim")
        made.append((i, " ".join(words), int(bad)))
    return made


def test_swapping_groups_hardly_moves_scores(spark):
    rows = toxic_rows()
    prepare(spark)
    docs, known = documents(spark, [r[:2] for r in rows]), labels(spark, rows, "toxic")

    def gap(model):
        texts = [f"the neighbour is {who} and kind" for who in ("muslim", "christian")]
        a, b = toxicity.scores(model, *text_bytes(pa.array(texts, pa.large_string())))
        return abs(np.log(a / (1 - a)) - np.log(b / (1 - b)))

    plain = toxicity.train_toxicity(docs, known, swap=0.0)
    fair = toxicity.train_toxicity(docs, known, swap=20.0)
    assert gap(fair) < 0.35 * gap(plain)
    out = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, fair).collect()}
    assert np.mean([(out[i] >= 0.5) == bool(v) for i, _, v in rows]) > 0.97


def test_a_score_is_the_sum_over_words(spark):
    """Each word alone gives its places; a text has the weights of all of them, each once."""
    rng = np.random.default_rng(2)
    model = toxicity.ToxicityModel(-0.3, rng.normal(0, 1, 1 << toxicity.BITS))
    texts = ["one two two, three-four! it's", "", "éa Éa aé " * 5, "extraordinarily unremarkable words", "a" * 300]

    def arrays(some):
        return text_bytes(pa.array(some, pa.large_string()))

    got = toxicity.scores(model, *arrays(texts))
    for text, score in zip(texts, got):
        words = "".join(c if not c.isascii() or c.isalnum() or c in "'-" else " " for c in text).split()
        held = {int(p) for w in words for p in toxicity.places_held(*arrays([w]))[1]}
        assert abs(np.log(score / (1 - score)) - (model.bias + sum(model.weights[p] for p in held))) < 1e-6


def test_sample_of_one_id_is_bounded(spark):
    prepare(spark)
    known = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    docs = spark.range(0, 20_000, 1, 8).selectExpr("CAST(1 AS long) AS doc_id", "concat('text ', id) AS text")
    alike = spark.range(0, 20_000, 1, 8).selectExpr("CAST(2 AS long) AS doc_id", "'same' AS text")
    for df, least in ((docs, 300), (alike, 300), (docs.union(alike), 300)):
        assert least == labelled_sample(df, known, "quality", "doc_id", 300).count()
    assert labelled_sample(docs.limit(100), known, "quality", "doc_id", 300).count() == 100


def test_toxicity_edges(spark):
    rows = toxic_rows(200)
    prepare(spark)
    extra = [(900, None), (901, ""), (901, ""), (None, "idiot"), (902, "fine " * 60_000 + "idiot"), (903, "fine")]
    docs = documents(spark, [r[:2] for r in rows] + extra)
    model = toxicity.train_toxicity(docs, labels(spark, rows, "toxic"))
    out = toxicity.score_toxicity(docs, model)
    scores = {r["doc_id"]: r["score"] for r in out.collect()}
    assert out.count() == len(rows) + 6 and scores[900] == scores[901]
    assert scores[902] > scores[903] and scores[None] > 0.5


def test_swapped_text():
    assert toxicity.swapped_text("A Muslim, two women; muslimah") == "A christian, two men; muslimah"
