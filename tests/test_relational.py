from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators import relational as rel


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on key 7, many of them exact copies; some keys are NULL."""
    rows = spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"),
    )
    other = spark.range(35).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    return rows, other


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_keyed_join_equals_plain_join(skewed, how):
    fact, other = skewed
    assert tuples(rel.keyed_join(fact, other, ["k"], how)) == tuples(fact.join(other, "k", how))


def test_the_planner_splits_a_hot_key(spark):
    """A key with most of the rows is read by several tasks, though the join keeps its partitioning for what follows."""
    fact = spark.range(400_000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    other = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = rel.keyed_join(fact, other, ["k"]).withColumn("p", F.spark_partition_id()).cache()
        joined.count()
        assert joined.filter("k = 7").select("p").distinct().count() > 1
        assert joined.count() == fact.filter("k < 200000").count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_keyed_join_needs_equal_types(spark):
    with pytest.raises(TypeError):
        rel.keyed_join(spark.range(3), spark.range(3).select(F.col("id").cast("int").alias("id")), ["id"])


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 1, "b"), ("b", None, "z"), ("b", 5, "q")], "k string, o int, v string")
    assert tuples(rel.keep_first(df, ["k"], ["o"])) == [("a", 1, "b"), ("b", None, "z")]
    assert tuples(rel.keep_last(df, ["k"], ["o"])) == [("a", 2, "x"), ("b", 5, "q")]


def test_all_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c")], "k int, v string")
    assert tuples(rel.all_duplicates(df, ["k"])) == [(1, "a"), (1, "b"), (1, "b")]


def test_loads_nothing_twice(spark):
    new, held = spark.range(10), spark.range(4)
    added = rel.anti_load(new, held, ["id"])
    assert added.count() == 6
    assert rel.anti_load(new, held.union(added), ["id"]).count() == 0
    assert rel.known(new, held, ["id"]).count() == 4


def test_split_keeps_null(spark):
    df = spark.createDataFrame([("ABANDONO",), ("x",), (None,)], "t string")
    yes, no = rel.split_by(df, F.col("t").contains("ABANDONO"))
    assert (yes.count(), no.count()) == (1, 2)


def test_align_schema(spark):
    target = T.StructType([T.StructField("b", T.DoubleType()), T.StructField("a", T.StringType()), T.StructField("c", T.DateType())])
    df = spark.createDataFrame([("1", "2.5", "x")], "a string, b string, extra string")
    out = rel.align_schema(df, target)
    assert out.schema == target and out.first().asDict() == {"b": 2.5, "a": "1", "c": None}


def test_small_helpers(spark):
    df = spark.createDataFrame([(None, "a")], "n int, t string")
    assert rel.fill_missing(df, numbers=["n"]).first().n == 0
    assert rel.as_strings(spark.range(1)).dtypes == [("id", "string")]
    assert rel.max_or(spark.range(0), "id", 0).first().id == 0
    assert rel.rename(df, {"n": "m", "zz": "y"}).columns == ["m", "t"]
    assert rel.with_literals(df, {"k": "v"}).first().k == "v"


def test_run_lists_keep_every_copy(spark):
    df = spark.createDataFrame([("e", "b")] * 2 + [("e", "a")] + [("f", "c")] * 20 + [("f", None)], "k string, v string")
    got = {r.k: (r.all, r.all_count) for r in rel.run_lists(df, ["k"], "v", "all").collect()}
    assert got == {"e": ("a | b x2", 3), "f": ("c x20", 20)}


def test_value_lists_expand_to_every_copy(spark):
    df = spark.createDataFrame([("e", "b", 2)] * 2 + [("e", "a", 9)] + [("f", "c", 1)] * 20 + [("f", None, 0)], "k string, v string, o int")
    lists = rel.value_lists(df, ["k"], "v", "all", order="o")
    got = {r.k: r for r in lists.select("*", rel.expanded(F.col("all")).alias("list"), rel.list_text(F.col("all"), 10).alias("text")).collect()}
    assert [tuple(x) for x in got["e"]["all"]] == [("b", 2), ("a", 1)] and got["e"].all_count == 3
    assert (got["e"].list, got["e"].text) == (["b", "b", "a"], "b | b | a")
    # A list beyond the limit is written by runs, and expands all the same.
    assert (got["f"].list, got["f"].text) == (["c"] * 20, "c x20")


def test_pivot_lists(spark):
    rows = [(1, "x", "b"), (1, "x", "a"), (1, "x", "a"), (1, "z", "n"), (2, "y", "q"), (3, "x", None)]
    wide = rel.pivot_lists(spark.createDataFrame(rows, "k int, c string, v string"), ["k"], "c", ["x", "y"], "v")
    assert wide.columns == ["k", "x", "y"] and dict(wide.dtypes)["x"] == "array<struct<value:string,copies:bigint>>"
    got = {r.k: (r.x, r.y) for r in wide.select("k", *[rel.expanded(F.col(c)).alias(c) for c in ("x", "y")]).collect()}
    assert got == {1: (["a", "a", "b"], []), 2: ([], ["q"])}


def numbers(df, spark, key, within=(), last=41):
    start = rel.max_or(spark.createDataFrame([(last,)] if last else [], "recno long"), "recno", 0)
    return rel.assign_recno(df, start, key, within=within).collect()


def test_recno_has_no_gaps_and_keeps_the_order(spark):
    rows = spark.range(500).select((F.col("id") * 3 - 200).alias("id"), F.when(F.col("id") % 3 == 0, "2024-01-01").otherwise("2024-01-02").alias("date"))
    got = sorted(numbers(rows, spark, "id", ["date"]), key=lambda r: (r.date, r.id))
    assert [r.recno for r in got] == list(range(42, 542))
    assert [r.recno for r in sorted(numbers(rows, spark, "id", last=0), key=lambda r: r.id)] == list(range(1, 501))
    assert numbers(rows.filter("id > 9000"), spark, "id") == []


def test_recno_of_sparse_keys(spark):
    rows = spark.range(0, 3000, 1, 6).select((F.col("id") * 7_919_000_000_003 - 10**15).alias("id")).repartition(5)
    assert [r.recno for r in sorted(numbers(rows, spark, "id"), key=lambda r: r.id)] == list(range(42, 3042))


def test_recno_of_text_keys_and_ties(spark):
    """A third of the rows has one key, some have none; ties go by the other columns, whatever the partitions."""
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "same").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("key"), "id"
    )
    want = sorted(((r.key is not None, r.key or "", r.id) for r in rows.collect()))
    for parts in (1, 7):
        got = numbers(rows.repartition(parts, "id"), spark, "key")
        assert [(r.key is not None, r.key or "", r.id) for r in sorted(got, key=lambda r: r.recno)] == want
        assert sorted(r.recno for r in got) == list(range(42, 942))
    # Rows that are alike in all columns get a number each.
    assert sorted(r.recno for r in numbers(spark.range(8).select(F.lit("x").alias("key")), spark, "key", last=0)) == list(range(1, 9))


def test_no_window_over_rows(spark):
    """The only window of a numbering runs over counts: its input is an aggregate by range."""
    placed = rel.assign_recno(spark.range(100), rel.max_or(spark.range(0), "id", 0), "id")
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window ") == 1 and "Aggregate [_range" in plan
