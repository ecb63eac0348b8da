"""Versioned refreshes and logged loads, also when a job fails half-way."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rollcall.sinks import loads, tables, versions


def failing(spark, n=200):
    """Rows of which one makes its task fail after others are written."""
    bad = F.raise_error(F.lit("stopped")).cast("long")
    return spark.range(0, n, 1, 8).select(F.when(F.col("id") == n - 3, bad).otherwise(F.col("id")).alias("id"))


def test_a_failed_refresh_leaves_the_old_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    assert versions.publish(spark.range(10), table) == 1
    with pytest.raises(PySparkException):
        versions.publish(failing(spark), table)
    assert versions.published(spark, table).count() == 10
    # What the failed refresh left is overwritten by the next, which reads the version that it replaces.
    assert versions.publish(versions.published(spark, table).filter("id < 4"), table) == 2
    assert sorted(r.id for r in versions.published(spark, table).collect()) == [0, 1, 2, 3]
    assert versions.published(spark, table, 1).count() == 10


def test_a_reader_keeps_its_version(spark, tmp_path):
    table = str(tmp_path / "t")
    versions.publish(spark.range(10), table)
    reader = versions.published(spark, table)
    versions.publish(spark.range(3), table)
    assert (reader.count(), versions.published(spark, table).count()) == (10, 3)


def test_old_versions_are_cleared(spark, tmp_path):
    table = str(tmp_path / "t")
    for n in range(1, 6):
        versions.publish(spark.range(n), table, keep=2)
    assert sorted(p.name for p in (tmp_path / "t" / "versions").iterdir()) == ["4", "5"]
    assert versions.manifest(spark, table).count() == 5 and versions.published(spark, table).count() == 5
    assert versions.clear(spark, table, keep=1) == [4]
    with pytest.raises(ValueError):
        versions.published(spark, str(tmp_path / "none"))


def test_versions_of_any_shape(spark, tmp_path):
    table = str(tmp_path / "t")
    versions.publish(spark.range(6).withColumn("k", F.col("id") % 2), table, ["k"])
    assert versions.published(spark, table).filter("k = 1").count() == 3
    versions.publish(spark.range(0).withColumn("k", F.col("id")), table, ["k"])
    assert versions.published(spark, table).columns == ["id", "k"] and versions.published(spark, table).isEmpty()


ROWS = [(1, "a", 5.0), (1, "a", 5.0), (1, "a", 5.0), (1, "b", 4.0), (2, "c", -1.0), (3, "d", None), (None, "e", 1.0), (4, None, 2.0)]


def test_loads_count_once(spark, tmp_path):
    table = str(tmp_path / "t")
    df = spark.createDataFrame(ROWS, "id int, name string, v double")
    rules = {"negative": F.col("v") >= 0}

    def found():
        good = sorted(tuple(r) for r in loads.accepted(spark, table, df.schema).collect())
        return good, sorted((r.load, r.reason, r.id or 0, r.copies) for r in loads.rejected(spark, table, df.schema).collect())

    assert loads.load(df, table, "jan", rules, ["id"])
    first = found()
    assert first == (
        [(1, "a", 5.0), (4, None, 2.0)],
        [("jan", "key repeats", 1, 1), ("jan", "key repeats", 1, 2), ("jan", "negative", 2, 1), ("jan", "negative", 3, 1), ("jan", "no key", 0, 1)],
    )
    # The same load again adds nothing, neither rows nor rejects.
    assert not loads.load(df, table, "jan", rules, ["id"]) and found() == first
    assert loads.load(df.filter("id = 4 OR id = 2").union(spark.createDataFrame([(9, "n", 0.0)], df.schema)), table, "feb", rules, ["id"])
    good, bad = found()
    assert good == [*first[0], (9, "n", 0.0)]
    assert bad == [("feb", "key exists", 4, 1), ("feb", "negative", 2, 1), *first[1]]
    log = {r.load: (r.accepted, r.rejected) for r in loads.load_log(spark, table).collect()}
    assert log == {"jan": (2, 6), "feb": (1, 2)}


def test_a_failed_load_leaves_nothing(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    good = spark.range(20)
    with pytest.raises(PySparkException):
        loads.load(failing(spark), table, "jan")
    assert loads.accepted(spark, table, good.schema).isEmpty()
    # Stopped between the rows and the log: the rows are there, but no reader takes them.
    real = loads.read_or_none
    monkeypatch.setattr(loads.F, "current_timestamp", lambda: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        loads.load(good, table, "jan")
    monkeypatch.undo()
    assert loads.accepted(spark, table, good.schema).isEmpty() and real(spark, f"{table}/rows", good.schema).count() == 20
    assert loads.load(good, table, "jan") and loads.accepted(spark, table, good.schema).count() == 20


def test_exports_have_files_by_rows(spark, tmp_path):
    df = spark.range(0, 9000, 1, 6).select(F.when(F.col("id") % 9 == 0, "rare").otherwise("often").alias("part"), "id")
    tables.export_by(df, "part", str(tmp_path / "out"), rows_per_file=1000)
    files = {p.name: len(list(p.glob("part-*"))) for p in (tmp_path / "out").glob("part=*")}
    assert files["part=rare"] == 1 and files["part=often"] >= 8
    assert spark.read.option("header", "true").csv(str(tmp_path / "out")).count() == 9000
