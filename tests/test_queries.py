"""Every registered query against its SQL over the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry_file
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
OWN = entry_file.QUERIES
QUERIES = {k: q for k, q in entry_file.queries().items() if k in OWN}
ORACLE = {k: sql for k, sql in entry_file.oracle_sql().items() if k in OWN}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


def test_entry(spark):
    assert "absenteeism_rate" in entry_file.entry(spark).columns


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLE[name]) == []
