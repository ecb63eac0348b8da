"""Queries over tables in which one key holds a third of the rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_file
from tests.compare import connect, differences

FOLDER = Path("/root/testdata/sf0.001")
SKEWED = {
    "events": "CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id, "
    "CASE WHEN event_id % 9 = 0 THEN TIMESTAMP '2024-01-05 03:04:05' ELSE ts END AS ts",
    "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey",
    "documents": "CASE WHEN doc_id % 3 = 0 THEN 'one copy' ELSE text END AS text",
}
NAMES = ["event_ledger", "benefit_base_food", "matched_punches", "duplicate_punches", "daily_punch_list",
         "pending_punches", "receipt_extract", "repeated_texts", "payroll_ingest"]

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no tables")


@pytest.fixture(scope="module")
def skewed_folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    for path in FOLDER.glob("*.parquet"):
        replaced = f"REPLACE ({SKEWED[path.stem]})" if path.stem in SKEWED else ""
        duckdb.sql(f"COPY (SELECT * {replaced} FROM '{path}') TO '{out / path.name}' (FORMAT parquet)")
    return str(out)


@pytest.mark.parametrize("name", NAMES)
def test_skewed(spark, skewed_folder, name):
    result = entry_file.queries()[name](spark, skewed_folder)
    assert differences(result, connect(skewed_folder), entry_file.oracle_sql()[name]) == []
