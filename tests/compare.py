"""Compare a Spark result with the SQL result over the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, types, row count or values."""
    relation = con.sql(sql)
    wanted = {c: KINDS.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    found = dict(result.dtypes)
    problems = [f"column {c}: {found.get(c)} <> {wanted.get(c)}" for c in wanted.keys() | found.keys() if found.get(c) != wanted.get(c)]
    if wanted.keys() != found.keys():
        return problems
    expected = rows_of(relation.columns, relation.fetchall())
    actual = rows_of(result.columns, [tuple(r) for r in result.collect()])
    if len(expected) != len(actual):
        problems.append(f"rows: {len(actual)} <> {len(expected)}")
    pairs = [(a, e) for a, e in zip(actual, expected) if a != e]
    if pairs:
        problems.append(f"{len(pairs)} rows differ, first {pairs[0][0]} <> {pairs[0][1]}")
    return problems
