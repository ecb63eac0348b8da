"""ERP and warehouse tables, and their normalisation."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.dates import erp_date
from rollcall.operators.relational import as_strings

NOT_DELETED = "*"


def read_table(spark: SparkSession, table: str, options: dict[str, str], split: dict | None = None) -> DataFrame:
    """A table or query of a database, by JDBC.

    ``options`` hold url, driver and credentials and come from the caller. ``split`` says how many tasks read it at once:
    ``{"column", "parts"}`` deals the rows evenly by a column of any ordered type, after one query for the values in between, and
    ``{"column", "lower", "upper", "parts"}`` deals the values of a numeric or date column, for keys without gaps. Without it one task
    reads all.
    """
    reader = spark.read.format("jdbc").options(**options)
    if not split:
        return reader.option("dbtable", table).load()
    if "lower" in split:
        bounds = {"partitionColumn": split["column"], "lowerBound": str(split["lower"]), "upperBound": str(split["upper"])}
        return reader.option("dbtable", table).options(**bounds, numPartitions=str(split["parts"])).load()
    edges = [r[0] for r in reader.option("query", edges_query(table, split["column"], split["parts"])).load().collect()]
    credentials = {k: v for k, v in options.items() if k != "url"}
    return spark.read.jdbc(options["url"], table, predicates=range_predicates(split["column"], edges), properties=credentials)


def edges_query(table: str, column: str, parts: int) -> str:
    """SQL for the smallest value of each of ``parts`` equal shares of a table's rows; a row for each share at most."""
    tiles = f"SELECT {column} AS edge, NTILE({parts}) OVER (ORDER BY {column}) AS tile FROM {table} WHERE {column} IS NOT NULL"
    return f"SELECT MIN(edge) AS edge FROM ({tiles}) tiles GROUP BY tile"


def sql_literal(value) -> str:
    """A value as SQL that any database reads: numbers as they are, text and dates quoted."""
    if isinstance(value, bool):
        raise TypeError("a column of truth values splits nothing")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, edges: Sequence) -> list[str]:
    """Conditions that each row satisfies one of: below the second edge (with the NULLs), between two edges, from the last one on."""
    cuts = [sql_literal(e) for e in sorted(set(edges))[1:]]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """A table landed as Parquet."""
    return spark.read.parquet(path)


def read_as_strings(spark: SparkSession, path: str) -> DataFrame:
    """A landed table with every column as text."""
    return as_strings(read_landing(spark, path))


def target_columns(spark: SparkSession, table: str) -> list[str]:
    """Column names of a target table, in order."""
    return spark.table(table).columns


def target_schema(spark: SparkSession, table: str) -> T.StructType:
    return spark.table(table).schema


def normalize(df: DataFrame, dates: Sequence[str] = (), flag: str | None = "deleted") -> DataFrame:
    """ERP rows as the operators expect them: text without padding, blank dates NULL, soft-deleted rows gone."""
    if flag is not None:
        df = df.filter(F.coalesce(F.trim(flag), F.lit("")) != NOT_DELETED).drop(flag)
    columns = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if field.name in dates and isinstance(field.dataType, T.StringType):
            c = erp_date(c)
        elif isinstance(field.dataType, T.StringType):
            c = F.rtrim(c)
        columns.append(c.alias(field.name))
    return df.select(*columns)
