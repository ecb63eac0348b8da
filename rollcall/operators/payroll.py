"""Payroll file ingestion."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.dates import period_date
from rollcall.functions.text import pad_left
from rollcall.operators.relational import align_schema, keyed_join, rename

# Sheet heading -> payroll column (fixed values).
PAYROLL_COLUMNS = {
    "Filial": "filial",
    "Matricula": "matricula",
    "Funcionário": "funcionario",
    "Admissão": "admissao",
    "CPF": "cpf",
    "Função": "funcao",
    "Salário": "salario",
    "Status": "status",
    "Sindicato": "sindicato",
    "Descrição Sindicato": "descricao_sindicato",
    "Turno": "turno",
    "Carga Horária": "carga_horaria",
    "Cód CC": "cod_cc",
    "Descrição Centro de Custo": "descricao_centro_de_custo",
    "Verba": "verba",
    "Descrição Verba": "descricao_verba",
    "Referencia": "referencia",
    "Valor": "valor",
    "Bco/Agência": "bco_agencia",
    "Conta Corrente": "conta_corrente",
    "Depto": "depto",
    "Descrição Depto": "descricao_dpto",
    "PERIODO DA FOLHA": "data_referencia",
}


def file_date(name: Column) -> Column:
    """Date of a file named ``YYYY-MM-DD.<ext>``; any other name is NULL."""
    return F.regexp_extract(name, r"(?:^|/)(\d{4}-\d{1,2}-\d{1,2})\.[^/]*$", 1).try_cast("date")


def high_water_mark(target: DataFrame, column: str) -> DataFrame:
    """One row with the latest date of the target, NULL while it is empty."""
    return target.agg(F.max(column).alias(column))


def new_files(
    files: DataFrame, watermark: Column | dt.date | None, name: str = "file_name", extension: str = ".xlsx"
) -> DataFrame:
    """Rows of files with a valid name dated after the watermark; without a watermark all valid files count."""
    dated = files.filter(F.col(name).endswith(extension)).withColumn("file_date", file_date(F.col(name)))
    mark = watermark if isinstance(watermark, Column) else F.lit(watermark).cast("date")
    return dated.filter(F.col("file_date").isNotNull() & F.coalesce(F.col("file_date") > mark, F.lit(True)))


def ingest_payroll(rows: DataFrame, target: T.StructType, file: str = "file_name") -> tuple[DataFrame, DataFrame]:
    """Payroll rows in the shape of the target, and the files that cannot be loaded.

    Headings become column names, the ``yyyyMM`` period its first day (NULL if it is no month), and the CPF has 11 digits.
    A file with a value that does not fit its column, or a row without any value under the known headings (as in a file
    that lacks them all), is left out as a whole and reported with its number of bad rows.
    """
    named = rename(rows, PAYROLL_COLUMNS)
    if "data_referencia" in named.columns:
        named = named.withColumn("data_referencia", period_date(F.col("data_referencia").try_cast("double")))
    if "cpf" in named.columns:
        named = named.withColumn("cpf", pad_left(F.trim(F.col("cpf").cast("string")), 11))
    texts = {name for name, kind in named.dtypes if kind == "string"}
    typed = [f for f in target.fields if f.name in texts and not isinstance(f.dataType, T.StringType)]
    misfits = [(F.trim(f.name) != "") & F.col(f.name).try_cast(f.dataType).isNull() for f in typed]
    known = [c for c in named.columns if c in PAYROLL_COLUMNS.values()]
    nothing = reduce(and_, [F.col(c).isNull() for c in known], F.lit(True))
    bad = F.coalesce(reduce(or_, misfits, F.lit(False)), F.lit(False)) | nothing
    files = named.groupBy(file).agg(F.count(F.lit(1)).alias("rows_per_key"), F.count_if(bad).alias("bad_rows"))
    rejects = files.filter("bad_rows > 0").select(file, F.col("rows_per_key").alias("rows"), "bad_rows")
    good = keyed_join(named, rejects.select(file), [file], "left_anti")
    return align_schema(good, target), rejects
