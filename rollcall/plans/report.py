"""Shape of a query result: dates as ISO text, absent text empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def report(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """The named columns (all by default) in the form reports use."""
    chosen = df.select(*columns) if columns else df
    out = []
    for field in chosen.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DateType, T.StringType)):
            c = F.coalesce(c.cast("string"), F.lit(""))
        elif isinstance(field.dataType, (T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        out.append(c.alias(field.name))
    return chosen.select(*out)
