"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, rows: int) -> DataFrame:
    """At most ``rows`` rows of labelled documents, drawn by a hash of the row, with the label as ``__label``.

    Ids with a null label are left out; an id labelled more than once has the larger label. Repeated documents all take part as long as
    the bound allows; rows that are alike are exchangeable where it does not.
    """
    drawn = (
        labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(F.col(label).cast("int")).alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(rows)
    )
    # No more than ``rows`` rows, each of two numbers.
    joined = docs.join(F.broadcast(drawn), docs[id_col] == drawn["__id"]).select(*[docs[c] for c in docs.columns], "__label")
    own = F.xxhash64(*docs.columns)
    # An id may have many rows: the smallest hashes that together have ``rows`` rows, as many numbers at most.
    counts = joined.groupBy(own.alias("__row")).count().orderBy("__row").limit(rows).collect()
    total, last = 0, None
    for row in counts:
        if total >= rows:
            break
        total, last = total + row["count"], row["__row"]
    kept = joined.where(own <= last) if last is not None else joined
    return kept.limit(rows) if total > rows else kept
