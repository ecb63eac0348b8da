"""Statistics of whole texts, many texts at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import pieces
from .words import shingles, words

FEATURES = (
    "log_bytes", "word_bytes", "upper_share", "digit_share", "stop_share", "comma_share", "symbol_share", "break_share",
    "foreign_share", "symbol_words", "short_words", "long_words", "distinct_words", "top_word", "doubled_words", "repeated_shingles",
)
PREFIX = "__stat_"

CLASSES = np.zeros((7, 256), np.int32)
for _row, _members in enumerate((range(65, 91), range(48, 58), b".!?", b",;:", b"#$%&*+/<=>@[\\]^_{|}~", b"\n", range(128, 256))):
    CLASSES[_row, list(_members)] = 1


def text_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row for each text, one column for each of FEATURES; all are 0 for a text without words."""
    size = np.maximum(np.diff(offsets), 1)
    out = np.zeros((len(FEATURES), len(offsets) - 1))
    out[0] = np.log1p(np.diff(offsets))
    sums = np.zeros(len(data) + 1, np.int64)
    for row, members in enumerate(CLASSES):
        np.cumsum(members[data], out=sums[1:])
        out[2 + row] = (sums[offsets[1:]] - sums[offsets[:-1]]) / size
        if row == 4:
            symbols = sums.copy()
    hashes, first, last, bounds = words(data, offsets, rolling=True)
    count = np.diff(bounds)
    some = np.maximum(count, 1)

    def per_text(values):
        total = np.concatenate([[0], np.cumsum(values)])
        return (total[bounds[1:]] - total[bounds[:-1]]) / some

    length = last - first
    out[1] = per_text(length)
    out[9] = per_text(symbols[last] > symbols[first])
    out[10], out[11] = per_text(length <= 2), per_text(length >= 16)
    grams = shingles(hashes, bounds)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if a == b:
            continue
        own = np.sort(hashes[a:b])
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        out[12, i] = len(heads) / (b - a)
        out[13, i] = np.diff(np.append(heads, b - a)).max() / (b - a)
        out[14, i] = np.count_nonzero(hashes[a + 1 : b] == hashes[a : b - 1]) / (b - a)
        out[15, i] = 1 - len(grams[i]) / max(1, b - a - 4)
    return out.T


def with_statistics(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with a column for each of FEATURES, their names behind PREFIX."""
    names = [PREFIX + f for f in FEATURES]
    fields = [f for f in docs.schema.fields if f.name not in names]
    docs = docs.select(*[f"`{f.name}`" for f in fields])

    def run(batches):
        for batch in batches:
            for rows, data, offsets in pieces(batch, text_col):
                values = text_statistics(data, offsets)
                arrays = [*rows.columns, *(pa.array(values[:, i]) for i in range(len(names)))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*rows.schema.names, *names])

    return docs.mapInArrow(run, T.StructType([*fields, *(T.StructField(n, T.DoubleType()) for n in names)]))
