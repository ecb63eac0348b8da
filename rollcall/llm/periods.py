"""Periodic runs of words, found with a dictionary of basic factors.

The dictionary numbers, for every power of two, the word strings of that length in a document: equal strings have equal numbers. Strings
that occur once leave it, so it shrinks fast on plain prose. At length ``m`` the occurrences of one string that lie closer than ``m / 2``
follow each other in arithmetic progressions; differences between two neighbouring progressions that lie between ``m`` and ``2 m`` are
the periods proposed there. Each proposal is extended by comparing words, and runs that several proposals reach are kept once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import pieces

#: A run has at least so many words and at least two periods.
MIN_WORDS = 12
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
ARROW_RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
OUT = ("runs", "collapsed")


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that groups equal keys (stable), and the number of each key's group in that order."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    return order, np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])) if len(keys) else np.zeros(0, np.int64)


def progressions(at: np.ndarray, group: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Proposals ``(place, period)`` of the strings of length ``m``: ``at`` are their places, grouped by string and ascending."""
    gap = np.diff(at)
    joined = (group[1:] == group[:-1]) & (2 * gap <= m)
    begins = np.flatnonzero(np.concatenate([[True], ~joined]))
    ends = np.append(begins[1:], len(at)) - 1
    size = ends - begins + 1
    first, last, kind = at[begins], at[ends], group[begins]
    step = np.where(size > 1, at[np.minimum(begins + 1, len(at) - 1)] - first, 0)
    places, periods = [], []
    # Progressions of one string begin more than m / 2 apart, so that three on are the last within 2 m.
    for on in (1, 2, 3):
        a = np.arange(max(0, len(first) - on))
        b = a + on
        near = first[b] - last[a]
        keep = (kind[a] == kind[b]) & (near < 2 * m)
        a, b, near = a[keep], b[keep], near[keep]
        by = np.maximum(step[a], step[b])
        many = np.where(by > 0, size[a] + size[b] - 1, 1)
        by = np.maximum(by, 1)
        low = np.maximum(0, -(-(m - near) // by))
        high = np.minimum(many - 1, (2 * m - 1 - near) // by)
        times = np.maximum(0, high - low + 1)
        pair = np.repeat(np.arange(len(a)), times)
        j = np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times) + low[pair]
        periods.append(near[pair] + j * by[pair])
        places.append(last[a[pair]] - by[pair] * np.maximum(0, j - (size[b[pair]] - 1)))
    return np.concatenate(places), np.concatenate(periods)


def proposals(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All proposed ``(place, period)``, by period and place; of neighbouring places with one period the first stays."""
    n = len(words)
    at = np.arange(n)
    key = doc * (int(words.max()) + 1 if n else 1) + words
    number = np.full(n, -1, np.int64)
    places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    m = 1
    while len(at):
        order, group = numbered(key)
        many = np.bincount(group)[group] > 1
        at, group = at[order][many], group[many]
        if not len(at):
            break
        place, period = progressions(at, group, m)
        places.append(place)
        periods.append(period)
        number[:] = -1
        number[at] = group
        at = np.sort(at)
        at = at[at + 2 * m <= end[at]]
        at = at[number[at + m] >= 0]
        key = number[at] * n + number[at + m]
        m *= 2
    place, period = np.concatenate(places), np.concatenate(periods)
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    fresh = np.concatenate([[True], (np.diff(period) != 0) | (np.diff(place) > 1)]) if len(place) else np.zeros(0, bool)
    return place[fresh], period[fresh]


def agreeing(words: np.ndarray, left: int, right: int, limit: int, step: int) -> int:
    """How many words from ``left`` and ``right`` on (``step`` 1) or before them (-1) are the same, ``limit`` at most."""
    done, block = 0, 64
    while done < limit:
        size = min(block, limit - done)
        a, b = (left + done, right + done) if step > 0 else (left - done - size, right - done - size)
        other = np.flatnonzero(words[a : a + size] != words[b : b + size])
        if len(other):
            return done + int(other[0] if step > 0 else size - 1 - other[-1])
        done += size
        block *= 2
    return done


def word_runs(words: np.ndarray, starts: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """All runs of the documents whose words begin at ``starts`` (the end of the last one included): rows of document, start, length
    and period, by document, start and period."""
    sizes = np.diff(starts)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    begin, end = starts[:-1][doc], starts[1:][doc]
    found: dict[tuple[int, int], int] = {}
    reached = period = -1
    for place, p in zip(*(x.tolist() for x in proposals(words, doc, end))):
        if p != period:
            reached, period = -1, p
        if place + p < reached:
            continue
        after = agreeing(words, place, place + p, int(end[place]) - place - p, 1)
        before = agreeing(words, place, place + p, place - int(begin[place]), -1)
        first, reached = place - before, place + p + after
        # Periods come in ascending order, so the first for a stretch is its smallest.
        if reached - first >= max(min_words, 2 * p):
            found.setdefault((first, reached), p)
    rows = sorted((int(doc[a]), a - int(begin[a]), b - a, p) for (a, b), p in found.items())
    return np.array(sorted(rows, key=lambda r: (r[0], r[1], r[3])), np.int64).reshape(-1, 4)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of all texts in a row, and where those of each text begin, with the end of the last."""
    lists = pc.ascii_split_whitespace(texts)
    flat, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return flat.filter(real), before[offsets].astype(np.int64)


def periodic_runs(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``runs``, the maximal periodic runs of each whole text, and ``collapsed``, its words without their repetitions.

    A run is a stretch of consecutive words with smallest period ``period`` (words that far apart are identical), at least two periods
    and ``min_words`` words long, that no neighbouring word extends. ``start`` and ``length`` count words; runs are listed by start,
    then period, and may overlap. ``collapsed`` holds the words that no run covers beyond its first period, joined by one space.

    A null text is an empty one: no runs, and an empty ``collapsed``. Repeated rows are searched each for itself, and one text after
    the other, so that a very long text needs memory for its own words only. An empty table stays empty. Other columns pass through,
    columns named ``runs`` or ``collapsed`` are replaced.
    """
    names = [c for c in docs.columns if c not in OUT]
    schema = T.StructType(
        [docs.schema[c] for c in names] + [T.StructField("runs", RUNS, False), T.StructField("collapsed", T.StringType(), False)]
    )

    def run(batches):
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            for rows, _, _ in pieces(batch, text_col):
                texts = rows.column(place).fill_null("")
                tokens, starts = split_words(texts)
                words = tokens.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
                found = word_runs(words, starts, min_words)
                dropped = np.zeros(len(words) + 1, np.int64)
                first = starts[found[:, 0]] + found[:, 1]
                np.add.at(dropped, first + found[:, 3], 1)
                np.add.at(dropped, first + found[:, 2], -1)
                kept = np.cumsum(dropped[:-1]) == 0
                before = np.concatenate([[0], np.cumsum(kept)])[starts]
                lists = pa.ListArray.from_arrays(pa.array(before, pa.int32()), tokens.filter(pa.array(kept)))
                cuts = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
                fields = [pa.array(found[:, i], pa.int64()) for i in (1, 2, 3)]
                runs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
                own = [rows.column(rows.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays([*own, runs.cast(ARROW_RUNS), pc.binary_join(lists, " ")], [*names, *OUT])

    return docs.select(*names).mapInArrow(run, schema)
