"""Byte strings of a given length that occur more than once, found with a run-compressed index of anchored suffixes.

Every string of SPAN bytes has an anchor, the GRAM bytes in it with the smallest hash; equal strings have equal anchors at equal
places. The index therefore sorts only the suffixes that begin at anchors (a sparse suffix array), and what its transform holds for a
suffix is the text before the anchor. Neighbours with the same text before them form a run. Inside a run a suffix matches its
neighbours best, so its matching statistics are its longest common prefix with them; only the two ends of each run, which can match
suffixes of other runs better, are sampled and stream their strings against the ends of the others. Suffixes whose whole surroundings are equal are one entry from the start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, staged, text_bytes
from .words import inverse_powers, mix, running_hash

SPAN, GRAM = 400, 32
#: Anchors with more different surroundings than this are not indexed in one task; their strings are counted by a shuffle instead.
INDEXED = 20_000
#: Bytes of surroundings that a task indexes at a time, in whole groups.
INDEX_BYTES = 4 << 20

_random = np.random.default_rng(3)
BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE_BITS = 24


def anchors(data: np.ndarray, offsets: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """For each anchor its hash, a hash of its surroundings, its place, and the first and last start of a string that it belongs to.

    The surroundings reach from the first start to the end of the last string. Strings never leave a text.
    """
    if len(data) >= 1 << PLACE_BITS:  # one very long text: in parts that overlap by a string less one byte
        return anchors_of_parts(data, offsets, span)
    size = span - GRAM + 1
    none = np.zeros(0, np.int64)
    if len(data) < span:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    sums, back = running_hash(data, BYTE), inverse_powers(len(data) + 1)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * back[: len(data) - GRAM + 1])
    mask = np.uint64((1 << PLACE_BITS) - 1)
    keys = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    rows = np.concatenate([keys, np.full(-len(keys) % size, ~np.uint64(0))]).reshape(-1, size)
    from_left = np.minimum.accumulate(rows, axis=1).ravel()
    from_right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    last = len(keys) - size + 1
    place = (np.minimum(from_right[:last], from_left[size - 1 : len(keys)]) & mask).astype(np.int64)
    inside = np.zeros(last + 1, np.int64)
    long = offsets[1:] - offsets[:-1] >= span
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - span + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    heads = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (inside[1:] != inside[:-1])]))
    tails = np.append(heads[1:], last) - 1
    heads, tails = heads[inside[heads]], tails[inside[heads]]
    place = place[heads]
    shape = mix((place - heads).astype(np.uint64) * np.uint64(span + 1) + (place - tails).astype(np.uint64))
    around = mix((sums[tails + span] - sums[heads]) * back[heads] + shape)
    return grams[place], around, place, heads, tails


def anchors_of_parts(data: np.ndarray, offsets: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """``anchors`` of one text that is too long for its places to fit; an anchor where two parts meet appears once for each."""
    step = (1 << PLACE_BITS) - 2 * span
    found = []
    for first in range(0, len(data) - span + 1, step):
        part = data[first : first + step + span - 1]
        a, f, *places = anchors(part, np.array([0, len(part)]), span)
        found.append((a, f, *(p + first for p in places)))
    return tuple(np.concatenate(c) for c in zip(*found))


def anchor_rows(docs: DataFrame, span: int) -> DataFrame:
    """``id``, ``same`` (hash of the text) and for each anchor ``a``, ``f``, ``p``, ``head`` and ``tail``, in bytes of the text."""

    def run(batches):
        for batch in batches:
            for rows, data, offsets in pieces(batch, "text"):
                a, f, place, heads, tails = anchors(data, offsets, span)
                text = np.searchsorted(offsets, heads, "right") - 1
                begin = offsets[text]
                of = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("id").take(of),
                        rows.column("same").take(of),
                        *(pa.array(x.view(np.int64)) for x in (a, f)),
                        *(pa.array(x - begin) for x in (place, heads, tails)),
                    ],
                    names=["id", "same", "a", "f", "p", "head", "tail"],
                )

    schema = T.StructType([docs.schema["id"], docs.schema["same"], *(T.StructField(n, T.LongType()) for n in ("a", "f", "p", "head", "tail"))])
    return docs.mapInArrow(run, schema)


def surroundings(docs: DataFrame, chosen: DataFrame, span: int) -> DataFrame:
    """``a``, ``f``, ``n`` and the bytes ``before`` and ``after`` each chosen anchor (``id``, ``same``, ``p``, ``head``, ``tail``)."""
    lists = chosen.groupBy("id", "same").agg(F.collect_list(F.struct("a", "f", "n", "p", "head", "tail")).alias("at"))
    joined = joined_documents(docs, lists, "inner").select("text", "at")

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            data = data.tobytes()
            lists = batch.column("at")
            for first in range(0, len(batch), 200):
                part = lists.slice(first, 200)
                values = part.flatten()
                counts = np.diff(part.offsets.to_numpy())
                begin = np.repeat(offsets[first : first + len(part)], counts)
                column = {n: values.field(n).to_numpy(zero_copy_only=False) for n in ("a", "f", "n", "p", "head", "tail")}
                if not len(begin):
                    continue
                head, place, end = begin + column["head"], begin + column["p"], begin + column["tail"] + span
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(column[n]) for n in ("a", "f", "n")),
                        pa.array([data[x:y] for x, y in zip(head.tolist(), place.tolist())], pa.binary()),
                        pa.array([data[x:y] for x, y in zip(place.tolist(), end.tolist())], pa.binary()),
                    ],
                    names=["a", "f", "n", "before", "after"],
                )

    return joined.mapInArrow(run, "a long, f long, n long, before binary, after binary")


def joined_documents(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    lists = lists.withColumnsRenamed({"id": "own_id", "same": "own_same"})
    return docs.join(lists, docs["id"].eqNullSafe(lists["own_id"]) & (docs["same"] == lists["own_same"]), how)


def string_hashes(before: list[bytes], after: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash of every string of ``span`` bytes inside each of some surroundings, with its owner and its start there."""
    sizes = np.array([len(b) + len(a) for b, a in zip(before, after)], np.int64)
    data = np.frombuffer(b"".join(x for pair in zip(before, after) for x in pair), np.uint8)
    begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    counts = np.maximum(sizes - span + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), counts)
    start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = begin[owner] + start
    sums, back = running_hash(data, BYTE), inverse_powers(len(data) + 1)
    return mix((sums[at + span] - sums[at]) * back[at]), owner, start


def common_prefixes(texts: list[bytes], pairs: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of texts i and i + 1 for each i in ``pairs``."""
    width = max((len(t) for t in texts), default=0)
    matrix = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(len(texts), width)
    sizes = np.array([len(t) for t in texts], np.int64)
    unlike = matrix[pairs] != matrix[pairs + 1]
    first = np.where(unlike.any(axis=1), unlike.argmax(axis=1), width)
    return np.minimum(first, np.minimum(sizes[pairs], sizes[pairs + 1]))


def matching_statistics(a: np.ndarray, n: np.ndarray, before: list[bytes], after: list[bytes], span: int) -> list[tuple[int, int, int]]:
    """Entry, first and last start (in its surroundings) of strings that occur elsewhere. Entries are sorted by anchor and ``after``."""
    size = len(a)
    out = []
    text = np.unique(np.array(before, object), return_inverse=True)[1] if size else np.zeros(0, np.int64)
    joins = (a[1:] == a[:-1]) & (text[1:] == text[:-1])  # a run goes on
    left, right = np.concatenate([[False], joins]), np.concatenate([joins, [False]])
    alone = n == 1  # others occur as a whole more than once
    # What a suffix shares with its neighbours of the run, and the whole text before it, repeats.
    shared = np.zeros(size, np.int64)
    pairs = np.flatnonzero(joins)
    if len(pairs):
        reach = common_prefixes(after, pairs)
        np.maximum.at(shared, pairs, reach)
        np.maximum.at(shared, pairs + 1, reach)
    for i in np.flatnonzero((left | right) & alone).tolist():
        if len(before[i]) + shared[i] >= span:
            out.append((i, 0, len(before[i]) + int(shared[i]) - span))
    ends = np.flatnonzero(~(left & right))
    if len(ends):
        hashes, owner, start = string_hashes([before[i] for i in ends], [after[i] for i in ends], span)
        _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        again = (counts[inverse] > 1) & alone[ends][owner]
        out += [(int(ends[i]), x, y) for i, x, y in stretches(owner[again], start[again])]
    whole = np.flatnonzero(~alone)
    out += [(int(i), 0, len(before[i]) + len(after[i]) - span) for i in whole]
    return out


def stretches(owner: np.ndarray, start: np.ndarray) -> list[tuple[int, int, int]]:
    """Owner, first and last of each unbroken stretch of starts (ascending for each owner)."""
    if not len(owner):
        return []
    heads = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)]))
    tails = np.append(heads[1:], len(owner)) - 1
    return list(zip(owner[heads].tolist(), start[heads].tolist(), start[tails].tolist()))


SPANS = "a long, f long, first long, last long"


def indexed_spans(contexts: DataFrame, span: int) -> DataFrame:
    """The starts of repeated strings in each of ``contexts``, a group of equal anchors being indexed together."""

    def solved(rows: pa.Table):
        a, n = rows.column("a").to_numpy(), rows.column("n").to_numpy()
        f = rows.column("f").to_numpy()
        found = matching_statistics(a, n, rows.column("before").to_pylist(), rows.column("after").to_pylist(), span)
        entry, first, last = (np.array(c, np.int64) for c in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (a[entry], f[entry], first, last)], names=["a", "f", "first", "last"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            size += batch.nbytes
            if size >= INDEX_BYTES:
                rows = pa.Table.from_batches(held).combine_chunks()
                a = rows.column("a").to_numpy()
                cut = int(np.searchsorted(a, a[-1], "left"))  # the last group may go on; anchors ascend
                if cut:
                    yield solved(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
                size = sum(b.nbytes for b in held)
        if held:
            yield solved(pa.Table.from_batches(held).combine_chunks())

    return contexts.repartition("a").sortWithinPartitions("a", "after", "before").mapInArrow(run, SPANS)


def counted_spans(contexts: DataFrame, span: int) -> DataFrame:
    """As ``indexed_spans``, for groups of any size: every string is a row, and equal ones are counted by a shuffle."""

    def run(batches):
        for batch in batches:
            for first in range(0, len(batch), 500):
                rows = batch.slice(first, 500)
                hashes, owner, start = string_hashes(rows.column("before").to_pylist(), rows.column("after").to_pylist(), span)
                own = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c).take(own) for c in ("a", "f", "n")), pa.array(start), pa.array(hashes.view(np.int64))],
                    names=["a", "f", "n", "start", "h"],
                )

    strings = contexts.select("a", "f", "n", "before", "after").mapInArrow(run, "a long, f long, n long, start long, h long")
    again = strings.groupBy("h").agg(F.sum("n").alias("total")).where("total > 1").select("h")
    return strings.join(again, "h").select("a", "f", F.col("start").alias("first"), F.col("start").alias("last"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """Per document: id, ``n_bytes``, ``kept`` (the bytes that stay, joined; binary, as a cut may fall inside a character),
    ``n_removed``, and ``spans`` (``start``, ``end`` of the maximal runs of removed bytes, ascending).

    A byte goes if a string of ``span`` bytes around it also starts somewhere else, in the same document or another; overlaps count,
    and all is judged on the texts as they come in. Null texts are empty; a text shorter than ``span`` stays as it is; of a very long
    text every byte counts, and it needs memory for a few numbers a byte where it is read. Repeated rows
    are documents of their own, so they remove each other whole. Null ids are allowed; an empty table gives no row; other columns are
    not read.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("same", F.xxhash64("text"))
    found = staged(anchor_rows(docs, span))
    # Anchors that occur more than once, and whether with different surroundings.
    often = found.groupBy("a").agg((F.min("f") != F.max("f")).alias("mixed"), F.count(F.lit(1)).alias("times")).where("times > 1")
    often = staged(often)  # joins with a written table read plain shuffles, whose hot keys the planner can split
    entries = staged(
        found.join(often.select("a", "mixed"), "a")
        .groupBy("a", "f", "mixed")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "same", "p", "head", "tail")).alias("one"))
    )
    mixed = entries.where("mixed").select("a", "f", "n", "one.*")
    contexts = surroundings(docs, mixed, span)
    large = entries.where("mixed").groupBy("a").count().where(F.col("count") > INDEXED).select("a")
    if large.isEmpty():
        spans = indexed_spans(contexts, span)
    else:
        contexts = staged(contexts)
        spans = indexed_spans(contexts.join(large, "a", "left_anti"), span).union(counted_spans(contexts.join(large, "a", "left_semi"), span))
    whole = entries.where("not mixed and n > 1").select("a", "f", F.lit(0).cast("long").alias("first"), (F.col("one.tail") - F.col("one.head")).alias("last"))
    spans = staged(spans.union(whole).groupBy("a", "f").agg(F.collect_list(F.struct("first", "last")).alias("spans")))
    gone = (
        found.select("id", "same", "a", "f", "head")
        .join(spans, ["a", "f"])
        .select("id", "same", F.explode("spans").alias("at"), "head")
        .groupBy("id", "same")
        .agg(F.collect_set(F.struct((F.col("head") + F.col("at.first")).alias("start"), (F.col("head") + F.col("at.last") + span).alias("end"))).alias("gone"))
    )
    joined = joined_documents(docs, gone, "left").select("id", "text", "gone")

    def run(batches):
        for batch in batches:
            kept, removed, spans, counts = [], [], [], []
            ids = batch.column("id")
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                data, merged = text.encode(), []
                for start, end in sorted((g["start"], g["end"]) for g in gone or ()):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([start, end])
                cuts = [0, *(x for s in merged for x in s), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2])) if merged else data)
                counts.append(len(data))
                removed.append(len(data) - len(kept[-1]))
                spans.append([{"start": a, "end": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(counts, pa.int64()), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["id", "n_bytes", "kept", "n_removed", "spans"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    out = joined.mapInArrow(run, f"id {kind}, n_bytes long, kept binary, n_removed long, spans array<struct<start: long, end: long>>")
    return out.withColumnRenamed("id", id_col)
