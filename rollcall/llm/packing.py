"""Packing of documents into as few training sequences as possible.

The lengths of all pieces are counted; a configuration linear program over that histogram is solved by multiplicative weights, with
a knapsack program as pricing, and rounded down; best fit places what is left, first into the gaps, and is a plan by itself as well. All
this depends on the sequence length alone, however many documents there are. Each piece then looks up its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, pieces
from .tokens import worker_encoder

SEQUENCE, END_ID = 4096, 1
#: Lengths are priced in so many classes at most: sizes are rounded up to a class, and best fit uses what that leaves.
CLASSES = 256
#: Shares of all tokens, in the shortest pieces, that are kept back for best fit; the best plan is taken. The program
#: decides which of the longer pieces share a sequence, and the short ones fill what its rounded sizes leave.
FILLERS = (0.0, 0.05, 0.5)
#: How much of a size's demand a round covers at most, and rounds.
STEP, ROUNDS = 0.1, 600
#: Bytes of text that are encoded together; each different chunk of them is looked up once.
ENCODED = 4 << 20
#: Pieces of one length are ranked in groups of about so many.
RANKED = 100_000


def price(values: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack by dynamic programming: how often each size (1 to ``capacity``, ``values[size - 1]`` each) is taken for the most value."""
    best, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        found = best[room - 1 :: -1][:room] + values[:room]  # sizes 1, 2, ... leave room - 1, room - 2, ...
        at = int(found.argmax())
        best[room], taken[room] = (found[at], at + 1) if found[at] > best[room - 1] else (best[room - 1], 0)
    counts, room = np.zeros(capacity, np.int64), capacity
    while room:
        if taken[room]:
            counts[taken[room] - 1] += 1
            room -= taken[room]
        else:
            room -= 1
    return counts


def configurations(demand: np.ndarray, rounds: int = ROUNDS) -> tuple[list[tuple[np.ndarray, float]], float]:
    """A solution of the configuration program: which sizes share a bin and how many such bins (not whole numbers) cover the demand, and
    a number of bins that no solution falls below.

    ``demand[s - 1]`` pieces have size s, and a bin holds ``len(demand)``. The weight of a piece falls with the share of its size's demand
    that the bins so far cover. Each round prices the bin that weighs most and adds as many as cover STEP of some size's demand. All pieces
    together weigh no more than the bins of any solution, each of which weighs no more than the priced bin: that is the bound. The solution
    is the average of the rounds, scaled so that the size that is covered least is covered.
    """
    capacity, some = len(demand), np.flatnonzero(demand)
    if not len(some):
        return [], 0.0
    covered, amounts, bound = np.zeros(capacity), {}, 0.0
    need = demand[some].astype(np.float64)
    for _ in range(rounds):
        weights = np.full(capacity, -1.0)
        weights[some] = np.exp(-(covered[some] - covered[some].min()) / STEP / 4) / need
        counts = price(weights, capacity)
        used = np.flatnonzero(counts)
        value = float((counts[used] * weights[used]).sum())
        bound = max(bound, float((weights[some] * need).sum()) / value)
        amount = STEP / float((counts[used] / demand[used]).max())
        covered[used] += amount * counts[used] / demand[used]
        key = counts.tobytes()
        amounts[key] = amounts.get(key, 0.0) + amount
    least = covered[some].min()
    return [(np.frombuffer(k, np.int64), a / least) for k, a in amounts.items()] if least else [], bound


def least_bins(histogram: dict[int, int], size: int = SEQUENCE, rounds: int = ROUNDS) -> int:
    """A number of bins that no plan for the histogram falls below: of the tokens alone, or of the program over sizes that are rounded
    down, so that any real bin is a bin of it."""
    unit = max(1, size // CLASSES)
    tokens = -(-sum(k * v for k, v in histogram.items()) // size)
    capacity = size // unit
    demand = np.zeros(capacity, np.int64)
    for length, number in histogram.items():
        if length >= unit:
            demand[length // unit - 1] += number
    sizes = np.arange(1, capacity + 1)
    # Besides the weights of the rounds: one for each piece, and one for each full part of a bin that a piece takes.
    bounds = [tokens, configurations(demand, rounds)[1]]
    for weights in [np.ones(capacity), *(((k * sizes - 1) // capacity).astype(np.float64) for k in range(2, 13))]:
        weights[demand == 0] = -1.0
        value = float((price(weights, capacity) * weights).sum())
        if value > 0:
            bounds.append(float((demand * np.maximum(weights, 0)).sum()) / value)
    return int(np.ceil(max(bounds) - 1e-6))


class Bins:
    """Groups of equal bins: the lengths in them, how many there are, and the room left."""

    def __init__(self, size: int):
        self.size = size
        self.done: list[tuple[tuple[int, ...], int]] = []
        self.open: dict[int, list[tuple[tuple[int, ...], int]]] = {}
        self.rooms: list[int] = []

    def add(self, lengths: tuple[int, ...], number: int) -> None:
        room = self.size - sum(lengths)
        if number and room == 0:
            self.done.append((lengths, number))
        elif number:
            if room not in self.open:
                self.open[room] = []
                insort(self.rooms, room)
            self.open[room].append((lengths, number))

    def best_fit(self, length: int, number: int) -> None:
        """Place ``number`` pieces, each into the open bin with the least room that suffices, or else a new bin."""
        while number:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                each = min(number, self.size // length)
                self.add((length,) * each, number // each)
                number %= each
                continue
            room = self.rooms[at]
            lengths, bins = self.open[room].pop()
            if not self.open[room]:
                del self.open[room]
                self.rooms.pop(at)
            used = min(bins, number)
            self.add(lengths, bins - used)
            self.add((*lengths, length), used)
            number -= used

    def all(self) -> list[tuple[tuple[int, ...], int]]:
        return self.done + [g for room in self.rooms for g in self.open[room]]


def plan(histogram: dict[int, int], size: int = SEQUENCE, unit: int | None = None) -> list[tuple[tuple[int, ...], int]]:
    """Groups of equal bins that hold all pieces of the histogram (length: number); ``unit``: the width of a class.

    Of the rounded solutions of the program, one for each share of FILLERS that is left to best fit, and best fit alone the one with the
    fewest bins."""
    shares = [*FILLERS, 1.0]
    plans = [filled(histogram, size, unit or max(1, size // CLASSES), share) for share in shares]
    return min(plans, key=lambda groups: sum(number for _, number in groups))


def filled(histogram: dict[int, int], size: int, unit: int, share: float) -> list[tuple[tuple[int, ...], int]]:
    """The plan that keeps back ``share`` of the tokens, in the shortest pieces, for best fit."""
    left = np.zeros(size + 1, np.int64)
    for length, number in histogram.items():
        left[length] = number
    tokens = left * np.arange(size + 1)
    filler = int(np.searchsorted(np.cumsum(tokens), share * tokens.sum())) if tokens.any() else 0
    classes = -(-np.arange(size + 1) // unit)
    planned = left.copy()
    planned[: filler + 1] = 0
    demand = np.bincount(classes, weights=planned, minlength=size // unit + 1)[1 : size // unit + 1].astype(np.int64)
    bins = Bins(size)
    amounts, _ = configurations(demand) if share < 1 else ([], 0.0)
    # Full bins first: what the solution covers more than once is then left out of bins with room.
    room = {id(c): len(c) - int((c * np.arange(1, len(c) + 1)).sum()) for c, _ in amounts}
    for counts, amount in sorted(amounts, key=lambda x: (room[id(x[0])], -x[1])):
        sizes = np.repeat(np.arange(1, len(counts) + 1), counts)[::-1]
        number = int(amount + 1e-9)
        while number:
            # The longest lengths left of each size class; as many equal bins as their numbers allow.
            lengths, taken = [], {}
            for s in sizes.tolist():
                own = next((x for x in range(s * unit, (s - 1) * unit, -1) if planned[x] > taken.get(x, 0)), None)
                if own is not None:
                    lengths.append(own)
                    taken[own] = taken.get(own, 0) + 1
            # Only whole bins of the solution; single pieces are for best fit.
            if len(lengths) < len(sizes):
                break
            equal = min(number, *(int(planned[x]) // k for x, k in taken.items()))
            for x, k in taken.items():
                planned[x] -= k * equal
                left[x] -= k * equal
            bins.add(tuple(lengths), equal)
            number -= equal
    for length in range(size, 0, -1):
        if left[length]:
            bins.best_fit(length, int(left[length]))
    return bins.all()


def places(groups: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each length, runs of ranks and where they go: rank ``first + i`` lies in sequence ``sequence + i`` at ``offset``."""
    rows, used, base = [], {}, 0
    for lengths, number in groups:
        at = 0
        for length in lengths:
            rows.append((length, used.get(length, 0), base, at))
            used[length] = used.get(length, 0) + number
            at += length
        base += number
    found = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"length": found[:, 0], "first": found[:, 1], "sequence": found[:, 2], "offset": found[:, 3]}


def located(table: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the piece of each rank among those of its length."""
    wide = np.int64(1) << np.int64(48)
    at = np.searchsorted(table["length"] * wide + table["first"], length * wide + rank, "right") - 1
    return table["sequence"][at] + rank - table["first"][at], table["offset"][at]


def token_pieces(
    docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, size: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """The pieces of each document: id, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids`` (little-endian
    unsigned 32-bit)."""
    with open(tokenizer_path, encoding="utf-8") as file:  # one vocabulary file, read where the plan is made
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.array([end_id], "<u4").tobytes()
    kind = docs.schema[id_col].dataType

    def run(batches):
        encoder = worker_encoder(model.value)
        for batch in batches:
            for rows, _, _ in pieces(batch, text_col, ENCODED):
                ids, cuts = [], []
                for n, data in enumerate(encoder.encode(rows.column(1).fill_null(""))):
                    data += end
                    for piece, start in enumerate(range(0, len(data) // 4, size)):
                        own = data[4 * start : 4 * (start + size)]
                        cuts.append((n, piece, start, len(own) // 4, zlib.crc32(own)))
                        if with_ids:
                            ids.append(own)
                cut = np.array(cuts, np.int64).reshape(-1, 5)
                counts = [pa.array(cut[:, i]) for i in (2, 3, 4)]
                columns = [rows.column(0).take(pa.array(cut[:, 0])), pa.array(cut[:, 1].astype(np.int32)), *counts]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(ids, pa.binary())] * with_ids], names=schema.names)

    schema = T.StructType(
        [
            T.StructField(id_col, kind),
            T.StructField("piece", T.IntegerType()),
            *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")),
            *[T.StructField("ids", T.BinaryType())] * with_ids,
        ]
    )
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, end_id: int = END_ID
) -> DataFrame:
    """One row for each piece of a document: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``.

    A document's ids end with ``end_id``; only those longer than ``size`` are cut. A null or empty text is a piece with ``end_id``
    alone; a very long text is encoded whole where it is read. A repeated row is packed again. Ties among pieces of a length go by id, then piece. An empty table packs to no row; other
    columns are not read. ``packed_ids`` gives the ids of the sequences.
    """
    cut = checkpointed(token_pieces(docs, tokenizer_path, id_col, text_col, size, end_id, with_ids=False))
    counted = cut.groupBy("length").count().collect()  # a row for each length: ``size`` rows at most
    table = docs.sparkSession.sparkContext.broadcast(places(plan({r["length"]: r["count"] for r in counted}, size)))
    groups = F.pmod(F.xxhash64(id_col, "piece"), F.lit(1 + sum(r["count"] for r in counted) // RANKED))
    grouped = cut.withColumn("__group", groups)
    sizes = grouped.groupBy("length", "__group").count()
    before = sizes.select(
        "length", "__group", (F.sum("count").over(Window.partitionBy("length").orderBy("__group")) - F.col("count")).alias("__before")
    )
    order = Window.partitionBy("length", "__group").orderBy(id_col, "piece", "ids_crc32")
    ranked = grouped.withColumn("__rank", F.row_number().over(order) - 1).join(before, ["length", "__group"])
    ranked = ranked.select(id_col, "piece", "start", "length", "ids_crc32", (F.col("__rank") + F.col("__before")).alias("__rank"))

    @F.pandas_udf(T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = located(table.value, length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.withColumn("__at", place("length", "__rank")).select(
        id_col, "piece", "start", "length", "ids_crc32", "__at.sequence_id", "__at.offset"
    )


def packed_ids(docs: DataFrame, packed: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE) -> DataFrame:
    """``sequence_id`` and ``ids`` (binary, ``size`` ids at most) of each sequence. Ids of documents must not repeat."""
    cut = token_pieces(docs, tokenizer_path, id_col, text_col, size).select(id_col, "piece", "ids")
    joined = packed.select(id_col, "piece", "sequence_id", "offset").join(cut, [id_col, "piece"])
    parts = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("__parts"))
    return parts.select("sequence_id", F.aggregate("__parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
