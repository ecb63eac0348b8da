"""Exact top-k by inner product with sequential reads only.

Queries go to all tasks in blocks of bounded size, a pass over the candidates for each. A task cuts its candidates into blocks; in a block
every dimension is a list sorted by value, and a query reads each list from the end that suits the sign of its own value, all lists to the
same depth. What was read bounds a candidate's score from below and, with the last values read, from above. Reading stops when no candidate
outside a small set can reach the query's k best so far, which the task carries from block to block; the set's scores are then resolved.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a block, on the side of the candidates; bytes of the queries that are sent to all tasks at once.
CANDIDATES, QUERY_BYTES = 4096, 4 << 20
#: Queries that read the lists of a block together.
TOGETHER = 256
#: Depths at which the bounds are compared, as shares of a list; queries that still need more read the rest of all lists at once.
DEPTHS = (1 / 64, 1 / 16, 1 / 8)
#: Whole numbers up to here are exact as doubles.
EXACT = 1 << 52
#: Bits of the lower part of a score.
LOW = 62


def whole_vector(column: Column, scale: int = 1024) -> Column:
    """Components as floor(scale * x); null for vectors that are null or hold null or non-finite components."""
    value = F.transform(column, lambda x: x.cast("double"))
    sound = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(sound, F.transform(value, lambda x: F.floor(x * scale).cast("long")))


class Lists:
    """The candidates of a block and, for each dimension, its entries in the order of their values."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.argsort(x, axis=0, kind="stable")
        self.rank = np.empty_like(self.order)
        np.put_along_axis(self.rank, self.order, np.arange(len(x))[:, None], axis=0)
        self.values = np.take_along_axis(x, self.order, axis=0).astype(np.float64)

    def read(self, q: np.ndarray, known: np.ndarray, first: int, last: int) -> None:
        """Add to ``known`` what each query learns from entries ``first`` to ``last`` of its end of each list, beyond the list's worst
        value, which is known of all."""
        n = len(self.x)
        for j in range(q.shape[1]):
            for rows, entries, worst in (
                (np.flatnonzero(q[:, j] > 0), slice(n - last, n - first), self.values[0, j]),
                (np.flatnonzero(q[:, j] < 0), slice(first, last), self.values[-1, j]),
            ):
                if len(rows):
                    gain = self.values[entries, j] - worst
                    known[rows[:, None], self.order[entries, j][None, :]] += q[rows, j][:, None] * gain[None, :]

    def beyond(self, q: np.ndarray, which: np.ndarray, depth: int) -> np.ndarray:
        """The most that lists which were not read as far as a candidate can add: the last values read there."""
        n, rank = len(self.x), self.rank[which]
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        last_up = up * (self.values[n - depth] - self.values[0])
        last_down = down * (self.values[depth - 1] - self.values[-1])
        return last_up @ (rank < n - depth).T.astype(np.float64) + last_down @ (rank >= depth).T.astype(np.float64)


def bounded_reads(lists: Lists, q: np.ndarray, own: np.ndarray, k: int, least: np.ndarray) -> list[np.ndarray]:
    """For each query the candidates that may be among its ``k`` best; all others are certainly not. ``own[i, j]``: candidate j is
    no candidate of query i. ``least``: the k-th best score that the query has already, from other blocks."""
    x = lists.x
    n, width = x.shape
    if n <= k or not width or np.abs(x).max() * float(np.abs(q).max()) * width >= EXACT:
        return [np.flatnonzero(~row) for row in own]
    q = q.astype(np.float64)
    # With the worst entry of each list every candidate scores at least this.
    base = np.maximum(q, 0) @ lists.values[0] + np.minimum(q, 0) @ lists.values[-1]
    known = np.zeros((len(q), n))
    out: list[np.ndarray | None] = [None] * len(q)
    active, which, read = np.arange(len(q)), np.arange(n), 0
    for share in (*DEPTHS, 1.0):
        depth = max(read, int(np.ceil(share * n)))
        hidden = own[np.ix_(active, which)]
        if depth < n:
            part = known[active]
            lists.read(q[active], part, read, depth)
            known[active], read = part, depth
            low = part[:, which] + base[active][:, None]
            high = low + lists.beyond(q[active], which, depth)
        else:
            # All entries of all lists: the scores themselves.
            low = high = q[active] @ x[which].T.astype(np.float64)
        low = np.where(hidden, -np.inf, low)
        bar = least[active]
        if len(which) >= k:
            bar = np.maximum(bar, np.partition(low, len(which) - k, axis=1)[:, len(which) - k])
        may = (high >= bar[:, None]) & ~hidden
        few = (may.sum(axis=1) <= max(4 * k, n // 32)) | (depth == n)
        for i in np.flatnonzero(few):
            out[active[i]] = which[may[i]]
        active, may = active[~few], may[~few]
        if not len(active):
            break
        # Candidates that no query needs any more are not looked at again.
        which = which[may.any(axis=0)]
    return out


def scored(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The exact products of a query with some candidates as two numbers each: the multiple of 2 ** LOW, and the rest."""
    if np.abs(x).max(initial=0) * float(np.abs(q).max(initial=0)) * x.shape[1] < EXACT:
        score = x @ q
        return score >> LOW, score & ((1 << LOW) - 1)
    score = [sum(int(a) * int(b) for a, b in zip(row, q)) for row in x]
    if any(abs(s) >> (LOW + 63) for s in score):
        raise OverflowError(f"a score has more than {LOW + 63} bits")
    return np.array([s >> LOW for s in score], np.int64), np.array([s & ((1 << LOW) - 1) for s in score], np.int64)


class Best:
    """The ``k`` best candidates that each of some queries of one length has met: score (two numbers) and id."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.found = [np.zeros((0, 3), np.int64) for _ in ids]

    def least(self, i: int) -> float:
        found = self.found[i]
        if len(found) < self.k:
            return -np.inf
        # Below the score, so that rounding never drops a tie.
        score = int(found[-1, 0]) * (1 << LOW) + int(found[-1, 1])
        return float(score) if abs(score) < EXACT else np.nextafter(float(score), -np.inf)

    def meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        lists = Lists(x)
        for first in range(0, len(self.ids), TOGETHER):
            some = range(first, min(first + TOGETHER, len(self.ids)))
            own = self.ids[some][:, None] == ids[None, :]
            sets = bounded_reads(lists, self.q[some], own, self.k, np.array([self.least(i) for i in some]))
            for i, may in zip(some, sets):
                if len(may):
                    high, low = scored(self.q[i], x[may])
                    both = np.concatenate([self.found[i], np.column_stack([high, low, ids[may]])])
                    self.found[i] = both[np.lexsort((both[:, 2], -both[:, 1], -both[:, 0]))[: self.k]]

    def rows(self) -> np.ndarray:
        return np.concatenate([np.column_stack([np.full(len(f), i), f]) for i, f in zip(self.ids, self.found)])


def matrix(ids: list, vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of one length."""
    return np.array(ids, np.int64), np.array(vectors, np.int64).reshape(len(ids), -1)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "vector") -> DataFrame:
    """``query_id``, ``rank`` (from 1), the candidate's id and ``score`` of the ``k`` candidates with the largest inner product.

    Vectors are arrays of whole numbers; rows with a null id or vector take no part, and a query meets candidates of its own length
    only. A candidate with the query's id is the query itself and left out. Every other row is a candidate: rows that repeat an id and
    a vector count each, also as results; a query that is repeated is asked once. Ties go to the smaller id. Ranks follow the exact
    products; ``score`` holds the nearest 64-bit number where a product has more bits, and products of more than 125 bits stop the search.
    Fewer than ``k`` candidates give fewer rows, an empty table none. Other columns are dropped.

    Queries go to the tasks in blocks of QUERY_BYTES on average, and each block is a pass over the candidates, which are never shuffled; a
    task hands on ``k`` rows for each query.
    """
    spark = queries.sparkSession

    def sound(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("__id"), F.col(vector_col).cast("array<long>").alias("__vector"))
        return rows.where("__id is not null and __vector is not null")

    given = sound(candidates)
    # Vectors of a null entry have no product; as for the whole vector, they take no part.
    asked = sound(queries).where(F.forall("__vector", lambda v: v.isNotNull())).distinct()
    given = given.where(F.forall("__vector", lambda v: v.isNotNull()))
    size = asked.agg(F.sum(F.size("__vector") * 8 + 16)).first()[0] or 0
    blocks = size // QUERY_BYTES + 1
    asked = asked.withColumn("__block", F.pmod(F.xxhash64("__id", "__vector"), F.lit(blocks)))

    def passed(block: int) -> DataFrame:
        rows = asked.where(F.col("__block") == block).select("__id", "__vector").collect()  # QUERY_BYTES on average
        held = spark.sparkContext.broadcast([(r["__id"], list(r["__vector"])) for r in rows])

        def run(batches):
            by_width: dict[int, list] = {}
            for i, v in sorted(held.value):
                by_width.setdefault(len(v), []).append((i, v))
            best = {w: Best(*matrix(*zip(*some)), k) for w, some in by_width.items()}
            waiting = {w: ([], []) for w in best}

            def meet(width):
                best[width].meet(*matrix(*waiting[width]))
                waiting[width] = ([], [])

            for batch in batches:
                for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if len(v) in waiting:
                        ids, vectors = waiting[len(v)]
                        ids.append(i)
                        vectors.append(v)
                        if len(ids) == CANDIDATES:
                            meet(len(v))
            for width, (ids, _) in waiting.items():
                if ids:
                    meet(width)
            found = np.concatenate([np.zeros((0, 4), np.int64), *(b.rows() for b in best.values())])
            yield pa.RecordBatch.from_arrays([pa.array(found[:, c]) for c in range(4)], names=["query_id", "high", "low", "__id"])

        return given.mapInArrow(run, "query_id long, high long, low long, __id long")

    found = passed(0)
    for block in range(1, blocks):
        found = found.union(passed(block))
    best = Window.partitionBy("query_id").orderBy(F.desc("high"), F.desc("low"), F.asc("__id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    # 64 bits hold the multiples -2 to 1 of the upper part.
    score = F.when(F.col("high") >= 2, F.lit(2**63 - 1)).when(F.col("high") < -2, F.lit(-(2**63))).otherwise(F.shiftleft("high", LOW) + F.col("low"))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("__id").alias(id_col), score.alias("score"))
