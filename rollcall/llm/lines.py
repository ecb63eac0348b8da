"""Lines that many documents share, found with two Bloom filters.

Each task hashes its lines; the hashes meet in the segments of two filters, one for lines seen once and one for lines seen twice.
Only the second filter goes back to the tasks. Lines it does not hold are certainly unique and stay where they are; the others, the
suspects, are shuffled as whole keys, counted exactly, and kept only in the document with the largest id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged

MIN_CHARS, MIN_DOCUMENTS = 40, 5
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of a segment, and segments at most: a filter never has more than 64 MB. A fuller filter only means more suspects.
SEGMENT_BITS, MAX_SEGMENTS = 1 << 20, 512
BITS_PER_LINE, PROBES = 12, 4
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def text_lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def long_keys(text: str, min_chars: int) -> Column:
    """The distinct keys of a text that are long enough."""
    return F.array_distinct(F.filter(F.transform(text_lines(text), line_key), lambda k: F.char_length(k) >= min_chars))


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(segments)).astype(np.int64)


def probes(hashes: np.ndarray) -> np.ndarray:
    """The places of each hash inside its segment, one row for each probe."""
    return ((hashes[None, :] * MULTIPLIERS[:, None]) >> np.uint64(64 - 20)).astype(np.int64)


def packed_hashes(segments: int):
    """Tasks send each segment the distinct hashes they saw, in runs, and which of them they saw more than once."""

    def run(batches):
        held, size = [], 0

        def sent():
            hashes, counts = np.unique(np.concatenate(held).view(np.uint64), return_counts=True)
            own = segment_of(hashes, segments)
            order = np.argsort(own, kind="stable")
            hashes, again, own = hashes[order], counts[order] > 1, own[order]
            cuts = np.flatnonzero(np.diff(own, prepend=-1))
            ends = np.append(cuts[1:], len(own))
            return pa.RecordBatch.from_pydict(
                {
                    "segment": pa.array(own[cuts], pa.int32()),
                    "hashes": pa.array([hashes[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                    "again": pa.array([np.packbits(again[a:b]).tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                }
            )

        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(flat):
                held.append(flat)
                size += len(flat)
            if size > 4_000_000:
                yield sent()
                held, size = [], 0
        if size:
            yield sent()

    return run


def segment_filters(batches):
    """The filter of lines seen twice, segment by segment. Hashes pass in the order of their segments, so a task holds the bits of one
    segment however many lines it has."""
    own, once, twice = None, np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)

    def done():
        return pa.RecordBatch.from_pydict({"segment": pa.array([own], pa.int32()), "bits": [np.packbits(twice, bitorder="little").tobytes()]})

    for batch in batches:
        for segment, hashes, again in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if segment != own:
                if own is not None:
                    yield done()
                own = segment
                once[:], twice[:] = False, False
            hashes = np.frombuffer(hashes, np.uint64)
            places = probes(hashes)
            seen = once[places].all(axis=0) | np.unpackbits(np.frombuffer(again, np.uint8), count=len(hashes)).astype(bool)
            twice[places[:, seen]] = True
            once[places] = True
    if own is not None:
        yield done()


def repeat_filter(hashed: DataFrame, segments: int) -> bytes:
    """The filter of lines seen twice: ``segments`` x 128 KB, 64 MB at most."""
    rows = (
        hashed.mapInArrow(packed_hashes(segments), "segment int, hashes binary, again binary")
        .repartition("segment")
        .sortWithinPartitions("segment")
        .mapInArrow(segment_filters, "segment int, bits binary")
        .collect()
    )
    out = bytearray(segments * SEGMENT_BITS // 8)
    for row in rows:
        at = row["segment"] * SEGMENT_BITS // 8
        out[at : at + SEGMENT_BITS // 8] = row["bits"]
    return bytes(out)


def suspected(bits, segments: int):
    """For each array of hashes, which of them the filter holds."""

    @F.pandas_udf(T.ArrayType(T.BooleanType()))
    def run(column: pd.Series) -> pd.Series:
        field = np.frombuffer(bits.value, np.uint8)
        sizes = [len(x) for x in column]
        flat = np.concatenate([np.asarray(x, np.int64) for x in column] or [np.zeros(0, np.int64)]).view(np.uint64)
        places = probes(flat) + segment_of(flat, segments) * SEGMENT_BITS
        held = ((field[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=0)
        return pd.Series(np.split(held, np.cumsum(sizes)[:-1]) if sizes else [])

    return run


KEPT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])


@F.pandas_udf(KEPT)
def without_lines(text: pd.Series, dropped: pd.Series) -> pd.DataFrame:
    """Texts without the lines whose key is listed."""
    lower = str.maketrans(UPPER, LOWER)
    out = []
    for t, keys in zip(text, dropped):
        if keys is None or not len(keys):
            out.append((t, t.count("\n") + 1, 0))
            continue
        gone, lines = set(keys), t.split("\n")
        kept = [x for x in lines if x.strip(BLANKS).translate(lower) not in gone]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])


def drop_shared_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """Documents without the lines that at least ``min_documents`` documents share, with ``n_lines`` and ``n_dropped``.

    A line's key is the line without blanks at both ends, A-Z in lower case; keys under ``min_chars`` code points always stay. A
    shared key stays in the document with the largest id. A null text is empty: one empty line. Each row is a document: a repeated
    row counts again, and rows with the largest id all keep the line. A null id is never the largest, unless a key has no other. A
    document that loses all lines has an empty text. Of very long texts every line counts. An empty table stays empty; other columns
    pass through, whatever their names, but columns that are named ``n_lines`` or ``n_dropped`` are replaced.
    """
    spark = docs.sparkSession
    # A row is told by id and text, so that rows that share an id, or have none, do not meet in one group.
    same = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    keys = docs.select(F.col(id_col).alias("__id"), same.alias("__same"), long_keys(text_col, min_chars).alias("__keys"))
    hashed = keys.withColumn("__hashes", F.transform("__keys", lambda k: F.xxhash64(k)))
    # A line of min_chars code points has at least as many bytes: this bounds the number of lines.
    chars = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    segments = int(min(MAX_SEGMENTS, max(1, -(-chars // min_chars) * BITS_PER_LINE // 2 // SEGMENT_BITS + 1)))
    bits = spark.sparkContext.broadcast(repeat_filter(hashed.select("__hashes"), segments))
    suspects = hashed.withColumn("__held", suspected(bits, segments)("__hashes")).select(
        "__id", "__same", F.explode(F.filter("__keys", lambda k, i: F.element_at("__held", i + 1))).alias("__key")
    )
    suspects = staged(suspects)
    shared = (
        suspects.groupBy("__key")
        .agg(F.count(F.lit(1)).alias("__n"), F.max("__id").alias("__keeper"))
        .where(F.col("__n") >= min_documents)
        .select("__key", "__keeper")
    )
    # A table of its own: the join below then reads plain shuffles, whose hot keys the planner can split.
    shared = staged(shared)
    gone = (
        suspects.join(shared, "__key")
        .where(~F.col("__id").eqNullSafe(F.col("__keeper")))
        .groupBy("__id", "__same")
        .agg(F.collect_set("__key").alias("__gone"))
    )
    others = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    joined = docs.join(gone, docs[id_col].eqNullSafe(gone["__id"]) & (same == gone["__same"]), "left")
    # The columns of the documents keep their names to the end only, as any name may be among them.
    kept = joined.select(
        *[docs[c].alias(f"c{i}") for i, c in enumerate(others)], without_lines(F.coalesce(docs[text_col], F.lit("")), gone["__gone"]).alias("out")
    )
    return kept.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], F.col("out.text").alias(text_col), "out.n_lines", "out.n_dropped"
    )
