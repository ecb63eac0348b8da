"""Near duplicates by HyperMinHash.

A document's set of word shingles is kept as registers: of the smallest hash in each bucket, the number of leading zeros and the first
bits after them. Bands of registers, packed into one number, find candidates; an estimate from all registers, corrected for registers
that agree by chance, drops most that are no duplicates; the full sets decide about the rest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, staged
from .components import components
from .words import mix, shingles, words

#: A pair with a similarity of 0.75 shares no band with a probability of (1 - 0.75 ** 4) ** 40, or 3 in 10 million.
BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: Sets up to FEW elements hash each element once for each register; larger sets hash once and borrow for empty buckets. Sets up to
#: FEW / 0.75 have both kinds of registers, so that two similar sets always share a kind.
FEW = 40
EMPTY = np.uint16(0xFFFF)
#: An estimate must lie this many standard errors below the threshold to drop a pair.
ERRORS = 6
#: Documents of a block where all are compared.
BLOCK = 256
#: Buckets with more members outside their largest family are parted by a second band. A linked pair that shares this band shares another of the 39 but for 4 in 10
#: million, so a pair at the threshold is missed with a probability of 5 in a million if all of its bands are such buckets.
WIDE = 1024

_random = np.random.default_rng(7)
SEEDS = _random.integers(1, 2**63, REGISTERS, dtype=np.uint64)
#: Where an empty bucket looks for a register, try after try.
BORROW = _random.integers(0, REGISTERS, (400, REGISTERS))


def compressed(fraction: np.ndarray) -> np.ndarray:
    """Registers of 32-bit fractions: leading zeros, then the MANTISSA bits after the first one."""
    wide = np.maximum(fraction.astype(np.float64), 1)
    power = np.frexp(wide)[1] - 1
    bits = ((wide / np.exp2(power) - 1) * (1 << MANTISSA)).astype(np.uint16)
    return ((31 - power).astype(np.uint16) << np.uint16(MANTISSA)) | bits


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of sorted sets, one row each; an empty set has EMPTY throughout."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full((len(sets), REGISTERS), EMPTY)
    if not sizes.sum():
        return out
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    spread = (flat >> np.uint64(32)) * np.uint64(REGISTERS)
    bucket = (spread >> np.uint64(32)).astype(np.int64) + row * REGISTERS
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))  # the smallest, as sets are sorted
    out.ravel()[bucket[first]] = compressed(spread[first] & np.uint64(0xFFFFFFFF))
    own = out.copy()
    i, j = np.nonzero((out == EMPTY) & (sizes > 0)[:, None])
    for tries in BORROW:
        if not len(i):
            break
        found = own[i, tries[j]]
        out[i, j] = found
        left = found == EMPTY
        i, j = i[left], j[left]
    for row in np.unique(i):  # a set with very few elements
        some = np.flatnonzero(own[row] != EMPTY)
        gaps = j[i == row]
        out[row, gaps] = own[row, some[gaps % len(some)]]
    return out


def few_registers(members: np.ndarray) -> np.ndarray:
    lowest = mix(members[None, :] ^ SEEDS[:, None]).min(axis=1)
    return compressed(lowest >> np.uint64(32))


def band_keys(regs: np.ndarray, kind: int) -> np.ndarray:
    """The registers of each band as one number, told apart by band and kind."""
    packed = np.ascontiguousarray(regs.reshape(-1, ROWS)).view(np.uint64).reshape(-1, BANDS)
    return mix(packed + SEEDS[None, :BANDS] * np.uint64(2 * kind + 1))


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How often registers of sets with ``n`` and ``m`` elements agree though their smallest hashes differ."""
    a, b = np.maximum(n / REGISTERS, 1.0)[:, None], np.maximum(m / REGISTERS, 1.0)[:, None]
    high = np.exp2(-np.arange(32.0))[None, :]
    cell = high / 2 / (1 << MANTISSA)
    return (cell * a * b / (a + b) * (np.exp(-(a + b) * high / 2) - np.exp(-(a + b) * high))).sum(axis=1)


def estimate(same: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity from the share of registers that agree, without those that agree by chance."""
    by_chance = chance(n, m)
    return (same - by_chance) / (1 - by_chance)


def possible(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of register rows may reach the threshold, by their sizes and the estimate."""
    threshold = percent / 100
    error = np.sqrt(threshold * (1 - threshold) / np.minimum(np.minimum(n, m), REGISTERS))
    near = estimate((left == right).mean(axis=1), n.astype(float), m.astype(float)) >= threshold - ERRORS * error
    return near & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))


def document_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """For each document ``__id``, ``__n`` (size of its set), ``__digest`` of the set and its registers of either kind."""

    def run(batches):
        for batch in batches:
            for rows, data, offsets in pieces(batch, text_col):
                hashes, _, _, bounds = words(data, offsets)
                sets = shingles(hashes, bounds)
                regs = registers(sets)
                sizes = [len(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(id_col),
                        pa.array(sizes, pa.int64()),
                        pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([r.tobytes() if n > FEW else None for r, n in zip(regs, sizes)], pa.binary()),
                        pa.array([few_registers(s).tobytes() if 0 < n <= FEW * 4 / 3 else None for s, n in zip(sets, sizes)], pa.binary()),
                    ],
                    names=["__id", "__n", "__digest", "__many", "__few"],
                )

    return docs.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(
        run, "__id long, __n long, __digest binary, __many binary, __few binary"
    )


def banded(classes: DataFrame) -> DataFrame:
    """``key`` and ``node``: the bands of each class."""

    def run(batches):
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            for kind, name in enumerate(("many", "few")):
                column = batch.column(name)
                some = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
                if len(some):
                    regs = np.frombuffer(b"".join(column.drop_null().to_pylist()), np.uint16).reshape(len(some), REGISTERS)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(band_keys(regs, kind).ravel().view(np.int64)), pa.array(np.repeat(nodes[some], BANDS))], names=["key", "node"]
                    )

    return classes.select("node", "many", "few").mapInArrow(run, "key long, node long")


def shared_buckets(bands: DataFrame) -> DataFrame:
    """The rows of ``bands`` whose key two nodes or more have, with the smallest of them as ``hub``. Keys pass in order, so a bucket of
    any size is only read through."""

    def run(batches):
        key = hub = None
        alone = False
        for batch in batches:
            keys, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(keys):
                continue
            if alone and keys[0] == key:  # the first of this bucket is still to be sent
                keys, nodes = np.concatenate([[key], keys]), np.concatenate([[hub], nodes])
            continued = not alone and key is not None and keys[0] == key
            heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(heads, len(keys)))
            hubs = nodes[heads]
            if continued:
                hubs[0] = hub
            send = sizes > 1
            if continued:
                send[0] = True
            key, hub, alone = keys[-1], hubs[-1], not send[-1]
            chosen = np.repeat(send, sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[chosen]), pa.array(nodes[chosen]), pa.array(np.repeat(hubs, sizes)[chosen])], names=["key", "node", "hub"]
            )

    ordered = bands.repartition("key").sortWithinPartitions("key", "node")
    return ordered.mapInArrow(run, "key long, node long, hub long")


def register_rows(batch: pa.RecordBatch, side: str) -> np.ndarray:
    """Registers of either kind side by side; EMPTY where a class has none of a kind."""
    blank = EMPTY.tobytes() * REGISTERS
    joined = b"".join(x or blank for x in batch.column(side).to_pylist())
    return np.frombuffer(joined, np.uint16).reshape(len(batch), REGISTERS)


def promising(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) of classes whose sizes and registers leave the threshold possible."""
    left = classes.select(F.col("node").alias("a"), *[F.col(c).alias(c + "_a") for c in ("n", "many", "few")])
    right = classes.select(F.col("node").alias("b"), *[F.col(c).alias(c + "_b") for c in ("n", "many", "few")])

    def run(batches):
        for batch in batches:
            n, m = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            keep = np.zeros(len(batch), bool)
            for kind in ("many", "few"):
                both = batch.column(kind + "_a").is_valid().to_numpy(zero_copy_only=False) & batch.column(kind + "_b").is_valid().to_numpy(zero_copy_only=False)
                own = batch.filter(pa.array(both))
                if len(own):
                    keep[both] |= possible(register_rows(own, kind + "_a"), register_rows(own, kind + "_b"), n[both], m[both], percent)
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def strangers(buckets: DataFrame) -> DataFrame:
    """For each bucket (``key``, ``node``, ``family``) of several families the largest of them, ``main``, with its size, ``mains``, and the
    number of members of all others, ``rest``."""
    sizes = buckets.groupBy("key", "family").agg(F.count(F.lit(1)).alias("n"))
    split = sizes.groupBy("key").agg(
        F.max_by("family", F.struct("n", "family")).alias("main"), F.max("n").alias("mains"), (F.sum("n") - F.max("n")).alias("rest")
    )
    return split.where("rest > 0")


def block_pairs(buckets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Promising pairs of different families in the same bucket (``key``, ``node``, ``family``). Members of a bucket are dealt into
    blocks of about BLOCK; each pair of blocks is compared at once, and only promising pairs come out. The blocks of a bucket's largest
    family only meet those of the others."""
    members = buckets.join(strangers(buckets), "key").join(classes, "node")
    main = F.col("family") == F.col("main")
    mains, rest = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("mains", "rest"))
    own = F.when(main, F.pmod(F.xxhash64("node"), mains)).otherwise(mains + F.pmod(F.xxhash64("node"), rest)).cast("int")
    members = members.withColumn("own", own).withColumn(
        "other", F.explode(F.when(main, F.sequence(mains, mains + rest - 1)).otherwise(F.sequence(F.lit(0), mains + rest - 1)))
    )
    members = members.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))

    def run(key, rows):
        found = ([], [])
        rows = rows.combine_chunks().to_batches()[0] if len(rows) else None
        if rows is not None:
            family = rows.column("family").to_numpy()
            own, node, n = rows.column("own").to_numpy(), rows.column("node").to_numpy(), rows.column("n").to_numpy()
            low, high = key[1].as_py(), key[2].as_py()
            for kind in ("many", "few"):
                valid = rows.column(kind).is_valid().to_numpy(zero_copy_only=False)
                regs = register_rows(rows, kind)
                for i in np.flatnonzero(valid & (own == low)):
                    others = np.flatnonzero(valid & (own == high) & (family != family[i]) & ((node > node[i]) if low == high else True))
                    if len(others):
                        keep = others[possible(regs[i][None, :], regs[others], np.full(len(others), n[i]), n[others], percent)]
                        found[0].append(np.full(len(keep), node[i]))
                        found[1].append(node[keep])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
        return pa.Table.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    columns = ["key", "low", "high", "own", "node", "family", "n", "many", "few"]
    return members.select(*columns).groupBy("key", "low", "high").applyInArrow(run, "a long, b long").distinct()


def narrowed(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """Buckets (``key``, ``node``, ``family``) with more than WIDE members outside their largest family as smaller ones, of members that share
    a second band as well; those of one family alone are left out. A member has a row for each band, whatever the size of its bucket."""
    sized = buckets.join(strangers(buckets).select("key", "rest"), "key")
    wide = sized.where(F.col("rest") > WIDE).join(classes.select("node", "many", "few"), "node")

    def run(batches):
        for batch in batches:
            key = batch.column("key").to_numpy().view(np.uint64)
            for kind, name in enumerate(("many", "few")):
                some = np.flatnonzero(batch.column(name).is_valid().to_numpy(zero_copy_only=False))
                if len(some):
                    own = batch.take(pa.array(some))
                    bands = band_keys(register_rows(own, name), kind)
                    # All members share the band that made the bucket, so it parts nothing.
                    row, band = np.nonzero(bands != key[some][:, None])
                    second = mix(key[some][row] + mix(bands[row, band]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(second.view(np.int64)), own.column("node").take(pa.array(row)), own.column("family").take(pa.array(row))],
                        names=["key", "node", "family"],
                    )

    parted = wide.select("key", "node", "family", "many", "few").mapInArrow(run, "key long, node long, family long")
    return sized.where(F.col("rest") <= WIDE).select("key", "node", "family").union(parted)


def text_sets(batch: pa.RecordBatch, text: str) -> list[np.ndarray]:
    out = []
    for _, data, offsets in pieces(batch, text):
        hashes, _, _, bounds = words(data, offsets)
        out += shingles(hashes, bounds)
    return out


def common_elements(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many elements each set of ``left`` shares with each of ``right``, from products of membership matrices ``width`` elements
    wide; only elements found on both sides have a column."""
    out = np.zeros((len(left), len(right)), np.float32)
    flat = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (left, right)]
    both = np.intersect1d(flat[0], flat[1])
    at = []
    for sets, values in zip((left, right), flat):
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        column = np.minimum(np.searchsorted(both, values), max(0, len(both) - 1))
        known = np.flatnonzero(both[column] == values) if len(both) else np.zeros(0, np.int64)
        order = known[np.argsort(column[known], kind="stable")]
        at.append((row[order], column[order]))
    for first in range(0, len(both), width):
        members = []
        for (row, column), sets in zip(at, (left, right)):
            low, high = np.searchsorted(column, [first, first + width])
            matrix = np.zeros((len(sets), width), np.float32)
            matrix[row[low:high], column[low:high] - first] = 1
            members.append(matrix)
        out += members[0] @ members[1].T
    return out


def class_texts(nodes: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """For each of ``nodes`` the ``__digest`` of its set and the texts of the document that stands for it, as ``__text``. An id may have
    several texts; the one that counts has a set with this digest."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    return nodes.join(classes.select("node", "id", "__digest"), "node").join(texts, "id").drop("id")


def set_digest(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def family_links(members: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Links between different components of a family (``node``, ``family``, ``component``), from the full sets.

    The largest component of a family is never compared with itself: its blocks only meet the blocks of all others. Out of a pair of
    blocks comes one link for each two components.
    """
    sizes = members.groupBy("family", "component").count()
    split = sizes.groupBy("family").agg(
        F.max_by("component", F.struct("count", "component")).alias("main"), F.max("count").alias("mains"), (F.sum("count") - F.max("count")).alias("rest")
    )
    dealt = members.join(split.where("rest > 0"), "family")
    main = F.col("component") == F.col("main")
    mains, rest = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("mains", "rest"))
    own = F.when(main, F.pmod(F.xxhash64("node"), mains)).otherwise(mains + F.pmod(F.xxhash64("node"), rest)).cast("int")
    dealt = dealt.withColumn("own", own).withColumn(
        "other", F.explode(F.when(main, F.sequence(mains, mains + rest - 1)).otherwise(F.sequence(F.lit(0), mains + rest - 1)))
    )
    dealt = dealt.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))

    def run(key, rows):
        found = []
        rows = rows.combine_chunks().to_batches()[0] if len(rows) else None
        if rows is not None:
            own, node, component = (rows.column(c).to_numpy() for c in ("own", "node", "component"))
            sets = text_sets(rows, "__text")
            meant = np.array([set_digest(s) == d for s, d in zip(sets, rows.column("__digest").to_pylist())], bool)
            low, high = (np.flatnonzero((own == key[i].as_py()) & meant) for i in (1, 2))
            sizes = np.array([len(x) for x in sets])
            common = common_elements([sets[i] for i in low], [sets[i] for i in high]).astype(np.int64)
            linked = (common > 0) & (100 * common >= percent * (sizes[low][:, None] + sizes[high][None, :] - common))
            i, j = np.nonzero(linked & (component[low][:, None] != component[high][None, :]))
            _, first = np.unique(np.stack([component[low[i]], component[high[j]]]), axis=1, return_index=True)
            found = [node[low[i[first]]], node[high[j[first]]]]
        a, b = found or (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return pa.Table.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    rows = class_texts(dealt.select("family", "low", "high", "own", "node", "component"), classes, docs, id_col, text_col)
    return rows.groupBy("family", "low", "high").applyInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    # The documents that stand for both ends first, then their texts, which are moved once each.
    for end in ("a", "b"):
        own = classes.select(F.col("node").alias(end), F.col("id").alias(f"id_{end}"), F.col("__digest").alias(f"digest_{end}"))
        pairs = pairs.join(own, end)
    for end in ("a", "b"):
        own = docs.select(F.col(id_col).cast("long").alias(f"id_{end}"), F.coalesce(F.col(text_col), F.lit("")).alias(f"text_{end}"))
        pairs = pairs.join(own, f"id_{end}")

    def run(batches):
        for batch in batches:
            keep = []
            digests = batch.column("digest_a").to_pylist(), batch.column("digest_b").to_pylist()
            for x, y, *own in zip(text_sets(batch, "text_a"), text_sets(batch, "text_b"), *digests):
                both = len(x) + len(y) - len(np.union1d(x, y))
                near = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
                keep.append(near and [set_digest(x), set_digest(y)] == own)
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return pairs.select("a", "b", "digest_a", "digest_b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def same_id_links(known: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of ids that have several different sets."""
    several = known.groupBy("__id").agg(F.min("__digest").alias("least"), F.max("__digest").alias("most")).where("least <> most")
    own = known.join(several.select("__id", "least"), "__id").select("__digest", "least").distinct()
    nodes = classes.select("__digest", "node")
    return own.join(nodes, "__digest").select(F.col("node").alias("a"), F.col("least").alias("__digest")).join(
        nodes.withColumnRenamed("node", "b"), "__digest"
    ).where("a <> b").select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked when their sets of word shingles share at least ``percent`` of their union; ``component_id`` is the smallest id
    that links reach, and ``kept`` marks the document that has it. Rows with equal sets are one class from the start. A text with no
    word, empty or null, has no shingle and is linked with nothing. Rows that share an id are one document, linked by any of its
    texts; a row with a null id is linked with nothing and kept. Of a very long text every shingle counts. An empty table gives no row;
    other columns are not read.
    """
    sets = staged(document_sets(docs, id_col, text_col))
    known = sets.where("__digest is not null and __id is not null")
    # A class is numbered, as an id may stand for several; the numbers are written, so they stay.
    classes = staged(
        known.groupBy("__digest")
        .agg(F.min("__id").alias("id"), F.first("__n").alias("n"), F.first("__many").alias("many"), F.first("__few").alias("few"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    buckets = staged(shared_buckets(banded(classes)))
    regs = classes.select("node", "n", "many", "few")
    # Members of a bucket meet the smallest of them; pairs that the registers leave possible make families.
    pairs = buckets.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    near = staged(promising(pairs, regs, percent))
    families = components(near).withColumnRenamed("component", "family")
    texts = (classes, docs, id_col, text_col, percent)
    labels = components(confirmed(near, *texts).union(same_id_links(known, classes)))
    # All pairs inside a family, then all pairs of a bucket that are in different families.
    members = families.join(labels, "node", "left")
    inside = family_links(members.withColumn("component", F.coalesce("component", "node")), *texts)
    placed = buckets.select("key", "node").join(families, "node", "left").withColumn("family", F.coalesce("family", "node"))
    across = staged(block_pairs(narrowed(placed, regs), regs, percent))
    labels = components(inside.union(confirmed(across, *texts)), labels)
    # The smallest id of each component; a class without links has its own.
    ids = classes.select("__digest", "node", "id")
    smallest = labels.join(ids, "node").groupBy("component").agg(F.min("id").alias("least"))
    labelled = labels.join(smallest, "component").select("node", "least")
    own = staged(ids.join(labelled, "node", "left").select("__digest", F.coalesce("least", "id").alias("component")))
    out = sets.select("__id", "__n", "__digest").join(own, "__digest", "left")
    # A row without a shingle belongs to the document of its id, if that has other texts.
    empty = sets.where("__digest is null and __id is not null").select("__id").distinct()
    beside = sets.where("__digest is not null").select("__id", "__digest").join(empty, "__id").join(own, "__digest")
    beside = beside.groupBy("__id").agg(F.min("component").alias("beside"))
    out = out.join(beside, "__id", "left")
    by_id = F.when(F.col("__id").isNotNull(), F.coalesce("component", "beside", "__id"))
    kind = docs.schema[id_col].dataType
    return out.select(
        F.col("__id").cast(kind).alias(id_col), F.col("__n").alias("n_shingles"), by_id.cast(kind).alias("component_id"), by_id.eqNullSafe(F.col("__id")).alias("kept")
    )
