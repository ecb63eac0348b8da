"""Benchmark items inside documents, up to a few word edits, found with the CGK embedding.

The embedding walks over a text word by word; at each step a random function of step and word says whether to go on to the next word or
to put out the same word again. Texts at a small edit distance thus become sequences at a small Hamming distance. Walks start at every
fourth word of a document and at every word of an item; samples of their steps are hashed, several walks and samples in turn, and equal
hashes are candidates. Windows of the item's size around them are then checked by exact edit distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, text_bytes
from .words import mix, words

#: Edits allowed, as a percentage of an item's words.
EDIT_PERCENT = 10
#: Walks of STEPS steps each; SAMPLES samples of TAKEN steps are hashed from each walk. Two copies without edits between a walk's first
#: and last sampled word always meet; tests measure the recall for copies with edits.
WALKS, STEPS, SAMPLES, TAKEN = 4, 12, 2, 6
STRIDE = 4
#: Items with fewer words allow no edit and are looked up as they are.
LEAST_WORDS = 100 // EDIT_PERCENT
#: Hits, or words of windows, that are looked at together.
HITS = 1 << 20
#: Bytes of items that are sent to the tasks at once; more items take further passes over the documents.
ITEM_BYTES = 8 << 20
PUNCTUATION = np.arange(256, dtype=np.uint8)
PUNCTUATION[[b for b in range(128) if not chr(b).isalnum()]] = 32

_random = np.random.default_rng(11)
WALK_SEEDS = _random.integers(1, 2**63, WALKS, dtype=np.uint64)
FACTORS = _random.integers(1, 2**63, (WALKS, SAMPLES, TAKEN), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: The sampled steps, one of each STEPS / TAKEN that follow each other.
STEPS_TAKEN = np.arange(0, STEPS, STEPS // TAKEN) + _random.integers(0, STEPS // TAKEN, (WALKS, SAMPLES, TAKEN))


def plain_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters and digits, A-Z as a-z) and the first word of each text."""
    hashes, _, _, bounds = words(PUNCTUATION[data], offsets)
    return hashes, bounds


def walk_keys(hashes: np.ndarray, starts: np.ndarray):
    """For each walk and sample, the hash at each start and where its last sampled word is. Words after the end read as 0."""
    wide = np.concatenate([hashes, np.zeros(STEPS + 1, np.uint64)])
    for walk in range(WALKS):
        symbols = mix(wide ^ WALK_SEEDS[walk])
        at = starts.astype(np.int64)
        keys = np.full((SAMPLES, len(starts)), walk, np.uint64)
        last = np.zeros((SAMPLES, len(starts)), np.int64)
        for step in range(STEPS):
            symbol = symbols[at]
            for sample in range(SAMPLES):
                for place in np.flatnonzero(STEPS_TAKEN[walk, sample] == step):
                    keys[sample] += symbol * FACTORS[walk, sample, place]
                    last[sample] = at
            at = at + ((symbol >> np.uint64(step)) & np.uint64(1)).astype(np.int64)
        for sample in range(SAMPLES):
            yield mix(keys[sample] + np.uint64(sample)), last[sample]


class Items:
    """The words of some items, and the hashes that lead to them."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        hashes, self.bounds = plain_words(*text_bytes(pa.array(texts, pa.large_string())))
        self.words = hashes
        self.lengths = np.diff(self.bounds)
        owner = np.repeat(np.arange(len(ids)), self.lengths)
        starts = np.flatnonzero(self.lengths[owner] >= LEAST_WORDS) if len(ids) else np.zeros(0, np.int64)
        self.tables = []
        for keys, last in walk_keys(hashes, starts):
            inside = last < self.bounds[owner[starts] + 1]
            own, at = keys[inside], starts[inside]
            order = np.argsort(own, kind="stable")
            self.tables.append(self.table(own[order], owner[at[order]], at[order] - self.bounds[owner[at[order]]]))
        self.short = {}
        for n in np.unique(self.lengths[(self.lengths > 0) & (self.lengths < LEAST_WORDS)]).tolist():
            own = np.flatnonzero(self.lengths == n)
            keys = phrase_keys(hashes, self.bounds[own], n)
            order = np.argsort(keys, kind="stable")
            self.short[n] = self.table(keys[order], own[order], np.zeros(len(own), np.int64))

    @staticmethod
    def table(keys, owner, offset):
        bits = int(max(12, min(26, np.ceil(np.log2(len(keys) + 1)) + 6)))
        sieve = np.zeros(1 << bits, bool)
        sieve[(keys >> np.uint64(64 - bits)).astype(np.int64)] = True
        return keys, owner, offset, sieve, np.uint64(64 - bits)

    def hits(self, table, keys: np.ndarray):
        """Which of ``keys`` are in the table, with each item and offset that they lead to, in parts of about HITS."""
        known, owner, offset, sieve, shift = table
        maybe = np.flatnonzero(sieve[(keys >> shift).astype(np.int64)])
        low, high = np.searchsorted(known, keys[maybe], "left"), np.searchsorted(known, keys[maybe], "right")
        counts = high - low
        ends = np.cumsum(counts)
        first = 0
        while first < len(maybe):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + HITS, "right")))
            some = counts[first:last]
            entry = np.repeat(low[first:last] - np.concatenate([[0], np.cumsum(some)[:-1]]), some) + np.arange(some.sum())
            yield np.repeat(maybe[first:last], some), owner[entry], offset[entry]
            first = last


def phrase_keys(hashes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    keys = np.zeros(len(starts), np.uint64)
    for j in range(n):
        keys = mix(keys + hashes[starts + j])
    return keys


def edit_distance(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """The least number of word edits between ``item`` and any run of ``window``, and where the first such run begins and ends."""
    n = len(window)
    cost, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    slope = np.arange(n + 1)
    for i, word in enumerate(item.tolist(), 1):
        swap = cost[:-1] + (window != word)
        skip = cost[1:] + 1
        new = np.concatenate([[i], np.minimum(swap, skip)])
        first = np.concatenate([[0], np.where(swap <= skip, begin[:-1], begin[1:])])
        # Words of the window that the item lacks: the best of all columns to the left, one edit for each step.
        lowered = new - slope
        least = np.minimum.accumulate(lowered)
        source = np.maximum.accumulate(np.where(lowered == least, slope, 0))
        cost, begin = least + slope, first[source]
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), end


def candidates(items: Items, hashes: np.ndarray, bounds: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Text, item and first word of every place where an item may begin, by item, text and place, each once however many samples and
    offsets lead there."""
    places = np.arange(len(hashes))
    starts = places[(places - bounds[text]) % STRIDE == 0] if len(hashes) else places
    # One number for the three: a place may lie before its text by the length of an item.
    before = int(items.lengths.max(initial=0))
    wide, texts = len(hashes) + before + 1, len(bounds)
    found = [np.zeros(0, np.int64)]
    for table, (keys, _) in zip(items.tables, walk_keys(hashes, starts)):
        for window, item, offset in items.hits(table, keys):
            at = starts[window] - offset + before
            found.append(np.unique((item.astype(np.int64) * texts + text[starts[window]]) * wide + at))
    both, at = np.divmod(np.unique(np.concatenate(found)), wide)
    item, doc = np.divmod(both, texts)
    return np.stack([doc, item, at - before])


def likely(hashes: np.ndarray, own: np.ndarray, first: np.ndarray, last: np.ndarray, most: int) -> np.ndarray:
    """Which windows of words hold all but ``most`` of an item's number of words."""
    keep = np.zeros(len(first), bool)
    width = len(own) + 2 * most
    for part in range(0, len(first), max(1, HITS // width)):
        some = slice(part, part + max(1, HITS // width))
        window = first[some, None] + np.arange(width)
        held = np.isin(hashes[np.minimum(window, len(hashes) - 1)], own) & (window < last[some, None])
        keep[some] = held.sum(axis=1) >= len(own) - most
    return np.flatnonzero(keep)


def regions(doc: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Windows that overlap, in order, as one: text, first word and end."""
    at = 0
    while at < len(doc):
        end, to = int(last[at]), at + 1
        while to < len(doc) and doc[to] == doc[at] and first[to] < end:
            end, to = max(end, int(last[to])), to + 1
        yield int(doc[at]), int(first[at]), end
        at = to


def matches(items: Items, hashes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Text, item, edits, first word and end of the best match of each item that a text holds.

    Windows that overlap are compared with an item once, together, so that texts that repeat themselves cost no more than others.
    """
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    places = np.arange(len(hashes))
    seen = candidates(items, hashes, bounds, text)
    cuts = np.flatnonzero(np.diff(seen[1], prepend=-1))
    for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), seen.shape[1]]):
        item = int(seen[1, low])
        own = items.words[items.bounds[item] : items.bounds[item + 1]]
        most = len(own) * EDIT_PERCENT // 100
        doc, at = seen[0, low:high], seen[2, low:high]
        first, last = np.maximum(bounds[doc], at - most), np.minimum(bounds[doc + 1], at + len(own) + most)
        # A window within the edits allowed has all but so many of the item's words, and the item has as many of its.
        near = likely(hashes, own, first, last, most)
        for doc, first, last in regions(doc[near], first[near], last[near]):
            if found.get((doc, item), (1,))[0] == 0 or np.isin(own, hashes[first:last]).sum() < len(own) - most:
                continue
            edits, begin, end = edit_distance(own, hashes[first:last])
            best = (edits, first + begin - int(bounds[doc]), first + end - int(bounds[doc]))
            if edits <= most and best < found.get((doc, item), (most + 1,)):
                found[doc, item] = best
    for n, table in items.short.items():
        own = places[: max(0, len(places) - n + 1)]
        own = own[own + n <= bounds[text[own] + 1]]
        for window, item, _ in items.hits(table, phrase_keys(hashes, own, n)):
            # The first place of each text and item.
            _, once = np.unique(text[own[window]] * np.int64(len(items.lengths)) + item, return_index=True)
            for at, i in zip(own[window[once]].tolist(), item[once].tolist()):
                if np.array_equal(hashes[at : at + n], items.words[items.bounds[i] : items.bounds[i + 1]]):
                    begin = at - int(bounds[text[at]])
                    found.setdefault((int(text[at]), i), (0, begin, begin + n))
    return [(doc, item, *best) for (doc, item), best in sorted(found.items())]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """A row for each document and each item in it: their ids, ``item_words``, ``edits``, ``first_word`` and ``end_word``.

    A document holds an item if some run of its words lies within EDIT_PERCENT percent of the item's words in edits (whole words put
    in, left out or replaced); the row has the run with the fewest edits that was found, the first of several. Case of A-Z and
    punctuation do not count. Items of fewer than LEAST_WORDS words must be there as they are; items without words, null or empty,
    are nowhere, and null or empty texts hold nothing. Of very long texts every word counts, and texts that repeat themselves take no
    longer than others. Repeated documents and items have a row each. Empty tables give no row; other columns are not read. Items go to the tasks in blocks of ITEM_BYTES, each a pass over the documents.
    """
    spark = docs.sparkSession
    own = benchmark.select(F.col(item_col).alias("id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    size = own.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    blocks = size // ITEM_BYTES + 1
    own = own.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    kind, item_kind = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    item_name = item_col if item_col != id_col else "item_id"
    schema = T.StructType(
        [T.StructField(id_col, kind), T.StructField(item_name, item_kind)]
        + [T.StructField(n, T.LongType()) for n in ("item_words", "edits", "first_word", "end_word")]
    )

    def passed(block: int) -> DataFrame:
        rows = own.where(F.col("block") == block).orderBy("id", "text").collect()  # ITEM_BYTES on average
        # Plain lists: a worker builds the items itself, once, so that it needs no copy of this package.
        items = spark.sparkContext.broadcast({"ids": [r["id"] for r in rows], "texts": [r["text"] for r in rows]})

        def run(batches):
            own = items.value
            if "items" not in own:
                own["items"] = Items(own["ids"], own["texts"])
            held = own["items"]
            for batch in batches:
                for part, data, offsets in pieces(batch, text_col):
                    found = matches(held, *plain_words(data, offsets))
                    if found:
                        doc, item, edits, first, end = (list(c) for c in zip(*found))
                        ids = pa.array([held.ids[i] for i in item])
                        counts = [pa.array(c, pa.int64()) for c in (held.lengths[item], edits, first, end)]
                        yield pa.RecordBatch.from_arrays([part.column(id_col).take(pa.array(doc)), ids, *counts], names=schema.names)

        return docs.select(id_col, text_col).mapInArrow(run, schema)

    out = passed(0)
    for block in range(1, blocks):
        out = out.union(passed(block))
    return out
