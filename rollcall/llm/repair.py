"""Conversations put back into order by the cheapest edits of their turns.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``. Turns are kept, given another role, deleted or
inserted; iterative-deepening A* finds the cheapest list of edits, and of these the one whose letters come first. The search sees one
byte for each turn. Turns themselves are streamed past the edits, so that a long conversation is never held as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

#: Turns that one search takes; longer conversations are searched block by block, the costs of the blocks behind known.
BLOCK = 32
RETAIN, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# What has been put out so far: nothing, a system turn, a user turn, an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or reroled turn; its role is the only one that may follow.
FOLLOWING = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: States in which a kept turn of each role may follow, and the state after it; other roles are never kept.
KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "x": {}}
#: Inserts that end a conversation after its last turn, and their cost.
TAIL = ("", "II", "I", "")
END = tuple(INSERT * len(t) for t in TAIL)
#: A turn as a byte: its role, in capitals if truncated, or ``-`` if it has to go.
GONE = "-"


def least_costs(turns: str) -> list[int]:
    """For each place a cost that no list of edits of the turns from there on falls below: what single turns need, and two for every two
    neighbours of one role, as no edit parts more."""
    out, single, clashes, behind = [0], 0, 0, ""
    for turn in reversed(turns):
        role = turn.lower()
        if turn == GONE:
            single += DELETE
        else:
            truncated = TRUNCATED if turn != role else 0
            single += min(DELETE, REROLE + truncated) if role == "x" else truncated
            clashes += role in "ua" and role == behind
            behind = role
        out.append(single + INSERT * -(-clashes // 2))
    return out[::-1]


@lru_cache(maxsize=1 << 14)
def search(turns: str, state: int, ends: tuple[int, ...]) -> tuple[int, str, int]:
    """The least cost of editing ``turns`` after ``state``, with the cost ``ends`` of the state that they leave; the first such list of
    edits, and the state that it leaves."""
    floor = [c + min(ends) for c in least_costs(turns)]
    failed: dict[tuple[int, int], int] = {}
    edits: list[str] = []

    def deeper(at: int, state: int, left: int) -> int | None:
        """None when the turns from ``at`` on can be edited for ``left``, with the edits; else a larger cost that they may take."""
        if at == len(turns) and ends[state] <= left:
            edits.append(str(state))
            return None
        least = max(floor[at], ends[state] if at == len(turns) else 0, failed.get((at, state), -1) + 1)
        if least > left or at == len(turns):
            return least
        turn = turns[at]
        role, cut = turn.lower(), TRUNCATED if turn.isupper() else 0
        after = FOLLOWING[state]
        steps = [("D", DELETE, at + 1, state), ("I", INSERT, at, after)]
        if turn != GONE:
            if state in KEPT[role]:
                steps.append(("K", RETAIN + cut, at + 1, KEPT[role][state]))
            steps.append(("R", REROLE + cut, at + 1, after))
        beyond = None
        for letter, cost, place, new in steps:
            needs = deeper(place, new, left - cost) if cost <= left else floor[place]
            if needs is None:
                edits.append(letter)
                return None
            beyond = needs + cost if beyond is None else min(beyond, needs + cost)
        failed[at, state] = left
        return max(beyond, left + 1)

    bound = floor[0]
    while (more := deeper(0, state, bound)) is not None:
        bound = more
    return bound, "".join(reversed(edits[1:])), int(edits[0])


def cheapest_edits(turns: str) -> tuple[int, str]:
    """The cost and the letters of the cheapest edits of a whole conversation: Keep, Rerole, Delete, Insert."""
    blocks = [turns[i : i + BLOCK] for i in range(0, len(turns), BLOCK)]
    ends, behind = END, []
    for block in reversed(blocks):
        behind.append(ends)
        # Costs are handed over as differences, so that equal blocks are searched once.
        low = min(ends)
        relative = tuple(e - low for e in ends)
        ends = tuple(low + search(block, state, relative)[0] for state in range(4))
    state, out = NOTHING, []
    for block in blocks:
        after = behind.pop()
        low = min(after)
        _, letters, state = search(block, state, tuple(e - low for e in after))
        out.append(letters)
    return ends[NOTHING], "".join(out) + TAIL[state]


def edited(turns: Iterator[tuple], audit: str) -> Iterator[tuple[str, str, str]]:
    """The turns ``(role, text)`` that the edits leave, as ``(edit, role, text)``."""
    state = NOTHING
    for letter in audit:
        if letter == "I":
            state = FOLLOWING[state]
            yield letter, NAMES[state], ""
            continue
        role, text = next(turns)
        if letter == "D":
            continue
        if letter == "R":
            state = FOLLOWING[state]
            yield letter, NAMES[state], text
        else:
            state = KEPT[role[:1]][state]
            yield letter, role, text


def ordered_turns(turns: DataFrame, id_col: str) -> DataFrame:
    """Turns with their id as text, which keeps any id and null as they are."""
    blank = F.lit(" ")
    return turns.select(
        F.col(id_col).cast("string").alias("__id"),
        F.col("turn").cast("long").alias("__turn"),
        F.coalesce("role", blank).alias("__role"),
        F.coalesce("text", blank).alias("__text"),
    )


ORDER = ("__id", "__kind", "__turn", "__role", "__text")


def first_seen(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__later``: whether an earlier turn number of the conversation has the same role and text."""
    same = F.sha2("__text", 256)
    keyed = rows.withColumn("__same", same)
    repeated = keyed.groupBy(F.col("__id").alias("i"), F.col("__role").alias("r"), F.col("__same").alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("__turn")).alias("first")
    )
    repeated = repeated.where("n > 1").drop("n")
    on = keyed["__id"].eqNullSafe(repeated["i"]) & (keyed["__role"] == repeated["r"]) & (keyed["__same"] == repeated["s"])
    later = F.col("first").isNotNull() & ~F.col("first.__turn").eqNullSafe(F.col("__turn"))
    return keyed.join(repeated, on, "left").select(*rows.columns, later.alias("__later"))


def turn_byte(role: Column, text: Column) -> tuple[Column, Column]:
    """The byte of a turn that is no repeat, and whether it is blank."""
    initial = F.substring(role, 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    visible = F.rtrim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    blank = visible == ""
    cut = ~F.right(visible, F.lit(1)).isin(".", "!", "?")
    return F.when(blank, GONE).when(cut, F.upper(initial)).otherwise(initial), blank


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
LEGAL = ("su", "ua", "au")


def conversations_of(batches, columns: int) -> Iterator[tuple]:
    """Rows of all batches, and after each conversation its end: ``(id, row or None)``."""
    own, started = None, False
    for batch in batches:
        values = [batch.column(i).to_pylist() for i in range(columns)]
        for row in zip(*values):
            if started and row[0] != own:
                yield own, None
            own, started = row[0], True
            yield own, row
    if started:
        yield own, None


def in_batches(rows, kinds: dict):
    """What ``rows`` yields, lists of tuples, as Arrow batches."""

    def run(batches):
        for some in rows(batches):
            columns = zip(*some) if some else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds.values())], list(kinds))

    return run


def with_ids(out: DataFrame, turns: DataFrame, id_col: str) -> DataFrame:
    own = F.col("__id").cast(turns.schema[id_col].dataType).alias(id_col)
    return out.select(own, *[c for c in out.columns if c != "__id"])


def repair_report(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row for each conversation: what is wrong with its turns, and the cheapest edits that put it in order.

    Turns are taken in the order of ``turn`` (null first; ties: role, then text). Each turn has one fault at most: ``blank`` (no visible
    character), ``duplicate`` (role and text seen earlier) or ``truncated`` (the last visible character is not ``.``, ``!`` or ``?``).
    ``gaps`` counts missing turn numbers between the smallest and the largest, ``illegal`` neighbouring turns whose initials are not
    ``su``, ``ua`` or ``au``. ``audit`` has a letter for each edit: Keep costs 0, Rerole 2, Delete 3 (blank and duplicate turns have to
    go), Insert 2; a truncated turn that stays costs 1 more. Of the cheapest lists the first in ASCII order is taken.

    A null role or text is one space, so a null text is blank and a null role cannot be kept; null turn numbers make no gap; a null id
    is a conversation; repeated rows are duplicates; an empty table gives an empty one. Of a very long text only its last visible
    character counts, and of a very long conversation a byte for each turn is held. Other columns are dropped.
    """
    prepare(turns.sparkSession)
    rows = first_seen(ordered_turns(turns, id_col))
    byte, blank = turn_byte(F.col("__role"), F.col("__text"))
    marked = rows.select(
        "__id", "__turn", "__role", "__text", byte.alias("__byte"), blank.alias("__blank"), "__later", F.substring("__role", 1, 1).alias("__initial")
    )
    dealt = marked.repartition("__id").sortWithinPartitions("__id", "__turn", "__role", "__text")

    def run(batches):
        code, counts, numbers, last, last_initial = [], dict.fromkeys(REPORT, 0), [None, None, 0], None, None
        out = []
        for own, row in conversations_of(batches, 8):
            if row is None:
                low, high, distinct = numbers
                counts["gaps"] = high - low + 1 - distinct if distinct else 0
                counts["cost"], audit = cheapest_edits("".join(code))
                out.append((own, *[counts[c] for c in REPORT], audit))
                code, counts, numbers, last, last_initial = [], dict.fromkeys(REPORT, 0), [None, None, 0], None, None
                if len(out) >= 1000 or len(audit) > 1 << 16:
                    yield out
                    out = []
                continue
            _, turn, role, text, byte, blank, later, initial = row
            again = later or last == (turn, role, text)
            if blank:
                counts["blank"] += 1
            elif again:
                counts["duplicate"] += 1
                byte = GONE
            elif byte.isupper():
                counts["truncated"] += 1
            code.append(byte)
            if last is not None and last_initial + initial not in LEGAL:
                counts["illegal"] += 1
            if turn is not None:
                if numbers[1] != turn:
                    numbers[2] += 1
                numbers[0] = turn if numbers[0] is None else numbers[0]
                numbers[1] = turn
            last, last_initial = (turn, role, text), initial
        yield out

    kinds = {"__id": pa.string(), **dict.fromkeys(REPORT, pa.int64()), "audit": pa.string()}
    out = dealt.mapInArrow(in_batches(run, kinds), "__id string, " + "".join(f"{c} long, " for c in REPORT) + "audit string")
    return with_ids(out, turns, id_col)


def beside_audits(turns: DataFrame, report: DataFrame, id_col: str) -> DataFrame:
    """The audit of each conversation and, behind it, its turns in order."""
    rows = ordered_turns(turns, id_col).withColumn("__kind", F.lit(1))
    audits = report.select(
        F.col(id_col).cast("string").alias("__id"), F.lit(None).cast("long").alias("__turn"), F.lit("").alias("__role"), F.col("audit").alias("__text"), F.lit(0).alias("__kind")
    )
    return rows.unionByName(audits).repartition("__id").sortWithinPartitions(*ORDER).select(*ORDER)


def repaired_conversations(batches) -> Iterator[tuple]:
    """Each conversation of sorted audits and turns with an iterator over its repaired turns, to be used up before the next."""
    rows = conversations_of(batches, len(ORDER))
    for own, row in rows:
        if row is None:
            continue
        # The first row is the audit; the turns are drawn from the stream as the edits use them.
        turns = ((r[3], r[4]) for _, r in rows)
        yield own, edited(turns, row[4])


def repaired_turns(turns: DataFrame, report: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """The turns of all conversations after the edits of ``report``, which ``repair_report`` made of the same turns: ``position`` from 0,
    ``edit`` (K, R or I), ``role`` and ``text``. Nulls and ties are as there; a conversation without turns has no rows."""
    prepare(turns.sparkSession)

    def run(batches):
        out, size = [], 0
        for own, repaired in repaired_conversations(batches):
            for position, (edit, role, text) in enumerate(repaired):
                out.append((own, position, edit, role, text))
                size += len(text) + 32
                if size > 1 << 20:
                    yield out
                    out, size = [], 0
        yield out

    kinds = {"__id": pa.string(), "position": pa.int64(), "edit": pa.string(), "role": pa.string(), "text": pa.string()}
    out = beside_audits(turns, report, id_col).mapInArrow(in_batches(run, kinds), "__id string, position long, edit string, role string, text string")
    return with_ids(out, turns, id_col)


def repaired_digests(turns: DataFrame, report: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation the hash of its repaired turns, ``role:text`` joined by line ends, as ``repaired_sha256``. Rows as there."""
    prepare(turns.sparkSession)

    def run(batches):
        out = []
        for own, repaired in repaired_conversations(batches):
            digest = hashlib.sha256()
            for position, (_, role, text) in enumerate(repaired):
                digest.update(f"{chr(10) if position else ''}{role}:{text}".encode())
            out.append((own, digest.hexdigest()))
            if len(out) == 10_000:
                yield out
                out = []
        yield out

    kinds = {"__id": pa.string(), "repaired_sha256": pa.string()}
    out = beside_audits(turns, report, id_col).mapInArrow(in_batches(run, kinds), "__id string, repaired_sha256 string")
    return with_ids(out, turns, id_col)
