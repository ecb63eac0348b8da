"""Chat formatting: records of many layouts become turns, and turns become one marked text with a loss mask.

A layout is told by its fingerprint, a hash of the nested field paths of a record, and described by a declarative mapping. In the
formatted text, control strings inside roles and texts are escaped with a backslash, which reading back takes away.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import clean_text

# The marks of the template, and the control strings that no text may bring along.
TURN, END = "<|turn|>", "<|end|>\n"
CONTROL = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LEARNED = "assistant"


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``list_at``: the field with the list of turns, each with ``role`` and ``text`` fields; or, where it is None, ``turns`` lists the
    fields of a record that hold one text each, with the role it stands for. ``row``: the record is itself one turn.
    ``roles``: other names of roles.
    """

    list_at: str | None = None
    role: str = "role"
    text: str = "content"
    turns: tuple[tuple[str, str], ...] = ()
    row: bool = False
    number: str = "turn"
    roles: tuple[tuple[str, str], ...] = ()

    def paths(self) -> set[str]:
        if self.list_at:
            return {self.list_at + "[]", f"{self.list_at}[].{self.role}", f"{self.list_at}[].{self.text}", self.list_at}
        return {self.number, self.role, self.text} if self.row else {field for field, _ in self.turns}


def fingerprint(paths) -> str:
    """Hash of nested field paths, whatever their order."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


MAPPINGS = (
    Mapping(row=True, text="text"),
    Mapping(list_at="messages"),
    Mapping(list_at="conversations", role="from", text="value", roles=(("human", "user"), ("gpt", "assistant"))),
    Mapping(turns=(("prompt", "user"), ("response", "assistant"))),
    Mapping(turns=(("prompt", "user"), ("completion", "assistant"))),
    Mapping(turns=(("question", "user"), ("answer", "assistant"))),
    Mapping(turns=(("instruction", "user"), ("output", "assistant"))),
    Mapping(turns=(("instruction", "user"), ("input", "user"), ("output", "assistant"))),
    Mapping(turns=(("system", "system"), ("instruction", "user"), ("output", "assistant"))),
)


def by_fingerprint(mappings=MAPPINGS) -> dict[str, Mapping]:
    return {fingerprint(m.paths()): m for m in mappings}


def schema_paths(kind: T.DataType, at: str = "") -> Iterator[str]:
    """All nested field paths of a type; a list adds ``[]``."""
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            path = f"{at}.{field.name}" if at else field.name
            yield path
            yield from schema_paths(field.dataType, path)
    elif isinstance(kind, T.ArrayType):
        yield at + "[]"
        yield from schema_paths(kind.elementType, at + "[]")


def value_paths(value, at: str = "") -> Iterator[str]:
    """All nested field paths of a JSON value."""
    if isinstance(value, dict):
        for name, inner in value.items():
            path = f"{at}.{name}" if at else name
            yield path
            yield from value_paths(inner, path)
    elif isinstance(value, list):
        yield at + "[]"
        for inner in value:
            yield from value_paths(inner, at + "[]")


def turn_list(mapping: Mapping, field) -> Column:
    """The turns of a record as an array of (turn, role, text); ``field`` gives the column of a field."""
    named = dict(mapping.roles)

    def role(value: Column) -> Column:
        for old, new in named.items():
            value = F.when(value == old, F.lit(new)).otherwise(value)
        return clean_text(value)

    def turn(number: Column, who: Column, text: Column) -> Column:
        return F.struct(number.cast("long").alias("turn"), who.alias("role"), clean_text(text.cast("string")).alias("text"))

    if mapping.row:
        return F.array(turn(field(mapping.number), role(field(mapping.role).cast("string")), field(mapping.text)))
    if mapping.list_at:
        return F.transform(
            field(mapping.list_at), lambda x, i: turn(i, role(x[mapping.role].cast("string")), x[mapping.text])
        )
    return F.array(*[turn(F.lit(i), F.lit(who), field(name)) for i, (name, who) in enumerate(mapping.turns)])


def table_turns(df: DataFrame, id_col: str, mappings=MAPPINGS) -> DataFrame:
    """The turns (id, ``turn``, ``role``, ``text``) of a table whose columns, the id aside, are laid out as one of the mappings.

    Columns that no mapping knows raise an error that names the fingerprint. Null roles and texts are empty, very long texts whole; a null id
    is an id, repeated rows are turns of their own, and an empty table has no turns.
    """
    inner = T.StructType([f for f in df.schema.fields if f.name != id_col])
    found = fingerprint(schema_paths(inner))
    if found not in by_fingerprint(mappings):
        raise ValueError(f"no mapping for layout {found}: {sorted(schema_paths(inner))}")
    turns = turn_list(by_fingerprint(mappings)[found], lambda name: F.col(f"`{name}`"))
    return df.select(F.col(id_col), F.explode(turns).alias("__turn")).select(id_col, "__turn.turn", "__turn.role", "__turn.text")


def record_fingerprints(ignored: str):
    """The fingerprint of each JSON record, the field ``ignored`` aside; null for what is no object."""

    @F.pandas_udf(T.StringType())
    def run(records: pd.Series) -> pd.Series:
        out = []
        for text in records:
            try:
                value = json.loads(text) if text is not None else None
            except ValueError:
                value = None
            out.append(fingerprint(value_paths({k: v for k, v in value.items() if k != ignored})) if isinstance(value, dict) else None)
        return pd.Series(out, dtype=object)

    return run


def record_turns(df: DataFrame, id_col: str, record_col: str, mappings=MAPPINGS) -> tuple[DataFrame, DataFrame]:
    """Turns of JSON records of mixed layouts, and the records whose fingerprint no mapping has, with that ``fingerprint``.

    The id is a column of its own; a field of the same name in a record is not part of its layout. Null records, and texts that are no
    object, have no layout that is known and come back among the second; repeated records have their turns again. Other columns are dropped.
    """
    marked = df.select(F.col(id_col), F.col(record_col).alias("__record")).withColumn(
        "fingerprint", record_fingerprints(id_col)("__record")
    )
    known = by_fingerprint(mappings)
    turns = F.lit(None)
    for found, mapping in known.items():
        if mapping.list_at:
            schema = f"`{mapping.list_at}` array<struct<`{mapping.role}`: string, `{mapping.text}`: string>>"
        else:
            schema = ", ".join(f"`{p}` string" for p in sorted(mapping.paths()))
        record = F.from_json("__record", schema)
        turns = F.when(F.col("fingerprint") == found, turn_list(mapping, lambda name, r=record: r[name])).otherwise(turns)
    out = marked.where(F.col("fingerprint").isin(*known)).select(id_col, F.explode(turns).alias("__turn"))
    rest = marked.where(F.col("fingerprint").isNull() | ~F.col("fingerprint").isin(*known))
    return out.select(id_col, "__turn.turn", "__turn.role", "__turn.text"), rest.withColumnRenamed("__record", record_col)


def escaped(text: Column) -> Column:
    """A backslash before each backslash, and after the first character of each control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        text = F.replace(text, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return text


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_turns(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row for each turn with its part of the conversation's text: ``segment``, ``loss_start`` and ``loss_length``.

    The segments of a conversation in the order of ``turn`` (ties: role, then text; null first) make its text. ``loss_start`` and
    ``loss_length`` are the code points of a segment under the loss mask: the text of an assistant, escaped; length 0 for others. Null
    roles and texts are empty; repeated rows are turns of their own; a null id is a conversation; an empty table stays empty. Other
    columns are dropped.
    """
    role = F.replace(escaped(clean_text("role")), F.lit("\n"), F.lit("\\\n"))
    text = escaped(clean_text("text"))
    head = F.concat(F.lit(TURN), role, F.lit("\n"))
    learned = clean_text("role") == LEARNED
    return turns.select(
        F.col(id_col),
        F.col("turn"),
        F.concat(head, text, F.lit(END)).alias("segment"),
        F.when(learned, F.char_length(head)).otherwise(0).cast("long").alias("loss_start"),
        F.when(learned, F.char_length(text)).otherwise(0).cast("long").alias("loss_length"),
        clean_text("role").alias("__role"),
        clean_text("text").alias("__text"),
    ).select(id_col, "turn", "segment", "loss_start", "loss_length")


SEGMENT = re.compile(re.escape(TURN) + r"((?:[^\\\n]|\\.)*)\n(.*)" + re.escape(END), re.S)


def read_segment(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    found = SEGMENT.fullmatch(segment)
    if not found:
        raise ValueError(f"not a formatted turn: {segment[:80]!r}")
    return unescaped(found[1]), unescaped(found[2])


def conversation_digests(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from the formatted turns: number of turns, hash of all turns, length and hash of all text under
    the loss mask, and the length of the whole text. Turns pass one by one, so a conversation of any length needs little memory."""
    # The segment orders ties: it begins with the role, then the text.
    kind = formatted.schema[id_col].dataType
    # As text an id passes as it is, whatever its type, beside null ids as well.
    texts = formatted.withColumn(id_col, F.col(id_col).cast("string"))
    ordered = texts.repartition(F.col(id_col)).sortWithinPartitions(id_col, "turn", "segment")
    schema = T.StructType(
        [
            T.StructField(id_col, T.StringType()),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )

    def run(batches):
        state = None

        def row(s):
            return (s["id"], s["turns"], s["all"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"])

        for batch in batches:
            out = []
            for key, segment, start, length in zip(batch[id_col].tolist(), batch["segment"], batch["loss_start"], batch["loss_length"]):
                if state is None or state["id"] != key:
                    if state is not None:
                        out.append(row(state))
                    state = {"id": key, "turns": 0, "all": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0}
                role, text = read_segment(segment)
                learned = unescaped(segment[start : start + length])
                state["turns"] += 1
                state["all"].update(f"{role}\n{text}\n".encode())
                state["loss_chars"] += len(learned)
                state["loss"].update(learned.encode())
                state["chars"] += len(segment)
            yield pd.DataFrame(out, columns=schema.names)
        if state is not None:
            yield pd.DataFrame([row(state)], columns=schema.names)

    return ordered.mapInPandas(run, schema).withColumn(id_col, F.col(id_col).cast(kind))
