"""Chat formatting: schema fingerprints select how a layout becomes turns.

A layout is the set of its nested field paths (``messages[].role``).  Every
known layout is a ``Layout``: its paths, those it can do without, and a
declarative mapping to turns (role, text).  The fingerprint of a table, or of each
JSON record of a column of mixed records, is the hash of those of its paths that a
layout requires; it selects the mapping, so extra fields do not matter.  A record's
paths are taken over all elements of its arrays.

Turns are written in one template.  Control strings inside a text are escaped
reversibly, so a text can neither end its turn nor open another; the loss mask
lists where the assistant's texts stand.  ``read_back`` recovers turns and
masked text from the formatted string alone.  DataFrame functions only.

Defined cases: a null text or role is empty; a null ``turn`` comes first; rows
of one conversation with the same turn are ordered by their formatted text, and
repeated rows are repeated turns; rows with a null ``conv_id`` are one
conversation; a record of no known layout, or without turns, is one row of
``json_turn_rows`` with null turn, role and text (and a null ``layout`` if unknown),
never dropped; a missing or empty system field, or input, adds nothing; an empty table
gives an empty result.  A conversation is one string of the output, so it must fit one
(2 GB); turns are formatted and offset before they meet, and only then collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

# The template and the control strings it keeps out of texts.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
CONTROL = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
_FIRST = {"<": "\\l", "[": "\\b"}  # what stands for the first character of a control string
_BACKSLASH = "\\e"


@dataclass(frozen=True)
class Layout:
    """``schema``: its fields as DDL; ``turns``: from a function that gives a field as
    Column to array<struct<role, text>>, or None if every row is one turn; ``optional``:
    paths that a record of the layout may lack (they are null then)."""

    name: str
    schema: str
    turns: Callable[[Callable[[str], Column]], Column] | None
    optional: tuple[str, ...] = ()

    @property
    def paths(self) -> list[str]:
        """The paths that a record must have."""
        return [p for p in field_paths(StructType.fromDDL(self.schema)) if p not in self.optional]

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def _turn(role: Column | str, text: Column) -> Column:
    return F.struct((F.lit(role) if isinstance(role, str) else role).alias("role"), text.alias("text"))


def _with_system(field, *turns: Column) -> Column:
    """The turns, after the record's system text if it has one."""
    said = F.coalesce(field("system"), F.lit("")) != ""
    none = F.array().cast(_TURNS)
    return F.concat(F.when(said, F.array(_turn("system", field("system"))).cast(_TURNS)).otherwise(none), F.array(*turns).cast(_TURNS))


def _asked(question: str, answer: str):
    return lambda field: _with_system(field, _turn("user", field(question)), _turn("assistant", field(answer)))


def _instructed(field):
    asked = F.concat_ws("\n", field("instruction"), F.when(field("input") != "", field("input")))
    return _with_system(field, _turn("user", asked), _turn("assistant", field("output")))


def _messages(field):
    return F.transform(field("messages"), lambda m: _turn(m["role"], m["content"]))


def _exchanges(field):
    return F.transform(field("conversations"), lambda m: _turn(_speaker(m["from"]), m["value"]))


def _speaker(name: Column) -> Column:
    return F.when(name == "human", "user").when(name == "gpt", "assistant").otherwise(name)


_TURNS = "array<struct<role: string, text: string>>"
# more specific layouts first; a list whose elements lack a field, or an empty one, comes last
LAYOUTS = (
    Layout("turn rows", "conv_id bigint, turn bigint, role string, text string", None),
    Layout("messages", "messages array<struct<role: string, content: string>>", _messages),
    Layout("from/value", "conversations array<struct<from: string, value: string>>", _exchanges),
    Layout("instruction", "instruction string, input string, output string, system string", _instructed, ("input", "system")),
    Layout("prompt/response", "prompt string, response string, system string", _asked("prompt", "response"), ("system",)),
    Layout("prompt/completion", "prompt string, completion string, system string", _asked("prompt", "completion"), ("system",)),
    Layout("question/answer", "question string, answer string, system string", _asked("question", "answer"), ("system",)),
    Layout("messages without roles", "messages array<struct<role: string, content: string>>", _messages, ("messages[].role",)),
    Layout("messages without texts", "messages array<struct<role: string, content: string>>", _messages, ("messages[].content",)),
    Layout("no messages", "messages array<struct<role: string, content: string>>", _messages,
           ("messages[].role", "messages[].content")),
    Layout("no exchanges", "conversations array<struct<from: string, value: string>>", _exchanges,
           ("conversations[].from", "conversations[].value")),
)


def field_paths(kind: DataType, prefix: str = "") -> list[str]:
    """Sorted paths of all leaves, ``a.b`` in structs and ``a[].b`` in arrays, and of the arrays themselves, ``a[]``."""
    if isinstance(kind, StructType):
        return sorted({p for f in kind.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)})
    if isinstance(kind, ArrayType):
        return sorted({f"{prefix}[]", *field_paths(kind.elementType, f"{prefix}[]")})
    return [prefix]


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def layout_of(schema: StructType, layouts=LAYOUTS) -> Layout:
    """The first layout whose fingerprint the schema has, extra fields aside."""
    paths = set(field_paths(schema))
    for known in layouts:
        if fingerprint(paths & set(known.paths)) == known.fingerprint:
            return known
    raise ValueError(f"no known chat layout has the paths {sorted(paths)}")


def turn_rows(table: DataFrame, conv_id: str = "conv_id", layouts=LAYOUTS) -> DataFrame:
    """(conv_id, turn, role, text) of a table of any known layout."""
    known = layout_of(table.schema, layouts)
    if known.turns is None:
        return table.select("conv_id", "turn", "role", "text")
    there = set(table.columns)
    turns = known.turns(lambda name: F.col(name) if name in there else F.lit(None).cast("string"))
    return table.select(F.col(conv_id).alias("conv_id"), F.posexplode(turns).alias("turn", "t")).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "t.role", "t.text")


def json_paths(record: Column) -> Column:
    """The leaf paths of a JSON record, one level into arrays of objects (of all elements), and its arrays."""
    keys = F.json_object_keys(record)

    def below(key):
        value = F.call_function("get_json_object", record, F.concat(F.lit("$['"), key, F.lit("']")))
        elements = F.from_json(F.when(value.startswith("["), value), "array<string>")
        inner = F.array_distinct(F.flatten(F.transform(elements, lambda e: F.coalesce(
            F.json_object_keys(e), F.array().cast("array<string>")))))
        return F.when(elements.isNotNull(), F.concat(F.array(F.concat(key, F.lit("[]"))), F.transform(
            inner, lambda s: F.concat(key, F.lit("[]."), s)))).otherwise(F.array(key))

    return F.flatten(F.transform(F.coalesce(keys, F.array().cast("array<string>")), below))


def json_turn_rows(records: DataFrame, conv_id: str, column: str, layouts=LAYOUTS) -> DataFrame:
    """(conv_id, turn, role, text, layout) of a column of JSON records of mixed layouts; the
    fingerprint of each record selects its mapping.  A record without turns is one row of nulls."""
    found = records.select(F.col(conv_id).alias("conv_id"), F.col(column).alias("record"))
    found = found.withColumn("paths", json_paths(F.col("record")))
    turns, name = F.lit(None).cast(_TURNS), F.lit(None).cast("string")
    for known in reversed([k for k in layouts if k.turns is not None]):
        own = F.array(*[F.lit(p) for p in known.paths])
        mark = F.sha2(F.array_join(F.array_sort(F.array_intersect("paths", own)), "\n"), 256)
        parsed = F.from_json("record", known.schema)
        turns = F.when(mark == known.fingerprint, known.turns(parsed.getField).cast(_TURNS)).otherwise(turns)
        name = F.when(mark == known.fingerprint, known.name).otherwise(name)
    return found.select("conv_id", name.alias("layout"), F.posexplode_outer(turns).alias("turn", "t")).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "t.role", "t.text", "layout")


def escaped(text: Column) -> Column:
    """The text without control strings; ``unescaped`` is its inverse."""
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit(_BACKSLASH))
    for c in CONTROL:
        text = F.replace(text, F.lit(c), F.lit(_FIRST[c[0]] + c[1:]))
    return text


def unescaped(text: Column) -> Column:
    for first, mark in _FIRST.items():
        text = F.replace(text, F.lit(mark), F.lit(first))
    return F.replace(text, F.lit(_BACKSLASH), F.lit("\\"))


def format_chat(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_mask): one string per conversation and, as
    (start, length) in characters, where the assistant's texts stand in it."""
    head = F.concat(F.lit(OPEN), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    body = escaped(F.col("text"))
    rows = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("learn"),
        F.length(head).alias("head"), F.length(body).alias("body"), F.concat(head, body, F.lit(CLOSE)).alias("line"))
    before = Window.partitionBy("conv_id").orderBy("turn", "line").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("line")).over(before), F.lit(0)))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "line", "learn", "head", "body"))).alias("t"))
    return whole.select(
        "conv_id", F.array_join(F.col("t.line"), "").alias("formatted"),
        F.transform(F.filter("t", lambda x: x["learn"]), lambda x: F.struct(
            (x["at"] + x["head"]).alias("start"), x["body"].alias("length"))).alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_text) from the formatted string and its loss mask."""
    def turn(piece):
        role = F.substring_index(piece, "\n", 1)
        text = F.substr(piece, F.length(role) + 2)
        role = F.substr(role, F.lit(len(OPEN) + 1))
        return F.struct(unescaped(F.replace(role, F.lit("\\n"), F.lit("\n"))).alias("role"), unescaped(text).alias("text"))

    pieces = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda p: p != "")
    masked = F.transform("loss_mask", lambda m: unescaped(F.substr(F.col("formatted"), (m["start"] + 1).cast("int"), m["length"])))
    return formatted.select("conv_id", "formatted", F.transform(pieces, turn).alias("turns"),
                            F.array_join(masked, "").alias("loss_text"))
