"""Conversations of different layouts, converted into canonical turns and formatted with one template.

Method. A layout is a declarative mapping: the nested field paths it needs, and SQL expressions for
the conversation's id and its list of turns. The paths of an input's schema are reduced to those
that any layout names, sorted and hashed; the hash selects the mapping. Columns outside this
vocabulary never matter, whatever their names. Inputs whose rows differ come as JSON text: there the
paths of each row are hashed.

Template. A turn is ``<|turn|>role newline text<|end|>``. In roles and texts the characters ``~``,
``<``, ``[`` are written ``~0``, ``~1``, ``~2`` (and a line break in a role ``~3``), so neither the
template's own control strings nor those of common templates can come from a text, and reading back
restores every text exactly.

Defined results: null roles and texts are empty; null turn numbers come first; turns of equal number
are ordered by role, then text, and repeated rows stay repeated; rows without a conversation id form
one conversation of their own; an empty table gives no conversations.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, END = "<|turn|>", "<|end|>"
TRAINED_ROLE = "assistant"
# Order matters for reading back: the escape character last.
ESCAPES = [("\n", "~3"), ("[", "~2"), ("<", "~1"), ("~", "~0")]

TURNS = "array<struct<turn:bigint,role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    name: str
    paths: tuple[str, ...]
    conv_id: str
    turns: str


def _messages(field: str, role: str, text: str) -> str:
    return f"transform({field}, (m, i) -> named_struct('turn', CAST(i AS BIGINT), 'role', m.{role}, 'text', m.{text}))"


def _pair(prompt: str, answer: str) -> str:
    return (
        f"array(named_struct('turn', 0L, 'role', 'user', 'text', {prompt}),"
        f" named_struct('turn', 1L, 'role', 'assistant', 'text', {answer}))"
    )


LAYOUTS = [
    Layout("turn_rows", ("conv_id", "turn", "role", "text"), "conv_id", "array(named_struct('turn', turn, 'role', role, 'text', text))"),
    Layout("messages", ("conv_id", "messages.role", "messages.content"), "conv_id", _messages("messages", "role", "content")),
    Layout("shared", ("conv_id", "conversations.from", "conversations.value"), "conv_id", _messages("conversations", "`from`", "value")),
    Layout("prompt", ("conv_id", "prompt", "response"), "conv_id", _pair("prompt", "response")),
    Layout("completion", ("conv_id", "prompt", "completion"), "conv_id", _pair("prompt", "completion")),
    Layout(
        "instruction",
        ("conv_id", "instruction", "input", "output"),
        "conv_id",
        _pair("concat_ws('\n', instruction, nullif(input, ''))", "output"),
    ),
    Layout("bare_instruction", ("conv_id", "instruction", "output"), "conv_id", _pair("instruction", "output")),
]
# Types of the JSON form of each layout.
JSON_SCHEMAS = {
    "messages": "conv_id bigint, messages array<struct<role:string,content:string>>",
    "shared": "conv_id bigint, conversations array<struct<`from`:string,value:string>>",
    "prompt": "conv_id bigint, prompt string, response string",
    "completion": "conv_id bigint, prompt string, completion string",
    "instruction": "conv_id bigint, instruction string, input string, output string",
    "bare_instruction": "conv_id bigint, instruction string, output string",
}
VOCABULARY = sorted({path for layout in LAYOUTS for path in layout.paths})


def field_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """Dotted paths of all leaves; arrays add nothing to a path."""
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, prefix)
    if isinstance(schema, T.StructType):
        dot = f"{prefix}." if prefix else ""
        return [path for field in schema.fields for path in field_paths(field.dataType, dot + field.name)]
    return [prefix]


def fingerprint(paths) -> str:
    """Hash of the known paths among ``paths``."""
    return sha256("\n".join(sorted(set(paths) & set(VOCABULARY))).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(layout.paths): layout for layout in LAYOUTS}


def layout_of(schema: T.StructType) -> Layout:
    """The mapping for a schema.

    A schema with the paths of several layouts has no mapping of its own; it takes the one with most paths.
    """
    paths = field_paths(schema)
    if found := BY_FINGERPRINT.get(fingerprint(paths)):
        return found
    fitting = [layout for layout in LAYOUTS if set(layout.paths) <= set(paths)]
    if not fitting:
        raise ValueError(f"no layout for the fields {', '.join(paths)}")
    return max(fitting, key=lambda layout: len(layout.paths))


def _rows(conv_id: str, turns: str, df: DataFrame) -> DataFrame:
    return df.select(F.expr(conv_id).cast("bigint").alias("conv_id"), F.inline(F.expr(turns).cast(TURNS)))


def canonical_turns(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of any table whose schema fits a layout."""
    layout = layout_of(df.schema)
    return _rows(layout.conv_id, layout.turns, df)


def canonical_turns_of_json(df: DataFrame, payload: str) -> DataFrame:
    """The same for a column of JSON objects whose layout may change from row to row.

    A row that is not valid JSON or fits no layout gives no turns; ``unknown_layout`` finds those rows.
    """
    tagged = df.select(F.col(payload).alias("payload"), _json_layout(F.col(payload)).alias("layout"))
    parts = []
    for layout in LAYOUTS:
        if layout.name in JSON_SCHEMAS:
            own = tagged.filter(F.col("layout") == layout.name)
            parts.append(_rows(layout.conv_id, layout.turns, own.select(F.inline(F.array(F.from_json("payload", JSON_SCHEMAS[layout.name]))))))
    turns = parts[0]
    for part in parts[1:]:
        turns = turns.unionByName(part)
    return turns


def unknown_layout(df: DataFrame, payload: str) -> DataFrame:
    return df.filter(_json_layout(F.col(payload)).isNull())


def _json_layout(payload: Column) -> Column:
    """Name of the layout whose fingerprint the row's own known paths have."""
    top = F.json_object_keys(payload)
    nested = [F.when(F.array_contains(top, F.lit(field)), F.get_json_object(payload, f"$.{field}[0]")) for field in ("messages", "conversations")]

    def below(field: str, first: Column) -> Column:
        return F.transform(F.coalesce(F.json_object_keys(first), F.array().cast("array<string>")), lambda key: F.concat(F.lit(field + "."), key))

    prefixed = [below(field, first) for field, first in zip(("messages", "conversations"), nested)]
    paths = F.array_intersect(F.concat(top, *prefixed), F.array(*map(F.lit, VOCABULARY)))
    mark = F.sha2(F.array_join(F.array_sort(paths), "\n"), 256)
    named = F.lit(None).cast("string")
    for key, layout in BY_FINGERPRINT.items():
        named = F.when(mark == key, layout.name).otherwise(named)
    return named


def escape(text: Column, line_breaks: bool = False) -> Column:
    for plain, written in reversed(ESCAPES if line_breaks else ESCAPES[1:]):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, line_breaks: bool = False) -> Column:
    for plain, written in ESCAPES if line_breaks else ESCAPES[1:]:
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def format_turns(turns: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """conv_id, n_turns, ``formatted`` and ``loss_spans`` (start, end in code points, end exclusive).

    A loss span covers the escaped text of one turn of ``trained_role`` and nothing else. One shuffle by
    conversation: the running length gives each turn its place before the turns are joined.
    """
    empty = F.lit("")
    role, text = F.coalesce("role", empty), F.coalesce("text", empty)
    head = F.concat(F.lit(TURN), escape(role, line_breaks=True), F.lit("\n"))
    body = escape(text)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), head.alias("head"), body.alias("body"))
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    running = F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumns({"place": F.row_number().over(order), "start": running - F.length("piece") + F.length("head")})
    span = F.struct(F.col("start").alias("start"), (F.col("start") + F.length("body")).alias("end"))
    placed = placed.select("conv_id", "place", "piece", F.when(F.col("role") == trained_role, span).alias("span"))
    turns_of = F.array_sort(F.collect_list(F.struct("place", "piece", "span")))
    grouped = placed.groupBy("conv_id").agg(turns_of.alias("all"))
    return grouped.select(
        "conv_id",
        F.size("all").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("all", lambda t: t["piece"]), "").alias("formatted"),
        F.array_compact(F.transform("all", lambda t: t["span"])).alias("loss_spans"),
    )


def parse_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda piece: piece != "")

    def turn(piece: Column) -> Column:
        rest = F.substring(piece, len(TURN) + 1, F.length(piece))
        role = F.substring_index(rest, "\n", 1)
        text = F.substring(rest, F.length(role) + 2, F.length(rest))
        return F.struct(unescape(role, line_breaks=True).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest columns, all taken from ``formatted`` and ``loss_spans``."""
    said = F.array_join(
        F.transform(parse_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = F.array_join(
        F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), ""
    )
    return (
        formatted.withColumns({"__said": said, "__loss": loss})
        .select(
            "conv_id",
            F.size(parse_turns(F.col("formatted"))).cast("bigint").alias("n_turns"),
            F.sha2("__said", 256).alias("turns_sha256"),
            F.length("__loss").cast("bigint").alias("loss_chars"),
            F.sha2("__loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("bigint").alias("formatted_chars"),
        )
    )
