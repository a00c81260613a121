"""Chat formatting by schema fingerprints, in DataFrame functions only.

A layout is a declaration: the field paths that name it, and where roles and texts are found. Of a record's paths
those of the most specific layout that they contain are hashed; the hash selects the layout, and the layout's mapping
gives canonical turns (role, text). A ``system`` field beside a layout without one is the first turn. Typed tables are
fingerprinted once, by the nested field paths of their schema; JSON records one by one, so that a table may mix layouts.
JSON layouts of conversations rename the roles that other tools give (``ROLES``); tables of one row for each turn keep theirs.

The template is ``<|turn:ROLE|>TEXT<|end|>`` and a newline for each turn. In texts and roles every run of ``<``,
any number of ``&``, ``|`` gets one more ``&`` (and ``|&>`` likewise in roles), so no mark can appear in them and the
escape is undone by taking one ``&`` away. The loss mask is a list of (start, length) over the formatted string.

Defined results: null roles and texts are empty. Turns are ordered by turn, then role and text, nulls first;
repeated rows stay. Rows without conv_id are one conversation with a null id. A JSON record of no known layout
keeps null turns, hence a null formatted string. Empty tables give empty tables; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prefix_sums, stash, table

_TURNS = "array<struct<role:string,text:string>>"
OPEN, SHUT, END = "<|turn:", "|>", "<|end|>\n"


@dataclass(frozen=True)
class Layout:
    """``paths`` name the layout. ``turns`` lists (role, field) of flat records, ``listed`` names a list with its role and text
    field, ``rows`` the columns of a table of turns: conversation, place, role and text."""

    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    listed: tuple[str, str, str] | None = None
    rows: tuple[str, str, str, str] | None = None


LAYOUTS = [
    Layout(("messages[].content", "messages[].role"), listed=("messages", "role", "content")),
    Layout(("conversations[].from", "conversations[].value"), listed=("conversations", "from", "value")),
    Layout(("turns[].role", "turns[].text"), listed=("turns", "role", "text")),
    Layout(("prompt", "response"), turns=(("user", "prompt"), ("assistant", "response"))),
    Layout(("completion", "prompt"), turns=(("user", "prompt"), ("assistant", "completion"))),
    Layout(("instruction", "output"), turns=(("user", "instruction"), ("assistant", "output"))),
    Layout(("input", "instruction", "output"), turns=(("user", "instruction+input"), ("assistant", "output"))),
    Layout(("prompt", "response", "system"), turns=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
]
#: Layouts of tables that hold one row for each turn.
ROW_LAYOUTS = [
    Layout(("conv_id", "role", "text", "turn"), rows=("conv_id", "turn", "role", "text")),
    Layout(("conversation_id", "from", "index", "value"), rows=("conversation_id", "index", "from", "value")),
]
#: Names that other tools give to the same roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths: Column, known: list[Layout] | None = None) -> Column:
    """Hash of the paths of the most specific layout that a record's paths contain; other paths don't count."""
    layouts = [F.array(*map(F.lit, sorted(layout.paths))) for layout in sorted(LAYOUTS if known is None else known, key=lambda x: -len(x.paths))]
    return F.xxhash64(F.coalesce(*[F.when(F.size(F.array_except(x, paths)) == 0, F.array_join(x, "\n")) for x in layouts], F.lit("")))


def _fixed(layout: Layout) -> Column:
    return F.xxhash64(F.lit("\n".join(sorted(layout.paths))))


def json_paths(record: Column) -> Column:
    """Top-level fields of a JSON record, and the fields of all elements of its lists."""
    lists = sorted({layout.listed[0] for layout in LAYOUTS if layout.listed})
    keys = F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))
    none = F.array().cast("array<string>")

    def inner(name: str) -> Column:
        items = F.coalesce(F.from_json(F.get_json_object(record, f"$.{name}"), "array<string>"), none)
        fields = F.flatten(F.transform(items, lambda x: F.coalesce(F.json_object_keys(x), none)))
        return F.transform(F.array_distinct(fields), lambda k: F.concat(F.lit(f"{name}[]."), k))

    nested = map(inner, lists)
    return F.concat(keys, *nested)


def schema_paths(schema: T.StructType) -> list[str]:
    """The nested field paths of a table: its columns, and the fields of its structs and of its lists of structs."""
    out = []
    for field in schema.fields:
        out.append(field.name)
        kind, mark = field.dataType, "."
        if isinstance(kind, T.ArrayType):
            kind, mark = kind.elementType, "[]."
        if isinstance(kind, T.StructType):
            out += [f"{field.name}{mark}{inner}" for inner in schema_paths(kind)]
    return out


def layout_of(rows: DataFrame) -> Layout:
    """The layout whose hash is the fingerprint of a typed table's schema."""
    known, paths = [*ROW_LAYOUTS, *LAYOUTS], schema_paths(rows.schema)
    marks = rows.sparkSession.range(1).select(
        fingerprint(F.array(*map(F.lit, paths)), known).alias("mark"), F.array(*map(_fixed, known)).alias("known")
    )
    mark, hashes = marks.first()
    if mark not in hashes:
        raise ValueError(f"no layout is known for the fields {paths}")
    return known[hashes.index(mark)]


def _turn(role: Column, text: Column, rename: bool = True) -> Column:
    role = F.coalesce(role, F.lit(""))
    for other, name in ROLES.items() if rename else ():
        role = F.when(role == other, F.lit(name)).otherwise(role)
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _listed(items: Column, role: str, text: str) -> Column:
    return F.transform(items, lambda x: _turn(x[role], x[text]))


def _flat(layout: Layout, field: Callable[[str], Column]) -> Column:
    join = lambda names: F.array_join(F.filter(F.array(*map(field, names)), lambda x: x != ""), "\n")
    return F.array(*[_turn(F.lit(role), join(names.split("+")) if "+" in names else field(names)) for role, names in layout.turns])


def turns_of_json(record: Column) -> Column:
    """Canonical turns of a JSON record, by the layout that its fingerprint selects."""
    mark, out = fingerprint(json_paths(record)), F.lit(None).cast(_TURNS)
    for layout in LAYOUTS:
        if layout.listed:
            name, role, text = layout.listed
            items = F.from_json(F.get_json_object(record, f"$.{name}"), f"array<struct<`{role}`:string,`{text}`:string>>")
            turns = _listed(items, role, text)
        else:
            turns = _flat(layout, lambda n: F.get_json_object(record, f"$.{n}"))
        if "system" not in layout.paths:
            system = F.get_json_object(record, "$.system")
            turns = F.when(system.isNotNull(), F.concat(F.array(_turn(F.lit("system"), system)), turns)).otherwise(turns)
        out = F.when(mark == _fixed(layout), turns).otherwise(out)
    return out


def turns_of_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turns) from a typed table; the fingerprint of its schema selects the layout.

    Tables whose rows are whole records keep a column ``conv_id``; without one the id is null.
    """
    layout = layout_of(rows)
    if layout.rows:
        conv, turn, role, text = (F.col(f"`{c}`") for c in layout.rows)
        one = F.struct(turn.alias("turn"), _turn(role, text, rename=False).alias("said"))
        grouped = rows.select(conv.alias("conv_id"), one.alias("one")).groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns"))
        return grouped.select("conv_id", F.transform("turns", lambda t: t["said"]).alias("turns"))
    if layout.listed:
        name, role, text = layout.listed
        turns = _listed(F.col(f"`{name}`"), role, text)
    else:
        field = lambda n: F.col(f"`{n}`")
        turns = _flat(layout, field)
    if "system" not in layout.paths and "system" in rows.columns:
        turns = F.when(F.col("system").isNotNull(), F.concat(F.array(_turn(F.lit("system"), F.col("system"))), turns)).otherwise(turns)
    conv = F.col("conv_id") if "conv_id" in rows.columns else F.lit(None).cast("long")
    return rows.select(conv.alias("conv_id"), turns.alias("turns"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(&*)\|", r"<&$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<&(&*)\|", r"<$1|")


def format_turns(turns: Column) -> Column:
    """(formatted, mask) of an array of canonical turns; the mask covers the assistant's texts."""
    role = lambda t: F.regexp_replace(escape(t["role"]), r"\|(&*)>", r"|&$1>")
    parts = F.transform(turns, lambda t: F.struct(F.concat(F.lit(OPEN), role(t), F.lit(SHUT)).alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("learn")))
    formatted = F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    before = prefix_sums(F.transform(parts, lambda p: F.length(p["head"]) + F.length(p["body"]) + len(END)))
    spans = F.zip_with(parts, before, lambda p, at: F.struct((at + F.length(p["head"])).alias("start"), F.length(p["body"]).alias("length"), p["learn"].alias("learn")))
    mask = F.transform(F.filter(spans, lambda s: s["learn"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    return F.struct(formatted.alias("formatted"), mask.alias("mask"))


def parse_turns(formatted: Column) -> Column:
    """The canonical turns of a formatted string."""

    def one(part: Column) -> Column:
        head = F.substring_index(part, SHUT, 1)
        body = F.substring(part, F.length(head) + len(SHUT) + 1, F.length(part) - F.length(head) - len(SHUT) - len(END))
        role = unescape(F.regexp_replace(head, r"\|&(&*)>", r"|$1>"))
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    parts = F.split(formatted, r"<\|turn:", -1)
    return F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1), one)


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped."""
    return F.array_join(F.transform(mask, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask) of a typed table of turns."""
    return turns_of_rows(rows).select("conv_id", format_turns(F.col("turns")).alias("out")).select("conv_id", "out.*")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = "</s>[INST] ok [/INST]"
    rows = rows.unionByName(spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], rows.schema))
    out = stash(format_conversations(rows), "chat")
    turns = parse_turns(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = masked_text(F.col("formatted"), F.col("mask"))
    return out.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = {
    "op5_chat": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + 17 + length(regexp_replace(text, '<(&*)\|', '<&\1|', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
}
QUERIES = {"op5_chat": op5_chat}
