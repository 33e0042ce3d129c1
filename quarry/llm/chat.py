"""Chat formatting: schema fingerprints choose how a row becomes turns.

A row's fingerprint is the hash of the nested field paths it fills, out of the
paths that the mappings know. The fingerprint selects a declarative mapping
from the row's layout (prompt/response, instruction, message lists, one row per
turn) to canonical turns (conv_id, turn, role, text); the template then writes
each conversation as

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n ...

Control strings in texts are escaped reversibly: ``<``, any number of
backslashes, ``|`` gets one more backslash, so that ``<|`` only ever comes from
the template. Roles are percent-escaped (``%``, ``<`` and line feeds).

DataFrame functions only; a conversation is one row of the result, as its
output is one text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Mapping:
    """How one layout gives turns.

    paths: the field paths a row of this layout fills (its fingerprint).
    turns: (role literal, path) pairs, each one turn, first; and/or
    items: (array path, role field, text field), one turn per element; or
    flat:  (turn path, role path, text path), the row itself is one turn.
    """
    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    items: tuple[str, str, str] | None = None
    flat: tuple[str, str, str] | None = None


# The public layouts' field names and role words.
MAPPINGS = (
    Mapping("turn_rows", ("turn", "role"), flat=("turn", "role", "text")),
    Mapping("prompt_response", ("prompt", "response"), turns=(("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt_completion", ("prompt", "completion"), turns=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("system_prompt_response", ("prompt", "response", "system"),
            turns=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("instruction", ("instruction", "output"), turns=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input", ("input", "instruction", "output"),
            turns=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("question_answer", ("answer", "question"), turns=(("user", "question"), ("assistant", "answer"))),
    Mapping("messages", ("messages[].content", "messages[].role"), items=("messages", "role", "content")),
    Mapping("from_value", ("conversations[].from", "conversations[].value"),
            items=("conversations", "from", "value")),
    Mapping("system_messages", ("messages[].content", "messages[].role", "system"), turns=(("system", "system"),),
            items=("messages", "role", "content")),
    Mapping("system_from_value", ("conversations[].from", "conversations[].value", "system"),
            turns=(("system", "system"),), items=("conversations", "from", "value")),
)
ORDER = ("system", "user", "assistant")   # of the texts of a row in no layout
ROLE_WORDS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(schema: T.StructType) -> list[str]:
    """All nested field paths, array elements marked by ``[]``, sorted."""
    out = []

    def walk(kind: T.DataType, path: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f.dataType, f"{path}.{f.name}" if path else f.name)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            walk(kind.elementType, f"{path}[]")
        else:
            out.append(path)

    walk(schema, "")
    return sorted(out)


def _types(schema: T.StructType) -> dict[str, T.DataType]:
    """Every nested field, not only leaves, with its type."""
    out: dict[str, T.DataType] = {}

    def walk(kind: T.DataType, path: str) -> None:
        if path:
            out.setdefault(path, kind)
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f.dataType, f"{path}.{f.name}" if path else f.name)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            walk(kind.elementType, f"{path}[]")

    for f in schema.fields:   # a column whose name holds a dot goes before a nested field of that path
        out[f.name] = f.dataType
    walk(schema, "")
    return out


def _at(path: str, top: set[str]) -> Column:
    """The column of a path: a column of that name, else a field of a struct."""
    return F.col(f"`{path}`" if path in top else ".".join(f"`{p}`" for p in path.split(".")))


def _said(c: Column, kind: T.DataType | None) -> Column:
    """The text of a value: strings as they are, the texts of content parts
    joined (their ``text`` or ``content`` field, else their JSON), other values as
    text or JSON; NULL is empty."""
    if isinstance(kind, T.ArrayType):
        parts = F.array_join(F.transform(c, lambda x: _said(x, kind.elementType)), "")
        return F.coalesce(parts, F.lit(""))
    if isinstance(kind, T.StructType):
        named = {f.name: f.dataType for f in kind.fields}
        texts = [F.when(c[n].isNotNull(), _said(c[n], named[n])) for n in ("text", "content") if n in named]
        whole = F.when(c.isNotNull(), F.to_json(c))
        return F.coalesce(*texts, whole, F.lit(""))
    if isinstance(kind, (T.MapType, T.VariantType)):
        return F.coalesce(F.to_json(c), F.lit(""))
    return _text(c)


def _fingerprint_of(paths) -> Column:
    return F.xxhash64(F.array(*[F.lit(p) for p in sorted(paths)]))


def _filled(path: str, top: set[str]) -> Column:
    """Whether a row fills a path: of a list, its being there."""
    return _at(path.split("[]")[0], top).isNotNull()


def row_fingerprint(schema: T.StructType, mappings: tuple[Mapping, ...] = MAPPINGS) -> Column:
    """Hash of the known paths that the schema has and the row fills. The paths
    of a turn row count as one: they are filled when the row has any of turn,
    role or text, or no path of another layout."""
    have, top = set(_types(schema)), set(schema.names)
    flat = [m for m in mappings if m.flat and set(m.paths) <= have]
    turn_paths = {p for m in flat for p in m.paths}
    others = sorted({p for m in mappings if not m.flat for p in m.paths} & have - turn_paths)
    there = {p: _filled(p, top) for p in others}
    none = ~reduce(or_, there.values(), F.lit(False))
    for m in flat:
        some = reduce(or_, [_filled(p, top) for p in m.flat if p in have])
        there |= {p: some | none for p in m.paths}
    parts = [F.when(there[p], F.lit(p)) for p in sorted(there)]
    return F.xxhash64(F.array_compact(F.array(*parts) if parts else F.array().cast("array<string>")))


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _turn(number: Column, role: Column, text: Column) -> Column:
    return F.struct(number.cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))


def _item_turns(items: tuple[str, str, str], types: dict[str, T.DataType], top: set[str], after: int = 0) -> Column:
    array, role, text = items
    said = types.get(f"{array}[].{text}")
    return F.transform(_at(array, top), lambda e, i: _turn(i + after, _text(e[role]), _said(e[text], said)))


def _flat_turn(m: Mapping, types: dict[str, T.DataType], top: set[str]) -> Column:
    """The one turn of a row, of the paths that the schema has."""
    t, r, x = m.flat
    turn = _at(t, top) if t in types else F.lit(None)
    role = _text(_at(r, top)) if r in types else F.lit("")
    return F.array(_turn(turn, role, _said(_at(x, top), types[x]) if x in types else F.lit("")))


def _list_texts(array: str, role: str | None, text: str, types: dict[str, T.DataType], top: set[str], turn_type: str) -> Column:
    said = types.get(f"{array}[].{text}")
    turns = F.transform(_at(array, top), lambda e: _turn(
        F.lit(0), F.lit("unknown") if role is None else _text(e[role]), _said(e[text], said)))
    return F.coalesce(turns.cast(turn_type), F.array().cast(turn_type))


def _other_texts(types: dict[str, T.DataType], known: set[str], top: set[str], turn_type: str) -> Column:
    """Texts of the fields that no mapping knows, in the order of their paths:
    strings, and lists of strings or of structs with strings."""
    def holds_text(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return holds_text(kind.elementType)
        return isinstance(kind, T.StringType) or isinstance(kind, T.StructType) and any(holds_text(f.dataType) for f in kind.fields)

    found = []
    for path in sorted(types):
        kind = types[path]
        inside = any(path.startswith((k + ".", k + "[]")) for k in known)
        leads = any(k.startswith((path + ".", path + "[]")) for k in known)
        if "[]" in path or path in known or inside or leads or isinstance(kind, T.StructType) or not holds_text(kind):
            continue
        found.append(F.when(_at(path, top).isNotNull(), _turn(F.lit(0), F.lit("unknown"), _said(_at(path, top), kind))))
    return F.array(*found).cast(turn_type) if found else F.array().cast(turn_type)


def _all_texts(mappings: tuple[Mapping, ...], types: dict[str, T.DataType], top: set[str], id_col: str, turn_type: str) -> Column:
    """The turns of all texts of a row that is in no layout."""
    literal: dict[str, str] = {}
    for m in mappings:
        literal |= {p: literal.get(p, r) for r, p in m.turns}
    order = sorted((p for p in literal if p in types), key=lambda p: ORDER.index(literal[p]) if literal[p] in ORDER else len(ORDER))
    groups = [F.array(*[F.when(_filled(p, top), _turn(F.lit(0), F.lit(literal[p]), _said(_at(p, top), types[p])))
                        for p in order]).cast(turn_type)] if order else []
    lists = []
    for m in sorted(mappings, key=lambda m: m.flat is not None):
        if m.items:
            a, r, x = m.items
            if f"{a}[].{x}" in types and m.items not in lists:
                lists.append(m.items)
                groups.append(_list_texts(a, r if f"{a}[].{r}" in types else None, x, types, top, turn_type))
        elif m.flat and m.flat[2] in types:
            t, r, x = m.flat
            role = F.coalesce(_at(r, top).cast("string"), F.lit("unknown")) if r in types else F.lit("unknown")
            groups.append(F.array(F.when(_filled(x, top), _turn(F.lit(0), role, _said(_at(x, top), types[x])))).cast(turn_type))
    known = {id_col, *literal, *(p for m in mappings for p in (*m.paths, *(m.flat or ())))}
    known |= {m.items[0] for m in mappings if m.items and f"{m.items[0]}[].{m.items[2]}" in types}
    groups.append(_other_texts(types, known, top, turn_type))
    unknown = F.array(_turn(F.lit(0), F.lit("unknown"), F.lit(""))).cast(turn_type)
    found = F.array_compact(F.concat(*groups))
    found = F.transform(found, lambda e, i: _turn(i, e.role, e.text))
    return F.when(F.size(found) > 0, found.cast(turn_type)).otherwise(unknown)


def to_turns(df: DataFrame, id_col: str = "conv_id", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Canonical turns (conv_id, turn, role, text, layout) of rows in any of
    the known layouts, mixed layouts included. Null roles and texts become
    empty. A row whose paths are those of no layout (a prompt without response,
    paths of two layouts) gives the turns of every text that it fills, with
    layout null: literal turns in the order of ``ORDER``, then lists, then the
    turn row, then the strings of all other fields, nested ones included, in the
    order of their paths; a role that no mapping knows is ``unknown``. A row
    that fills nothing gives one such turn with an empty text, so that no row is
    lost. Content that is a list of parts is the parts' texts joined. Of rows in a
    known layout other columns are not read."""
    types, top = _types(df.schema), set(df.columns)
    have = set(types)
    turn_type = "array<struct<turn:bigint,role:string,text:string>>"
    case, layout = None, None
    src = df.withColumn("__fp", row_fingerprint(df.schema, mappings))
    for m in mappings:
        if not set(m.paths) <= have:
            continue
        first = [_turn(F.lit(i), F.lit(r), _said(_at(p, top), types[p])) for i, (r, p) in enumerate(m.turns)]
        if m.flat:
            turns = _flat_turn(m, types, top)
        elif m.items:
            listed = _item_turns(m.items, types, top, len(first)).cast(turn_type)
            turns = F.concat(F.array(*first).cast(turn_type), listed) if first else listed
        else:
            turns = F.array(*first)
        hit = F.col("__fp") == _fingerprint_of(m.paths)
        turns = turns.cast(turn_type)
        case = F.when(hit, turns) if case is None else case.when(hit, turns)
        layout = F.when(hit, m.name) if layout is None else layout.when(hit, m.name)
    rest = _all_texts(mappings, types, top, id_col, turn_type)
    case = rest if case is None else case.otherwise(rest)
    out = src.select(F.col(f"`{id_col}`").alias("conv_id"),
                     (F.lit(None).cast("string") if layout is None else layout).alias("layout"),
                     F.inline(case))
    role = F.col("role")
    for word, canonical in ROLE_WORDS.items():
        role = F.when(F.lower("role") == word, canonical).otherwise(role)
    return out.select("conv_id", "turn", role.alias("role"), "text", "layout")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escape_role(role: Column) -> Column:
    return _replace(_replace(_replace(role, "%", "%25"), "<", "%3C"), "\n", "%0A")


def unescape_role(role: Column) -> Column:
    return _replace(_replace(_replace(role, "%0A", "\n"), "%3C", "<"), "%25", "%")


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_spans
    (code points [start, end) of the loss role's texts within ``formatted``).

    Turns are ordered by turn, then role, then text, so ties and repeated rows
    have one result; a null turn number comes first and a null conv_id is a
    conversation of its own. An empty table gives an empty result.
    """
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    t = t.select("conv_id", "turn", "role", "text", head.alias("head"), escape(F.col("text")).alias("body"))
    t = t.withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    t = t.select(
        "conv_id", "piece", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
        .alias("at"), (F.col("role") == loss_role).alias("in_loss"), F.length("head").alias("skip"),
        F.length("body").alias("size"), (F.sum(F.length("piece").cast("long")).over(w) - F.length("piece")).alias("from"))
    start = F.col("from") + F.col("skip")
    t = t.withColumn("span", F.when(F.col("in_loss"), F.struct(start.alias("start"),
                                                              (start + F.col("size")).alias("end"))))
    rows = F.sort_array(F.collect_list(F.struct("at", "piece", "span")))
    g = t.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), rows.alias("rows"))
    return g.select("conv_id", "n_turns", F.array_join(F.transform("rows", lambda r: r.piece), "").alias("formatted"),
                    F.filter(F.transform("rows", lambda r: r.span), lambda s: s.isNotNull()).alias("loss_spans"))


def parse_turns(formatted: Column) -> Column:
    """Read a formatted conversation back: array of (role, text)."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda p: p != "")
    tail = len(END) + 1

    def turn(p: Column) -> Column:
        cut = F.locate("\n", p)
        return F.struct(unescape_role(F.substring(p, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substring(p, cut + 1, F.length(p) - cut - tail)).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s.start + 1).cast("int"), (s.end - s.start).cast("int")))), "")
