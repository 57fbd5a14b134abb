"""Chat formatting: schema fingerprints select mappings to canonical turns; a reversible template writes them.

The nested field paths of a table (or, for JSON rows, of each row) are hashed; the hash selects a declarative
mapping to canonical turns ``conv_id, turn, role, text``. A table with columns beyond a mapping's takes the
mapping with most paths among those that it holds in full (ties: the first by name); none at all is an error.

Null roles and texts are empty. Equal turn numbers are ordered by role, then text; null numbers come first.
Rows with a null id form one conversation. A conversation without turns is an empty text. Repeated turns stay.

Template: ``[INST] role\\ntext [/INST]``, for an assistant ``<s> role\\ntext </s>``. Inside roles and texts a
backslash is doubled, and one is put behind the first character of each control string, as is one before
a role's line ends; so no control string within a text survives, and dropping one backslash of each pair gives
the text back.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASSISTANT = "assistant"
# Names of roles in other layouts.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns.

    ``rows``: a row for each turn, with ``order``. ``list``: an array of structs at ``turns``. ``fields``: one
    column per turn, as pairs of role and column, of which null ones are no turns.
    """

    kind: str
    id: str
    order: str = ""
    turns: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()

    @property
    def paths(self) -> frozenset[str]:
        if self.kind == "rows":
            return frozenset((self.id, self.order, self.role, self.text))
        if self.kind == "list":
            return frozenset((self.id, f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"))
        return frozenset((self.id, *[path for _, path in self.fields]))


MAPPINGS = {
    "turn_rows": Mapping("rows", "conv_id", order="turn", role="role", text="text"),
    "messages": Mapping("list", "conv_id", turns="messages", role="role", text="content"),
    "shared_conversations": Mapping("list", "id", turns="conversations", role="from", text="value"),
    "instruction": Mapping("fields", "id", fields=(("user", "instruction"), ("assistant", "output"))),
    "instruction_input": Mapping(
        "fields", "id", fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))
    ),
    "prompt": Mapping("fields", "id", fields=(("user", "prompt"), ("assistant", "response"))),
    "question": Mapping(
        "fields", "id", fields=(("system", "system"), ("user", "question"), ("assistant", "answer"))
    ),
}


def field_paths(kind: T.DataType, at: str = "") -> set[str]:
    """The leaves of a type, such as ``messages[].role``."""
    if isinstance(kind, T.StructType):
        return {p for f in kind for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)}
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    if isinstance(kind, T.MapType):
        return field_paths(kind.valueType, f"{at}{{}}")
    return {at}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def select_mapping(schema: T.StructType, mappings: dict[str, Mapping] = MAPPINGS) -> Mapping:
    paths = field_paths(schema)
    known = {fingerprint(m.paths): m for m in mappings.values()}
    if found := known.get(fingerprint(paths)):
        return found
    held = sorted(((-len(m.paths), name) for name, m in mappings.items() if m.paths <= paths))
    if not held:
        raise ValueError(f"no mapping for the paths {sorted(paths)}")
    return mappings[held[0][1]]


def _role(role: Column) -> Column:
    """A role of another layout by its canonical name."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])[role], role)


def _turn(order: Column, role: Column, text: Column) -> Column:
    return F.struct(
        order.cast("long").alias("turn"),
        F.coalesce(role.cast("string"), F.lit("")).alias("role"),
        F.coalesce(text.cast("string"), F.lit("")).alias("text"),
    )


def _quoted(path: str) -> Column:
    return F.col(".".join(f"`{part}`" for part in path.split(".")))


def _field_turns(columns: list[tuple[str, Column]]) -> Column:
    turns = [F.when(c.isNotNull(), _turn(F.lit(n), F.lit(role), c)) for n, (role, c) in enumerate(columns)]
    return F.filter(F.array(*turns), lambda t: t.isNotNull())


def _list_turns(messages: Column, role: str, text: str) -> Column:
    present = F.filter(messages, lambda m: m.isNotNull())
    return F.coalesce(F.transform(present, lambda m, n: _turn(n, _role(m[role]), m[text])), F.array().cast(TURNS))


TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def conversations(df: DataFrame, mappings: dict[str, Mapping] = MAPPINGS) -> DataFrame:
    """``conv_id long, conv_key string, turns array<struct<turn, role, text>>`` in order, from any known layout.

    ``conv_key`` is the id as text, by which conversations are told apart; ``conv_id`` is null where that is no whole number.
    """
    m = select_mapping(df.schema, mappings)
    key = _quoted(m.id).cast("string").alias("conv_key")
    number = F.col("conv_key").try_cast("long").alias("conv_id")
    if m.kind == "rows":
        turn = _turn(_quoted(m.order), _quoted(m.role), _quoted(m.text))
        return df.groupBy(key).agg(F.sort_array(F.collect_list(turn)).alias("turns")).select(number, "conv_key", "turns")
    if m.kind == "list":
        turns = _list_turns(_quoted(m.turns), m.role, m.text)
    else:
        turns = _field_turns([(role, _quoted(path)) for role, path in m.fields])
    return df.select(key, turns.alias("turns")).select(number, "conv_key", "turns")


def json_conversations(df: DataFrame, column: str, mappings: dict[str, Mapping] = MAPPINGS) -> DataFrame:
    """The same from JSON rows of mixed layouts, each by its own fingerprint.

    A row's shape (``schema_of_variant`` with scalar types made equal) is hashed and looked up; a shape that is
    not known takes the first mapping, by most paths and name, all of whose paths it has. What is no object, or
    fits no mapping, gets null turns, for the caller to count or drop.
    """
    v = F.try_parse_json(F.col(column))
    scalar = r"\b(?:STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|VOID|DATE|TIMESTAMP|DECIMAL\(\d+,\s?\d+\))"
    shape = F.sha2(F.regexp_replace(F.schema_of_variant(v), scalar, "*"), 256)
    ordered = sorted(mappings.items(), key=lambda item: (-len(item[1].paths), item[0]))
    exact, partial = F.lit(None).cast(TURNS), F.lit(None).cast(TURNS)
    for _, m in reversed([(n, m) for n, m in ordered if m.kind != "rows"]):
        if m.kind == "list":
            inner = ", ".join(f"{f}: *" for f in sorted((m.role, m.text)))
            parts = {m.id: "*", m.turns: f"ARRAY<OBJECT<{inner}>>"}
            kind = f"array<struct<`{m.role}`:string,`{m.text}`:string>>"
            got = F.try_variant_get(v, f"$.{m.turns}", kind)
            turns, present = _list_turns(got, m.role, m.text), got.isNotNull()
        else:
            parts = {p: "*" for p in m.paths}
            fields = [(role, F.try_variant_get(v, f"$.{path}", "string")) for role, path in m.fields]
            turns, present = _field_turns(fields), F.lit(True)
            for _, c in fields:
                present = present & c.isNotNull()
        text = "OBJECT<" + ", ".join(f"{k}: {parts[k]}" for k in sorted(parts)) + ">"
        known = shape == F.sha2(F.lit(text), 256)
        exact, partial = F.when(known, turns).otherwise(exact), F.when(present, turns).otherwise(partial)
    ids = sorted({m.id for m in mappings.values() if m.kind != "rows"})
    key = F.coalesce(*[F.try_variant_get(v, f"$.{i}", "string") for i in ids]).alias("conv_key")
    found = df.select(key, F.coalesce(exact, partial).alias("turns"))
    return found.select(F.col("conv_key").try_cast("long").alias("conv_id"), "conv_key", "turns")


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, r"<(?=/?s>)|\[(?=/?INST\])", r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _written(turn: Column) -> Column:
    head = F.regexp_replace(escape(turn["role"]), "\n", "\\\\\n")
    body = F.concat(head, F.lit("\n"), escape(turn["text"]))
    return F.when(turn["role"] == ASSISTANT, F.concat(F.lit("<s> "), body, F.lit(" </s>"))).otherwise(
        F.concat(F.lit("[INST] "), body, F.lit(" [/INST]"))
    )


def format_chats(chats: DataFrame) -> DataFrame:
    """``formatted`` beside the ids of ``turns``; null turns are none."""
    ids = [c for c in ("conv_id", "conv_key") if c in chats.columns]
    return chats.select(*ids, F.coalesce(F.array_join(F.transform("turns", _written), ""), F.lit("")).alias("formatted"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """Adds what a formatted text says.

    ``turns array<struct<role, text>>``, unescaped, and ``loss_spans array<struct<start, length>>``: where in the
    formatted text (code points, from 1) the still escaped text of each assistant turn stands.
    """
    role_end = r"(?s)^[^\\\n]*+(?:\\.[^\\\n]*+)*+"

    def parsed(piece: Column) -> Column:
        mine = piece.startswith("<s> ")
        head = F.when(mine, F.lit(4)).otherwise(F.lit(7))
        tail = F.when(mine, F.lit(5)).otherwise(F.lit(8))
        body = F.substring(piece, head + 1, F.length(piece) - head - tail)
        role = F.regexp_extract(body, role_end, 0)
        return F.struct(
            mine.alias("mine"),
            role.alias("role"),
            F.substring(body, F.length(role) + 2, F.length(body)).alias("text"),
            (head + F.length(role) + 1).alias("before"),
            F.length(piece).alias("length"),
        )

    pieces = F.filter(F.split("formatted", r"(?=\[INST\] |<s> )"), lambda p: p != "")
    with_pieces = formatted.withColumn("_pieces", F.transform(pieces, parsed))
    none = F.array().cast("array<struct<start:int,length:int>>")
    start = F.struct(F.lit(1).alias("at"), none.alias("spans"))

    def placed(state: Column, p: Column) -> Column:
        span = F.struct((state["at"] + p["before"]).alias("start"), F.length(p["text"]).alias("length"))
        spans = F.when(p["mine"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + p["length"]).alias("at"), spans.alias("spans"))

    turns = F.transform(
        "_pieces", lambda p: F.struct(unescape(p["role"]).alias("role"), unescape(p["text"]).alias("text"))
    )
    return with_pieces.select(
        *formatted.columns,
        turns.alias("turns"),
        F.aggregate("_pieces", start, placed, lambda s: s["spans"]).alias("loss_spans"),
    )


def digest_chats(read: DataFrame) -> DataFrame:
    """One row per conversation: lengths and digests of what was read back."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = F.transform("loss_spans", lambda s: F.col("formatted").substr(s["start"], s["length"]))
    loss = F.array_join(F.transform(parts, unescape), "")
    return read.select("conv_id", "formatted", "turns", loss.alias("_loss"), whole.alias("_whole")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2("_whole", 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
