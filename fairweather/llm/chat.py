"""Chat formatting: layouts recognised by a fingerprint of their fields, then one template.

Conversations come as records of any layout: JSON texts, or the rows of a table,
which are made records first. The fingerprint of a record is a hash of its
nested field paths. It selects a declarative mapping from that layout to
canonical turns of role and text. All of it is DataFrame and SQL functions.
"""

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- layouts and their fingerprints ---------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    ``paths`` are all its nested fields, ``[]`` standing for the elements of an
    array. Turns are either the fields named in ``single`` (path, role), or the
    elements of the array at ``turns`` with ``role`` and ``text`` in them, ordered
    by the number at ``order`` where there is one. All of these may be paths
    through any number of objects. ``roles`` renames roles.
    """

    name: str
    paths: tuple[str, ...]
    key: str = "id"
    single: tuple[tuple[str, str], ...] = ()
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    order: str | None = None
    roles: dict[str, str] = field(default_factory=dict)

    @cached_property
    def variants(self) -> list[tuple[str, ...]]:
        """The paths of records of this layout: an array of turns may be empty."""
        if self.turns is None:
            return [self.paths]
        inside = f"{self.turns}[]"
        return [self.paths, (*[p for p in self.paths if not p.startswith(inside)], inside)]


LAYOUTS = [
    Layout("messages", ("id", "messages[].content", "messages[].role"), turns="messages"),
    Layout(
        "conversations",
        ("conversations[].from", "conversations[].value", "id"),
        turns="conversations",
        role="from",
        text="value",
        roles={"human": "user", "gpt": "assistant"},
    ),
    Layout(
        "turn rows",
        ("conv_id", "turns[].role", "turns[].text", "turns[].turn"),
        key="conv_id",
        turns="turns",
        text="text",
        order="turn",
    ),
    Layout(
        "nested messages",
        ("data.messages[].author.role", "data.messages[].content.text", "meta.id"),
        key="meta.id",
        turns="data.messages",
        role="author.role",
        text="content.text",
        roles={"human": "user", "bot": "assistant"},
    ),
    Layout("prompt", ("completion", "id", "prompt"), single=(("prompt", "user"), ("completion", "assistant"))),
    Layout(
        "instruction",
        ("id", "input", "instruction", "output"),
        single=(("instruction", "user"), ("input", "user"), ("output", "assistant")),
    ),
    Layout("instruction only", ("id", "instruction", "output"), single=(("instruction", "user"), ("output", "assistant"))),
]
# The role of the one turn of a record that no layout maps.
UNMAPPED = "record"

# A type as text: names (quoted where they are no plain words), what opens and closes, and leaves.
_NAME = r"(`(?:[^`]|``)*`|[^\s<>,`:()]+): "
_TYPE_TOKENS = rf"{_NAME}|OBJECT<>|OBJECT<|ARRAY<|>|[A-Z_]+(\([0-9, ]*\))?"


def fingerprint(paths: Column) -> Column:
    """Hash of nested field paths; the order and repetition of the fields do not count."""
    return F.sha2(F.array_join(F.array_sort(F.array_distinct(paths)), "\n"), 256)


def record_paths(record: Column) -> Column:
    """Nested field paths of a record (a variant), however deep.

    The type of the record is read token by token, with a stack of the objects
    and arrays that are open. An empty array ends in ``[]``, an empty object and
    a null are leaves. Names that are no plain words stay quoted.
    """
    tokens = F.regexp_extract_all(F.schema_of_variant(record), F.lit(_TYPE_TOKENS), F.lit(0))
    start = F.struct(
        F.array(F.lit("")).alias("stack"), F.lit("").alias("at"), F.array().cast("array<string>").alias("paths")
    )

    def step(state: Column, token: Column) -> Column:
        stack, at, paths = state["stack"], state["at"], state["paths"]
        inner = F.element_at(stack, -1)
        is_name = token.endswith(": ")
        is_array, is_object, closes = token == "ARRAY<", token == "OBJECT<", token == ">"
        name = F.regexp_replace(token, ": $", "")
        return F.struct(
            F.when(is_array, F.concat(stack, F.array(inner)))
            .when(is_object, F.concat(stack, F.array(F.when(at == "", "").otherwise(F.concat(at, F.lit("."))))))
            .when(closes, F.slice(stack, F.lit(1), F.size(stack) - 1))
            .otherwise(stack)
            .alias("stack"),
            F.when(is_name, F.concat(inner, name)).when(is_array, F.concat(at, F.lit("[]"))).otherwise(at).alias("at"),
            F.when(is_name | is_array | is_object | closes, paths).otherwise(F.concat(paths, F.array(at))).alias("paths"),
        )

    return F.aggregate(tokens, start, step, lambda state: F.array_sort(F.array_distinct(state["paths"])))


TURNS = "array<struct<role: string, text: string>>"


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _mapped(record: Column, layout: Layout) -> Column:
    """The turns of a record of this layout. Absent single fields make no turn."""
    if layout.turns is None:
        fields = [(F.try_variant_get(record, f"$.{path}", "string"), role) for path, role in layout.single]
        turns = F.array(*[F.when(text.isNotNull(), _turn(F.lit(role), text)) for text, role in fields])
        return F.filter(turns, lambda t: t.isNotNull())

    def mapped(element: Column) -> Column:
        role = F.try_variant_get(element, f"$.{layout.role}", "string")
        for old, new in layout.roles.items():
            role = F.when(role == old, new).otherwise(role)
        return _turn(role, F.try_variant_get(element, f"$.{layout.text}", "string"))

    elements = F.coalesce(
        F.try_variant_get(record, f"$.{layout.turns}", "array<variant>"), F.array().cast("array<variant>")
    )
    if layout.order is None:
        return F.transform(elements, mapped)

    def numbered(element: Column) -> Column:
        number, turn = F.try_variant_get(element, f"$.{layout.order}", "bigint"), mapped(element)
        return F.struct(number.alias("number"), turn["role"].alias("role"), turn["text"].alias("text"))

    # nulls first; equal numbers go by role and text
    ordered = F.array_sort(F.transform(elements, numbered))
    return F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def turns_of_variants(
    records: DataFrame, record: str, layouts: list[Layout] = LAYOUTS, raw: Column | None = None
) -> DataFrame:
    """Records of mixed layouts, as variants, to ``conv_id, layout, turns``.

    A layout is selected by the fingerprint of all fields of the record, or, if
    none has it, by that of the fields that some layout knows: a record may have
    more fields. Nothing is lost where no layout fits: ``layout`` is null,
    ``conv_id`` is that of the first layout whose key field the record has, and
    the one turn has the role ``record`` and the record's text, or ``raw``. A null
    record has no turns. A key that is no whole number gives a null ``conv_id``.
    """
    known_paths = sorted({path for layout in layouts for own in layout.variants for path in own})
    value, paths = F.col("_record"), F.col("_paths")
    only_known = F.filter(paths, lambda p: p.isin(known_paths))
    marks = [F.col("_mark"), F.col("_known_mark")]

    def key_of(layout: Layout) -> Column:
        return F.try_variant_get(value, f"$.{layout.key}", "bigint")

    text = F.coalesce(raw if raw is not None else F.lit(None).cast("string"), F.to_json(value))
    turns = F.when(text.isNotNull(), F.array(_turn(F.lit(UNMAPPED), text))).otherwise(F.array().cast(TURNS))
    name = F.lit(None).cast("string")
    key = F.coalesce(*[key_of(layout) for layout in layouts])
    # the fingerprint of all fields is looked at last, so that it decides first
    for mark in reversed(marks):
        for layout in layouts:
            wanted = [fingerprint(F.array(*[F.lit(p) for p in own])) for own in layout.variants]
            fits = mark.isin(wanted) if len(wanted) > 1 else mark == wanted[0]
            name = F.when(fits, layout.name).otherwise(name)
            key = F.when(fits, key_of(layout)).otherwise(key)
            turns = F.when(fits, _mapped(value, layout)).otherwise(turns)
    return (
        records.withColumn("_record", F.col(record))
        .withColumn("_paths", F.coalesce(record_paths(value), F.array().cast("array<string>")))
        .withColumn("_mark", fingerprint(paths))
        .withColumn("_known_mark", fingerprint(only_known))
        .select(key.alias("conv_id"), name.alias("layout"), turns.alias("turns"))
    )


def turns_of_records(records: DataFrame, column: str, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """:func:`turns_of_variants` of JSON texts; a text that is no JSON is kept as it is in one turn."""
    parsed = records.select(F.col(column).alias("_raw"), F.try_parse_json(F.col(column)).alias("_parsed"))
    return turns_of_variants(parsed, "_parsed", layouts, raw=F.col("_raw"))


def records_of_rows(rows: DataFrame, key: str = "conv_id", fields: tuple[str, ...] = ("role", "text", "turn")) -> DataFrame:
    """A table of turns, a row each, as records (variants) in a column ``record``.

    A record has the key and an array ``turns`` with the ``fields`` of its rows;
    other columns are not looked at. Rows that repeat stay, rows without a key
    make one record together. A conversation is one value, so its turns meet in
    one task, however many conversations there are.
    """
    by_key = rows.groupBy(F.col(key).alias("_key")).agg(F.collect_list(F.struct(*fields)).alias("_turns"))
    record = F.struct(F.col("_key").alias(key), F.col("_turns").alias("turns"))
    return by_key.select(F.to_variant_object(record).alias("record"))


# --- the template ---------------------------------------------------------------------

OPEN, ROLE_END, CLOSE = "<|start|>", "<|text|>", "<|end|>\n"
# What must not appear inside a text: the marks above, and those of other templates.
_CONTROL = r"(<)(\||/?s>|</?SYS>>)|(\[)(/?INST\])"
# The backslash that breaks a control string stands after its first character.
_BROKEN = r"$1$3\\$2$4"


def escape(text: Column) -> Column:
    """Break control strings by a backslash; backslashes are doubled first."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _CONTROL, _BROKEN)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_turns(conversations: DataFrame, trained: str = "assistant") -> DataFrame:
    """Add ``segments``, the formatted text in pieces of ``(text, loss)``, and ``formatted``.

    The pieces joined are the formatted text. ``loss`` marks those to train on:
    the texts of the ``trained`` role, escaped, without the marks around them.
    """

    def pieces(turn: Column) -> Column:
        def piece(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        head = F.concat(F.lit(OPEN), escape(turn["role"]), F.lit(ROLE_END))
        return F.array(
            piece(head, F.lit(False)),
            piece(escape(turn["text"]), turn["role"] == trained),
            piece(F.lit(CLOSE), F.lit(False)),
        )

    with_segments = conversations.withColumn("segments", F.flatten(F.transform("turns", pieces)))
    return with_segments.withColumn("formatted", F.array_join("segments.text", ""))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as they were before it."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda b: b != "")

    def turn(block: Column) -> Column:
        parts = F.split(F.substring(block, len(OPEN) + 1, 2**31 - 1), r"<\|text\|>", 2)
        return F.struct(unescape(parts[0]).alias("role"), unescape(parts[1]).alias("text"))

    return F.transform(blocks, turn)


def read_loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
