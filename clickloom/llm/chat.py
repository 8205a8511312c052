"""Chat formatting of records whose layout is found by a schema fingerprint.

All nested field paths that a record fills, below the columns that some layout names,
are hashed; the hash selects the mapping that was declared for this set of paths, with
or without its optional ones. A mapping says which fields are the turns, or where their
list is, and which role names stand for which. A field that no mapping knows changes
the hash, so what it says is never dropped in silence. The canonical turns are then
written with a template whose control strings cannot occur in a text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickloom.llm.frames import numbered, position


@dataclass(frozen=True)
class Layout:
    """Either ``fields``, (role, path) in order, or a ``turns`` list with its role and text fields.

    Paths lead through structs by dots. ``optional`` paths may be filled or not, ``[]`` standing
    behind a list; what stands there is not made into turns.
    """

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    turns: str = ""
    role: str = ""
    text: str = ""
    roles: dict[str, str] = field(default_factory=dict)
    optional: tuple[str, ...] = ()

    def required(self) -> list[str]:
        return [path for _, path in self.fields] if self.fields else [f"{self.turns}[]"]

    def may_be(self) -> list[str]:
        """Paths that may be filled: those of empty lists, roles and texts are not."""
        listed = [] if self.fields else [f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"]
        return [*listed, *self.optional]

    def tops(self) -> set[str]:
        return {path.split(".")[0].removesuffix("[]") for path in (*self.required(), *self.may_be())}


# Field and role names of common layouts.
LAYOUTS = [
    Layout("prompt", fields=(("user", "prompt"), ("assistant", "response"))),
    Layout("system-prompt", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("instruction", fields=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction-input", fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    # the prompt once more beside the list, and fields that say nothing of the text
    Layout("messages", turns="messages", role="role", text="content", optional=("prompt", "messages[].name", "messages[].weight")),
    Layout("conversations", turns="conversations", role="from", text="value", roles={"human": "user", "gpt": "assistant"}, optional=("conversations[].weight",)),
]

TURN_START, ROLE_END, TURN_END = "<s>[", "]", "</s>"
# Texts hold none of the characters that control strings are made of.
ESCAPES = [("\\", "\\\\"), ("<", "\\l"), ("[", "\\b"), ("]", "\\c")]


def escape(text: Column) -> Column:
    for plain, escaped in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    """Reads escapes from the left: what lies between doubled backslashes holds only the others."""

    def part(x: Column) -> Column:
        for plain, escaped in ESCAPES[1:]:
            x = F.replace(x, F.lit(escaped), F.lit(plain))
        return x

    return F.array_join(F.transform(F.split(text, "\\\\\\\\"), part), "\\")


Condition = Callable[[Column], Column]


def _of_field(condition: Condition, name: str) -> Condition:
    return lambda x: condition(x[name])


def _of_any(condition: Condition) -> Condition:
    return lambda x: F.exists(x, lambda y: condition(y))


def _fillable(kind: T.DataType, path: str) -> list[tuple[str, Condition]]:
    """Every path below a value of the type, with the condition that it is filled.

    A list is filled when it is not null, a field of its elements when any element fills it.
    """
    if isinstance(kind, T.StructType):
        return [
            (below, _of_field(condition, f.name))
            for f in kind.fields for below, condition in _fillable(f.dataType, f"{path}.{f.name}")
        ]
    if isinstance(kind, T.ArrayType):
        inner = []
        if isinstance(kind.elementType, (T.StructType, T.ArrayType)):
            inner = [(below, _of_any(condition)) for below, condition in _fillable(kind.elementType, f"{path}[]")]
        return [(f"{path}[]", lambda x: x.isNotNull()), *inner]
    return [(path, lambda x: x.isNotNull())]


def filled_paths(records: DataFrame, layouts: list[Layout]) -> Column:
    """The paths that a record fills below the columns any layout names, as a sorted array."""
    tops = set().union(*[layout.tops() for layout in layouts])
    found = []
    for i, f in enumerate(records.schema.fields):
        if f.name in tops:
            found += [(path, condition(F.col(f"_{i}"))) for path, condition in _fillable(f.dataType, f.name)]
    # a path twice: columns of one name
    named = {path: reduce(Column.__or__, [F.coalesce(c, F.lit(False)) for p, c in found if p == path]) for path, _ in found}
    return F.array_compact(F.array(*[F.when(named[path], F.lit(path)) for path in sorted(named)])) if named else F.array().cast("array<string>")


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def _at(value: Column, path: str) -> Column:
    return reduce(lambda x, name: x[name], path.split("."), value)


def _kind_at(kind: T.DataType, path: str) -> T.DataType | None:
    for name in path.split("."):
        if not isinstance(kind, T.StructType) or name not in kind.names:
            return None
        kind = kind[name].dataType
    return kind


def _turn_of(layout: Layout) -> Callable[[Column], Column]:
    """The canonical turn of an element of the layout's list."""

    def turn(x: Column) -> Column:
        role = F.coalesce(_at(x, layout.role).cast("string"), F.lit(""))
        for old, new in layout.roles.items():
            role = F.when(role == old, new).otherwise(role)
        text = F.coalesce(_at(x, layout.text).cast("string"), F.lit(""))
        return F.struct(role.alias("role"), text.alias("text"))

    return turn


def canonical(records: DataFrame, key: str, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """(key, layout, turns) with turns an array of (role, text), text never null.

    A record whose filled paths fit no layout, or those of several together, has a null
    layout and null turns. Columns that no layout names are ignored, in the fingerprint
    too; what columns of a layout hold besides is not.
    """
    at = {name: f"_{i}" for i, name in enumerate(records.columns)}
    rows = numbered(records).withColumn("_print", fingerprint(filled_paths(records, layouts)))
    known = rows.select(F.col(f"_{position(records, key)}").alias("_key"), "*")
    name, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")

    def column(path: str) -> Column:
        top, _, rest = path.partition(".")
        return _at(F.col(at[top]), rest) if rest else F.col(at[top])

    for layout in layouts:
        kinds = [_kind_at(records.schema, path.removesuffix("[]")) for path in layout.required()]
        if None in kinds:
            continue
        if layout.turns:
            listed = kinds[0]
            if not isinstance(listed, T.ArrayType) or None in [_kind_at(listed.elementType, path) for path in (layout.role, layout.text)]:
                continue
            made = F.transform(column(layout.turns), _turn_of(layout))
        else:
            made = F.array(*[F.struct(F.lit(role).alias("role"), column(path).cast("string").alias("text")) for role, path in layout.fields])
        more = layout.may_be()
        sets = [sorted({*layout.required(), *chosen}) for n in range(len(more) + 1) for chosen in combinations(more, n)]
        prints = [fingerprint(F.array(*map(F.lit, paths))) for paths in sets]
        chosen = reduce(Column.__or__, [F.col("_print") == p for p in prints])
        name, turns = F.when(chosen, layout.name).otherwise(name), F.when(chosen, made).otherwise(turns)
    return known.select(F.col("_key").alias("key"), name.alias("layout"), turns.alias("turns"))


def formatted(turns: DataFrame) -> DataFrame:
    """(key, layout, formatted, loss_runs) of canonical turns.

    loss_runs has per turn how many code points of the formatted text lie before,
    under and after the loss mask. The mask covers the texts of assistant turns.
    """
    escaped = turns.select(
        "key", "layout",
        F.transform("turns", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text"), (t["role"] == "assistant").alias("learnt"))).alias("turns"),
    )

    def runs(t: Column) -> Column:
        before, text = F.length(t["role"]) + len(TURN_START + ROLE_END), F.length(t["text"])
        learnt = t["learnt"]
        return F.struct(
            before.alias("before"), F.when(learnt, text).otherwise(0).alias("loss"),
            (F.when(learnt, 0).otherwise(text) + len(TURN_END)).alias("after"),
        )

    whole = lambda t: F.concat(F.lit(TURN_START), t["role"], F.lit(ROLE_END), t["text"], F.lit(TURN_END))
    return escaped.select(
        "key", "layout", F.array_join(F.transform("turns", whole), "").alias("formatted"), F.transform("turns", runs).alias("loss_runs")
    )


def parsed(output: DataFrame) -> DataFrame:
    """(key, turns, loss, formatted_chars) read from formatted text and its mask.

    loss is the text under the mask, unescaped, as one piece per turn.
    """
    pieces = output.select(
        "key", "loss_runs", F.length("formatted").cast("long").alias("formatted_chars"),
        F.slice(F.split("formatted", TURN_END), 1, F.greatest(F.size(F.split("formatted", TURN_END)) - 1, F.lit(0))).alias("pieces"),
    )

    def turn(x: Column) -> Column:
        parts = F.split(F.substr(x, F.lit(len(TURN_START) + 1)), "\\]")
        return F.struct(unescape(F.get(parts, 0)).alias("role"), unescape(F.get(parts, 1)).alias("text"))

    def learnt(x: Column, run: Column) -> Column:
        return unescape(F.substr(x, run["before"] + 1, run["loss"]))

    return pieces.select(
        "key", F.transform("pieces", turn).alias("turns"), F.zip_with("pieces", "loss_runs", learnt).alias("loss"), "formatted_chars"
    )
