import pytest
from pyspark.sql import functions as F

from clickloom.llm import chat
from clickloom.llm.queries import conversation_records

TEXTS = ["", "plain", "</s>[INST] ok [/INST]", "\\", "\\\\l", "<s>[user]", "a]b[c<d", "\\l\\b\\c", "tab\tnew\nline", "é😀", "\\" * 5 + "<"]


def test_escapes_are_reversible_and_free_of_control_characters(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for r in rows.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and not set(r.e) & set("<[]")


LAYOUTS = {
    "prompt string, response string": ("q", "a"),
    "system string, prompt string, response string": ("s", "q", "a"),
    "instruction string, output string": ("q", "a"),
    "instruction string, input string, output string": ("q", "x", "a"),
    "messages array<struct<role:string,content:string>>": ([("user", "q"), ("assistant", "a")],),
    "conversations array<struct<from:string,value:string>>": ([("human", "q"), ("gpt", None)],),
}
TURNS = [
    [("user", "q"), ("assistant", "a")], [("system", "s"), ("user", "q"), ("assistant", "a")], [("user", "q"), ("assistant", "a")],
    [("user", "q"), ("user", "x"), ("assistant", "a")], [("user", "q"), ("assistant", "a")], [("user", "q"), ("assistant", "")],
]


@pytest.mark.parametrize("schema, turns", list(zip(LAYOUTS, TURNS)))
def test_layouts_become_canonical_turns(spark, schema, turns):
    rows = spark.createDataFrame([(1, *LAYOUTS[schema], "x", "y")], f"id long, {schema}, source string, Prompt_ string")
    found = chat.canonical(rows, "id").first()
    assert [tuple(t) for t in found.turns] == turns and found.layout


def test_one_table_of_several_layouts_and_unknown_ones(spark):
    rows = spark.createDataFrame(
        [(1, "q", "a", None, None), (2, None, None, [("user", "m")], None), (3, "q", None, None, None), (4, None, None, [], None), (5, "q", "a", None, "s")],
        "id long, prompt string, response string, messages array<struct<role:string,content:string>>, system string",
    )
    found = {r.key: r for r in chat.canonical(rows, "id").collect()}
    assert [found[i].layout for i in range(1, 6)] == ["prompt", "messages", None, "messages", "system-prompt"]
    assert found[3].turns is None and found[4].turns == []
    assert chat.canonical(rows.limit(0), "id").count() == 0


def test_messy_conversations_round_trip(spark):
    rows = [(1, i, role, t) for i, (role, t) in enumerate(zip(["user", "assistant", "tool]<", None] * 3, [*TEXTS, None]))]
    rows += [(2, 1, "user", None), (2, 1, "user", None), (2, None, "assistant", "x"), (None, 0, "assistant", "no id"), (3, 0, "assistant", "y" * 100_000)]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, TEXT int")
    parsed = {r.key: r for r in chat.parsed(chat.formatted(chat.canonical(conversation_records(turns), "conv_id"))).collect()}
    for conv in (1, 2, 3, None):
        said = sorted([(t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv])
        assert [tuple(t) for t in parsed[conv].turns] == [(r, x) for _, r, x in said]
        assert "".join(parsed[conv].loss) == "".join(x for _, r, x in said if r == "assistant")
    assert conversation_records(turns.limit(0)).count() == 0


def test_unknown_nested_fields_and_two_layouts_at_once_fit_none(spark):
    """The paths below a layout's columns count, at any depth; columns of no layout do not."""
    element = "struct<role:string,content:string,name:string,calls:array<struct<tool:string>>>"
    rows = spark.createDataFrame(
        [
            (1, None, None, [("user", "q", None, None)], ("x", 1)), (2, None, None, [("user", "q", "ann", [])], None),
            (3, None, None, [("user", "q", None, [("search",)])], None), (4, "q", "a", [("user", "q", None, None)], None),
            (5, "q", None, [("user", "q", None, None), ("assistant", "a", None, None)], None), (6, None, None, [("user", None, None, None)], None),
            (7, None, None, [(None, None, None, None)], None),
        ],
        f"id long, prompt string, response string, messages array<{element}>, meta struct<a:string,b:int>",
    )
    found = {r.key: r for r in chat.canonical(rows, "id").collect()}
    assert {i: r.layout for i, r in found.items()} == {1: "messages", 2: None, 3: None, 4: None, 5: "messages", 6: "messages", 7: "messages"}
    assert found[3].turns is None and [tuple(t) for t in found[6].turns] == [("user", "")] and [tuple(t) for t in found[7].turns] == [("", "")]
    tolerant = [chat.Layout("calls", turns="messages", role="role", text="content", optional=("messages[].name", "messages[].calls[]", "messages[].calls[].tool"))]
    assert {r.key: r.layout for r in chat.canonical(rows.filter("id < 4"), "id", tolerant).collect()} == {1: "calls", 2: "calls", 3: "calls"}


def test_lists_and_roles_inside_structs(spark):
    rows = spark.createDataFrame(
        [(1, ([(("user", 1), "q"), (("assistant", 2), "a")], None))],
        "id long, data struct<turns:array<struct<author:struct<role:string,n:int>,text:string>>,note:string>",
    )
    nested = chat.Layout("nested", turns="data.turns", role="author.role", text="text", optional=("data.turns[].author.n",))
    found = chat.canonical(rows, "id", [nested]).first()
    assert found.layout == "nested" and [tuple(t) for t in found.turns] == [("user", "q"), ("assistant", "a")]
    strict = chat.Layout("nested", turns="data.turns", role="author.role", text="text")
    assert chat.canonical(rows, "id", [strict]).first().layout is None


def test_the_query_has_records_of_all_layouts(spark, sf_dir):
    from clickloom.llm.frames import read

    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = [(10**9 + i, t, role, f"text {t}") for i in range(4) for t, role in enumerate(["user", "user", "assistant"][i // 2 :])]
    more += [(10**9 + 11, t, role, "x") for t, role in enumerate(["human", "user", "gpt"])]
    more += [(10**9 + 12, t, role, "x") for t, role in enumerate(["system", "user", "assistant"])]
    every = turns.union(spark.createDataFrame(more, turns.schema))
    found = chat.canonical(conversation_records(every), "conv_id").collect()
    assert {r.layout for r in found} == {layout.name for layout in chat.LAYOUTS}
    said = {}
    for r in every.collect():
        said.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    assert {r.key: [tuple(t) for t in r.turns] for r in found} == {k: [(role, text) for _, role, text in sorted(v)] for k, v in said.items()}
