"""Key checks of all tables in one pass against plain counting."""

import random
from collections import Counter

from pyspark.sql import functions as F

from clickloom.operators import warehouse as wh


def test_repeated_keys_of_many_tables(spark, frame):
    rng = random.Random(3)
    rows = {f"t{i}": [(rng.choice([None, f"k{rng.randrange(40 * (i + 1))}"]), rng.randrange(5)) for _ in range(200)] for i in range(4)}
    rows["unique"] = [(f"u{i}", 0) for i in range(300)]
    rows["empty"] = []
    tables = {n: (frame(r, "k string, d int"), ["k", "d"] if n == "t1" else ["k"]) for n, r in rows.items()}
    got = {r.table_name: (r.key_columns, r.duplicate_keys) for r in wh.repeated_keys(tables).collect()}
    for n, r in rows.items():
        counts = Counter(x if n == "t1" else x[0] for x in r)
        assert got[n] == ("k,d" if n == "t1" else "k", sum(c > 1 for c in counts.values()))


def test_hashes_that_meet_are_told_apart(spark, frame, monkeypatch):
    """With a hash of two values every key is suspect, and the counts stay exact."""
    monkeypatch.setattr(wh.F, "xxhash64", lambda *keys: F.length(F.concat_ws("-", *keys)) % 2)
    tables = {"t": (frame([("a",), ("b",), ("b",), ("cc",), ("dd",)], "k string"), ["k"])}
    assert wh.repeated_keys(tables).first().duplicate_keys == 1


def test_orphans_of_many_relations(frame):
    rng = random.Random(5)
    parents = {f"p{i}": {f"k{j}" for j in rng.sample(range(60), 30)} for i in range(3)}
    children = {n: [rng.choice([None, *(f"k{j}" for j in range(60))]) for _ in range(400)] for n in ("a", "b")}
    relations, expected = {}, {}
    for c, keys in children.items():
        for p, known in parents.items():
            relations[f"{c}.{p}"] = (frame([(k,) for k in keys], "ref string"), "ref", frame([(k,) for k in [*known, None]], "key string"), "key")
            expected[f"{c}.{p}"] = sum(k is not None and k not in known for k in keys)
    relations["none"] = (frame([], "ref string"), "ref", frame([("x",)], "key string"), "key")
    got = {r.relation: r.orphan_rows for r in wh.orphan_rows(relations).collect()}
    assert got == expected | {"none": 0}
