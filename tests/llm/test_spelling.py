import random
import re
import zlib
from collections import Counter

import pytest

from clickloom.llm import spelling


def counts(rows):
    totals = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            totals[run] += 1
    return {w: n for w, n in totals.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(totals):
    form, near = {}, {}
    for w, n in totals.items():
        others = [o for o in totals if abs(len(o) - len(w)) < 2 and one_edit(o, w)]
        near[w] = len(others)
        best = min(others, key=lambda o: (-totals[o], o), default=None)
        form[w] = best if best and totals[best] >= 10 * n else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(((w, form[w], root(w), n, near[w], totals[form[w]] if form[w] else None) for w, n in totals.items()), key=str)


def made_words(n, seed, alphabet="abé"):
    """Many words of few letters, so that most have near words and groups are large."""
    draw = random.Random(seed)
    return {"".join(draw.choices(alphabet, k=draw.randrange(5, 11))): int(10 ** draw.uniform(0, 5)) for _ in range(n)}


def test_texts_equal_brute_force(docs, spark, empty):
    draw = random.Random(3)
    base = ["wonderful", "Wonderfull", "KINDNESS", "kindnes", "größere", "grössere", "Ünterhalt", "a×b÷cdefgh", "straßenbahn", "naïveté"]
    rows = [(i, " ".join(draw.choices(base, weights=[99, 3, 60, 2, 30, 2, 5, 9, 9, 9], k=60))) for i in range(120)]
    rows += [(None, "wonderful 世界 wonderful-kindness"), (5, None), (5, ""), (6, "\n1 2"), (7, "abcdefgh" * 9000), (7, "abcdefgh" * 9000)]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, spelling.group_variants(given).collect()), key=str) == expected(counts(rows))
    messy = [(r[0], r[1]) for r in docs.collect()]
    assert sorted(map(tuple, spelling.group_variants(docs).collect()), key=str) == expected(counts(messy))
    assert spelling.group_variants(empty).count() == 0


@pytest.mark.parametrize("group, tile", [(4, 3), (60, 16), (100_000, 128)])
def test_groups_of_any_size_equal_brute_force(spark, monkeypatch, group, tile):
    monkeypatch.setattr(spelling, "GROUP", group)
    totals = made_words(900, group) | made_words(300, 1, "abcdefghijklmnop") | {"x" * 3000: 4, "x" * 3001: 50, "x" * 2999 + "y": 9}
    words = spark.createDataFrame(list(totals.items()), "word string, n long").repartition(3)
    assert sorted(map(tuple, spelling.variants(words).collect()), key=str) == expected(totals)


def test_small_tiles_and_runs_find_the_same_pairs(monkeypatch):
    monkeypatch.setattr(spelling, "TILE", 5)
    words = sorted(w for w in made_words(400, 7, "ab") if len(w) in (7, 8))
    import numpy as np

    a, b = spelling._near(words, np.zeros(len(words), dtype=np.int64), 8, 0, 0, 9)
    got = {frozenset((words[i], words[j])) for i, j in zip(a, b)}
    assert len(got) == len(a)
    assert got == {frozenset((x, y)) for x in words for y in words if max(len(x), len(y)) == 8 and one_edit(x, y)}


def test_each_pair_is_found_once_over_all_groups(spark, monkeypatch):
    monkeypatch.setattr(spelling, "GROUP", 6)
    totals = made_words(700, 11, "ab")
    words = spark.createDataFrame(list(totals.items()), "word string, n long")
    got = {r.word: r.n_near for r in spelling.near_words(words).collect()}
    assert got == {w: n for w in totals if (n := sum(one_edit(w, o) for o in totals))}
