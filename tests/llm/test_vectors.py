import numpy as np
import pytest

from clickloom.llm import vectors
from clickloom.llm.vectors import cosine, join_intervals, near_duplicates

NAN, INF = float("nan"), float("inf")


def expected(rows, least=0.93):
    usable = [
        i for i, (v, e, label) in enumerate(rows)
        if v is not None and label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)
    ]
    scaled = {i: np.array(rows[i][1], dtype=float) / max(map(abs, rows[i][1])) for i in usable}
    unit = {i: v / np.linalg.norm(v) for i, v in scaled.items()}
    group, links = list(range(len(rows))), [0] * len(rows)
    for i in usable:
        for j in usable:
            if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                old, new = group[j], group[i]
                group = [new if g == old else g for g in group]
    lowest = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in set(group)}
    found = [(r[0], n, lowest[g], r[0] is None or r[0] == lowest[g]) for r, n, g in zip(rows, links, group)]
    return sorted(found, key=str)


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(12, 8))
    found = []
    for i in range(400):
        spread = 0.0 if i % 7 == 0 else 0.35
        found.append((i * 3, (centres[i % 12] + draw.normal(size=8) * spread).tolist(), int(i % 3 > 0)))
    found += [
        (5000, None, 1), (5001, [0.0] * 8, 1), (5002, [NAN] + [1.0] * 7, 1), (5003, [INF] * 8, 1), (5004, [None, 1.0], 1), (5005, [], 1),
        (5006, [1.0, 2.0], 1), (5007, [10.0, 20.0], 1), (5008, [1.0, 2.0], None), (None, [1.0, 2.0], 1), (5006, [1.0, 2.0], 1),
        (5006, [2.0, -1.0], 1), (5009, [2.0, -1.0], 1), (5010, [-0.0, 1.0], 0), (5011, [0.0, 1.0], 0), (5012, [1e200, 1e200], 0), (5013, [1e-200, 1e-200], 0),
    ]
    return found


@pytest.mark.parametrize("block_rows, leaf", [(2048, 256), (16, 4)])
def test_messy_vectors_equal_brute_force(spark, rows, block_rows, leaf):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, row int, LABEL string")
    got = near_duplicates(df, 0.93, block_rows, leaf).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)
    assert near_duplicates(df.limit(0)).count() == 0


def test_distant_intervals_are_skipped_and_no_link_is_lost():
    draw = np.random.default_rng(3)
    a = np.sort(draw.normal(size=(300, 6)), axis=0)
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    reach = np.sqrt(2 - 2 * 0.95)
    found = {(a0 + i, b0 + j) for a0, b0, linked in join_intervals(a, a, True, 0.95, reach, 16) for i, j in zip(*np.nonzero(linked))}
    assert found == {(i, j) for i in range(300) for j in range(i + 1, 300) if a[i] @ a[j] >= 0.95}


def test_cosines_at_the_bound_are_those_of_the_given_vectors(spark):
    """Pairs whose cosine is the bound, or the next double below or above it, by the plain formula."""
    draw = np.random.default_rng(8)
    rows, least = [], None
    while len(rows) < 400:
        a = draw.integers(-9, 10, 5).astype(float)
        b = a + draw.integers(-2, 3, 5)
        if a.any() and b.any():
            rows += [(len(rows), a.tolist(), len(rows)), (len(rows) + 1, b.tolist(), len(rows))]
    values = {i: cosine(np.array(rows[i][1]), np.array(rows[i + 1][1])) for i in range(0, 400, 2)}
    for i in [k for k, v in sorted(values.items(), key=lambda kv: abs(kv[1] - 0.9))[:3]]:
        for least in (values[i], np.nextafter(values[i], 2), np.nextafter(values[i], 0)):
            df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
            got = {r.vec_id: r.n_links for r in near_duplicates(df, float(least)).collect()}
            assert got == {k + d: int(v >= least) for k, v in values.items() for d in (0, 1)}


def test_tiles_of_one_label_equal_all_pairs(spark, monkeypatch):
    """One label in many blocks, groups and levels; the leading axes alone decide little."""
    monkeypatch.setattr(vectors, "GROUP", 2)
    monkeypatch.setattr(vectors, "FANOUT", 2)
    monkeypatch.setattr(vectors, "BOX_AXES", 6)
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(150, 24))
    points = np.concatenate([centres, centres + draw.normal(size=centres.shape) * 0.28, draw.normal(size=(300, 24))])
    rows = [(i, p.tolist(), 1) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(7)
    got = sorted(map(tuple, near_duplicates(df, 0.93, 16, 8).collect()), key=str)
    assert got == expected(rows) and sum(r[1] for r in got) > 50


def test_blocks_are_sent_once_per_tile(spark):
    """Far fewer copies of blocks than pairs of them."""
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(size=32).tolist(), 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").coalesce(2)
    known = vectors.classes(df)
    axes = spark.sparkContext.broadcast(vectors.principal_axes(known, 32))
    cut = vectors.blocks(known, 32, axes, 0.37, 32)
    pairs = vectors.block_pairs(cut, 32, 0.37)
    n = cut.count()
    assert pairs.count() == pairs.select("x", "y").distinct().count() <= n * (n + 1) // 2
    sent = pairs.selectExpr("x_group", "y_group", "x AS place").union(pairs.selectExpr("x_group", "y_group", "y")).distinct().count()
    assert sent * 3 < 2 * pairs.count()
