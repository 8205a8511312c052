import random

import xxhash

from clickloom.llm import simhash


def fingerprint(text, size=3):
    """Bit by bit, as the definition says."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def expected(rows, distance=3):
    """(doc_id, fingerprint, component_id) by all pairs."""
    fps = [fingerprint(text) for _, text in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    lowest = {g: min((r[0] for r, h in zip(rows, group) if h == g and r[0] is not None), default=None) for g in group}
    return sorted(((r[0], f"{fp:016x}", lowest[g]) for r, fp, g in zip(rows, fps, group)), key=str)


def near_copies(n, edits, seed):
    """Texts that drift apart: every copy changes a word of the one before."""
    draw = random.Random(seed)
    words = [f"w{draw.randrange(10**6)}" for _ in range(400)]
    rows = []
    for i in range(n):
        rows.append((1000 + 3 * i, " ".join(words)))
        for _ in range(edits):
            words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
    return rows


def test_messy_rows_equal_brute_force(docs, empty):
    rows = [(r[0], r[1]) for r in docs.collect()]
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    assert got == expected(rows)
    assert simhash.near_duplicates(empty).count() == 0


def test_large_group_in_blocks_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 24)
    rows = near_copies(150, 2, 1) + near_copies(60, 9, 2) + [(i, f"unlike text number {i * 7919}") for i in range(100)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_index_keys_find_every_pair_within_three_bits(spark):
    draw = random.Random(5)
    pairs = []
    for _ in range(300):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), draw.randrange(1, 4)):
            b ^= 1 << bit
        pairs.append((a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b))
    fps = spark.createDataFrame([(x,) for p in pairs for x in p], "fp long").distinct()
    tied = {(r.a, r.b) for r in simhash.links(fps, 3).collect()}
    assert all((min(p, key=lambda x: x % (1 << 64)), max(p, key=lambda x: x % (1 << 64))) in {tuple(sorted(t, key=lambda x: x % (1 << 64))) for t in tied} for p in pairs)


def test_keep_one_keeps_the_smallest_of_each_group(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = sorted([(r[0], r[1]) for r in kept.collect()], key=str)
    whole = {(r[0], r[1]) for r in docs.collect()}
    lowest = {c for _, _, c in expected([(r[0], r[1]) for r in docs.collect()])}
    assert len(rows) == len(set(rows)) and set(rows) <= whole
    assert {doc_id for doc_id, _ in rows} == lowest


def test_one_row_stays_of_components_with_null_or_repeated_ids(spark):
    rows = [(None, "one two three four"), (None, "One two three four"), (5, "x y z"), (5, "X y z"), (6, "X y z")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id for r in kept), key=str) == [5, None]
