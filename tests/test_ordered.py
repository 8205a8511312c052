"""Order-dependent operators against brute force, with one key holding most rows."""

import collections
import datetime
import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import ordered
from clickloom.sources.clicks import number_sessions

START = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def visits():
    """(event_id, user, time) rows: two thirds belong to one user, times collide."""
    rng = random.Random(7)
    return [
        (f"{i:05d}", "hot" if rng.random() < 0.67 else f"u{rng.randrange(9)}",
         START + datetime.timedelta(seconds=rng.choice([0, 1, 59, 3600]) + 60 * rng.randrange(30_000)))
        for i in range(3000)
    ]


def by_user(rows):
    grouped = collections.defaultdict(list)
    for event_id, user, at in rows:
        grouped[user].append((at, event_id))
    return {user: sorted(events) for user, events in grouped.items()}


@pytest.mark.parametrize("rows_per_slice", [10_000, 100])
def test_sequence_in_group(frame, visits, rows_per_slice):
    df = frame(visits, "event_id string, user string, at timestamp")
    got = {
        r.event_id: (r.event_sequence, r.prev_timestamp)
        for r in ordered.sequence_in_group(df, "user", "at", "event_id", rows_per_slice).collect()
    }
    expected = {}
    for events in by_user(visits).values():
        for i, (at, event_id) in enumerate(events):
            expected[event_id] = (i + 1, events[i - 1][0] if i else None)
    assert got == expected


@pytest.mark.parametrize("rows_per_slice", [10_000, 2])
def test_sequence_puts_missing_times_first(frame, rows_per_slice):
    rows = [("b", None), ("a", None), ("c", START), ("d", START + datetime.timedelta(hours=1)), ("e", START + datetime.timedelta(hours=2))]
    df = frame([(i, "u", at) for i, at in rows], "event_id string, user string, at timestamp")
    got = ordered.sequence_in_group(df, "user", "at", "event_id", rows_per_slice).orderBy("event_sequence").collect()
    assert [(r.event_id, r.prev_timestamp) for r in got] == [
        ("a", None), ("b", None), ("c", None), ("d", START), ("e", START + datetime.timedelta(hours=1))
    ]


@pytest.mark.parametrize("gap_hours", [1, 12])
def test_number_sessions(frame, visits, gap_hours):
    df = frame(visits, "event_id string, user string, at timestamp")
    got = {r.event_id: r.session_number for r in number_sessions(df, "user", "at", gap_hours).collect()}
    expected = {}
    for events in by_user(visits).values():
        number, last = 0, None
        for at, event_id in events:
            if last is None or at - last > datetime.timedelta(hours=gap_hours):
                number += 1
            expected[event_id], last = number, at
    assert got == expected


def test_shuffled_rank_is_a_permutation_and_stable(spark):
    df = spark.range(5000).select(
        F.col("id").cast("string").alias("id"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("label")
    )
    ranked = ordered.shuffled_rank(df, ["label"], "id", 1, "rank", "size")
    rows = ranked.collect()
    for label, n in ((0, 4500), (1, 500)):
        assert sorted(r["rank"] for r in rows if r.label == label) == list(range(1, n + 1))
        assert {r["size"] for r in rows if r.label == label} == {n}
    again = ordered.shuffled_rank(df.repartition(3), ["label"], "id", 1, "rank", "size").collect()
    assert {r.id: r["rank"] for r in rows} == {r.id: r["rank"] for r in again}
    assert [r.id for r in sorted(rows, key=lambda r: (r.label, r["rank"]))][:20] != sorted(r.id for r in rows)[:20]


@pytest.mark.parametrize("shape", ["spread", "one_value", "mostly_equal", "tiny"])
def test_exact_percentiles(spark, frame, shape):
    rng = random.Random(shape)
    values = {
        "spread": [rng.paretovariate(0.8) for _ in range(4000)],
        "one_value": [5.0] * 100,
        "mostly_equal": [1.0] * 900 + [rng.random() for _ in range(100)],
        "tiny": [3.0, 1.0],
    }[shape]
    wanted = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    row = ordered.exact_percentiles(frame([(v,) for v in values] + [(None,)], "v double"), "v", wanted).first()
    for name, q in wanted.items():
        assert row[name] == pytest.approx(np.percentile(values, q * 100), rel=1e-12)


def test_exact_percentiles_of_nothing(frame):
    assert ordered.exact_percentiles(frame([], "v double"), "v", {"p50": 0.5}).first().p50 is None


def test_order_bits_are_those_of_doubles(frame):
    rng = random.Random(9)
    values = [0.0, -0.0, math.inf, -math.inf, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308]
    values += [f(2.0**e) for e in range(-1073, 1024) for f in (float, lambda x: math.nextafter(x, 0), lambda x: math.nextafter(x, math.inf))]
    values += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(63)))[0] for _ in range(2000)]
    values = [s * v for v in values if not math.isnan(v) for s in (1, -1)]
    got = {(r.v, r.k) for r in frame([(v,) for v in values], "v double").select("v", ordered.order_bits(F.col("v")).alias("k")).collect()}
    for v, k in got:
        bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert k == (-bits if v < 0 else bits), v
    nan = frame([(math.nan,)], "v double").select(ordered.order_bits(F.col("v"))).first()[0]
    assert nan > max(k for _, k in got)


@pytest.mark.parametrize("last_rows", [0, 3, 10_000])
def test_order_statistics_per_group(frame, last_rows):
    """Also where values differ in their last bits only, over all passes."""
    rng = random.Random(last_rows)
    close = [1.0]
    for _ in range(60):
        close.append(math.nextafter(close[-1], 2))
    rows = [(None, v) for v in close * 3] + [("a", rng.gauss(0, 1) * 10.0 ** rng.randrange(-300, 300)) for _ in range(500)]
    rows += [("b", -7.5)] * 9 + [("c", v) for v in (math.inf, -math.inf, 0.0, -0.0, math.nan)]
    n = F.col("n")
    got = ordered.order_statistics(frame(rows, "g string, v double"), ["g"], [F.lit(0), F.floor(n / 2), n - 1], last_rows, len(rows))
    for g in (None, "a", "b", "c"):
        mine = sorted((v for k, v in rows if k == g), key=lambda v: (math.isnan(v), v))
        size, values = got[(g,)]
        assert size == len(mine)
        assert [repr(v + 0.0) for v in values] == [repr(v + 0.0) for v in (mine[0], mine[len(mine) // 2], mine[-1])]


def test_percentiles_of_several_columns(frame):
    rng = random.Random(4)
    rows = [(rng.random(), rng.choice([None, rng.gauss(0, 5)]), None) for _ in range(700)]
    named = {"a50": ("a", 0.5), "a99": ("a", 0.99), "b50": ("b", 0.5), "c50": ("c", 0.5)}
    row = ordered.column_percentiles(frame(rows, "a double, b double, c double"), named, 20).first()
    for i, c in enumerate("ab"):
        assert row[f"{c}50"] == pytest.approx(np.percentile([r[i] for r in rows if r[i] is not None], 50), rel=1e-12)
    assert row.a99 == pytest.approx(np.percentile([r[0] for r in rows], 99), rel=1e-12) and row.c50 is None


@pytest.mark.parametrize("rows_per_slice", [10_000, 50])
def test_running_totals(frame, rows_per_slice):
    rng = random.Random(3)
    rows = [(round(rng.random() ** 4, 2), rng.randrange(5)) for _ in range(3000)]
    found = ordered.running_totals(frame(rows, "s double, n long"), "s", ["n"], rows_per_slice).collect()
    assert {r.s: r.cum_n for r in found} == {s: sum(n for t, n in rows if t >= s) for s in {s for s, _ in rows}}
    falling = sorted(found, key=lambda r: -r.s)
    assert [r.next_n for r in falling] == [*[r.n for r in falling[1:]], None]


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 10.0], [4.0, 4.0], [float(i % 17) for i in range(300)]])
def test_histogram(frame, values):
    rows = ordered.histogram(frame([(v,) for v in values] + [(None,)], "v double"), "v", 8).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=8)
    assert [r.frequency for r in rows] == counts.tolist()
    assert [r.bin_start for r in rows] == pytest.approx(edges[:-1].tolist(), abs=1e-6)


def test_rollup_entities(frame):
    rng = random.Random(5)
    rows = [
        ("hot" if rng.random() < 0.6 else None, f"s{rng.randrange(40)}", f"u{rng.randrange(10)}", rng.choice("abc"), rng.randrange(9))
        for _ in range(800)
    ]
    df = frame(rows, "k string, s string, u string, t string, n long")
    got = ordered.rollup_entities(
        df, ["k"], {"s": "s", "u": "u"},
        {"sessions": ("s", None), "a_sessions": ("s", F.col("t") == "a"), "b_users": ("u", F.col("t") == "b")},
        {"total": F.col("n")},
    ).collect()
    assert len(got) == 2
    for r in got:
        mine = [x for x in rows if x[0] == r.k]
        assert r.sessions == len({x[1] for x in mine})
        assert r.a_sessions == len({x[1] for x in mine if x[3] == "a"})
        assert r.b_users == len({x[2] for x in mine if x[3] == "b"})
        assert r.total == sum(x[4] for x in mine)
