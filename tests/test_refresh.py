"""Metric tables that are brought up to date day by day equal those of a full run."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import etl

SCHEMA = (
    "event_id string, session_id string, user_id string, timestamp string, event_type string, page_type string, product_id string, "
    "category string, price double, search_query string, cart_value double, num_items int, device string, browser string, referrer string"
)
START = datetime.datetime(2024, 3, 1)


def made(n, seed, days=5):
    """Sessions that run over midnight, some of them over several days; a few events without a time."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        s = draw.randrange(25)
        at = START + datetime.timedelta(days=s % days, hours=draw.choice([1, 23, 25, 30, 50]), minutes=draw.randrange(60))
        kind = draw.choice(["page_view", "product_click", "add_to_cart", "purchase"])
        rows.append((
            f"e{seed}-{i}", f"s{s}", f"u{s % 7}", None if draw.random() < 0.02 else at.isoformat(), kind, "home", draw.choice([None, "p1", "p2", "p3"]),
            draw.choice(["a", "b"]), draw.choice([None, 2.5, 9.99]), None, 20.5 if kind == "purchase" else None, 2, "mobile", "Chrome", "direct",
        ))
    return rows


def tables(spark, paths):
    found = {}
    for name, path in paths.items():
        df = spark.read.parquet(path)
        found[name] = sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())
    return found


def day_of(df):
    return F.to_date(F.col("timestamp").cast("timestamp"))


@pytest.mark.parametrize("first", ["run_etl", "refresh_etl"])
def test_refreshed_days_equal_a_full_run(spark, tmp_path, first):
    raw = spark.createDataFrame(made(500, 1), SCHEMA)
    days = sorted({r[0] for r in raw.select(day_of(raw)).distinct().collect() if r[0]})
    base = str(tmp_path / "out")
    early = raw.filter(day_of(raw) < days[2])
    (etl.run_etl if first == "run_etl" else etl.refresh_etl)(early, base)
    for day in days[2:]:
        paths = etl.refresh_etl(raw.filter(day_of(raw) == day), base)
    paths = etl.refresh_etl(raw.filter(F.col("timestamp").isNull()), base)
    full = etl.run_etl(raw, str(tmp_path / "full"))
    assert tables(spark, paths) == tables(spark, full)
    # a day in the middle comes again, with other events: sessions that go on later change there, too
    other = spark.createDataFrame([(f"x{r[0]}", *r[1:]) for r in made(300, 2)], SCHEMA).filter(day_of(raw) == days[1])
    paths = etl.refresh_etl(other, base)
    changed = raw.filter(day_of(raw).isNull() | (day_of(raw) != days[1])).union(other)
    assert tables(spark, paths) == tables(spark, etl.run_etl(changed, str(tmp_path / "changed")))
    assert etl.refresh_etl(raw.limit(0), base) == paths


def test_only_the_days_at_hand_are_read(spark, tmp_path, monkeypatch):
    raw = spark.createDataFrame(made(400, 3), SCHEMA)
    days = sorted({r[0] for r in raw.select(day_of(raw)).distinct().collect() if r[0]})
    base = str(tmp_path / "out")
    etl.refresh_etl(raw, base)
    plans = []
    build = etl._state_tables

    def seen(ev):
        plans.append(ev._jdf.queryExecution().executedPlan().toString())
        return build(ev)

    monkeypatch.setattr(etl, "_state_tables", seen)
    etl.refresh_etl(raw.filter(day_of(raw) == days[1]), base)
    assert len(plans) == 1 and f"PartitionFilters: [(event_date" in plans[0] and str(days[1]) in plans[0].split("PartitionFilters")[1]
