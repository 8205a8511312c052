"""Hand-made frames for the cases in which the semantics are easy to get wrong."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from clickloom.functions.exprs import percent, rounded_ratio
from clickloom.models.predictions import ltv_bands, risk_bands
from clickloom.operators import etl, warehouse as wh
from clickloom.plans import queries as q, views
from clickloom.schemas import EVENT_COLUMNS, WAREHOUSE

EVENT_DDL = ", ".join(f"{c} {t}" for c, t in EVENT_COLUMNS.items())


def at(day, hour=0, minute=0, second=0):
    return datetime.datetime(2024, 1, day, hour, minute, second)


@pytest.fixture
def events(frame):
    """Cleaned events from dicts; ids are given in order."""

    def build(*rows):
        filled = [
            tuple({"event_id": f"e{i}", "user_id": "u1", "session_id": "s1", **row}.get(c) for c in EVENT_COLUMNS)
            for i, row in enumerate(rows)
        ]
        return etl.clean_events(frame(filled, EVENT_DDL))

    return build


def test_session_over_midnight_gives_two_rows_with_the_overnight_gap(events):
    ev = events(
        {"timestamp": at(1, 23, 59, 0), "event_type": "page_view", "device": "mobile"},
        {"timestamp": at(1, 23, 59, 30), "event_type": "add_to_cart", "device": "mobile"},
        {"timestamp": at(2, 0, 0, 30), "event_type": "purchase", "device": "mobile", "cart_value": 9.5, "num_items": 2},
    )
    first, second = etl.session_metrics(ev).orderBy("event_date").collect()
    assert (first.num_events, first.session_duration_seconds, first.avg_time_between_events) == (2, 30, 15.0)
    assert (second.num_events, second.session_duration_seconds, second.avg_time_between_events) == (1, 0, 60.0)
    assert (first.converted, second.converted, second.total_cart_value, second.items_purchased) == (0, 1, 9.5, 2)
    loaded = wh.fact_sessions(etl.session_metrics(ev)).collect()
    assert [(r.session_id, r.event_date, r.converted) for r in loaded] == [("s1", datetime.date(2024, 1, 1), False)]


def test_first_event_decides_channel_and_ties_go_to_the_smaller_id(events):
    ev = events(
        {"timestamp": at(1, 1), "event_type": "page_view", "event_id": "b", "referrer": "paid_ad"},
        {"timestamp": at(1, 1), "event_type": "page_view", "event_id": "a", "referrer": "direct"},
    )
    assert etl.session_metrics(ev).first().referrer == "direct"
    rows = etl.event_sequence(ev).orderBy("event_sequence").collect()
    assert [(r.event_id, r.time_since_prev_event) for r in rows] == [("a", 0), ("b", 0)]


def test_gaps_count_whole_seconds(events):
    late = at(1, 0, 0, 1) - datetime.timedelta(microseconds=1)
    ev = events(
        {"timestamp": late, "event_type": "page_view"},
        {"timestamp": at(1, 0, 0, 1), "event_type": "page_view"},
    )
    assert etl.session_metrics(ev).first().session_duration_seconds == 1
    assert [r.time_since_prev_event for r in etl.event_sequence(ev).orderBy("event_sequence").collect()] == [0, 1]


def test_product_with_two_categories_keeps_both_rows_and_loads_one(events):
    ev = events(
        {"timestamp": at(1), "event_type": "product_click", "product_id": "p", "category": "Toys", "price": 2.0},
        {"timestamp": at(1), "event_type": "add_to_cart", "product_id": "p", "category": "Books", "price": 4.0},
    )
    metrics = etl.product_metrics(ev)
    assert {(r.category, r.click_to_cart_rate) for r in metrics.collect()} == {("Toys", 0.0), ("Books", 0.0)}
    assert [r.category for r in wh.dim_product_metrics(metrics).collect()] == ["Books"]


def test_purchase_without_amount_counts_but_does_not_price(events):
    ev = events(
        {"timestamp": at(1), "event_type": "purchase", "cart_value": 10.0},
        {"timestamp": at(1), "event_type": "purchase"},
    )
    day = etl.daily_metrics(ev).first()
    assert (day.total_purchases, day.total_revenue, day.avg_order_value, day.conversion_rate) == (2, 10.0, 10.0, 200.0)
    assert q.q01_daily_revenue_trend(etl.daily_metrics(ev)).first().avg_order_value == 5.0
    assert etl.user_metrics(ev).first().avg_revenue_per_purchase == 5.0
    # a channel made of unpriced purchases only has no revenue at all
    only = events({"timestamp": at(1), "event_type": "purchase"})
    assert views.customer_journey_funnel(only).first().total_revenue is None
    assert views.touchpoint_performance(only).first().total_revenue is None


def test_rows_without_session_or_user_are_dropped_and_bad_text_becomes_null(frame):
    raw = frame(
        [("e1", "s", "u", "2024-01-07T10:00:00", "x1"), ("e2", None, "u", "2024-01-07", "2"), ("e3", "s", None, "2024-01-07", "3"),
         ("e4", "s", "u", "not a time", "4.5")],
        "event_id string, session_id string, user_id string, timestamp string, price string",
    )
    rows = {r.event_id: r for r in etl.clean_events(raw).collect()}
    assert set(rows) == {"e1", "e4"}
    assert rows["e1"].price is None and rows["e1"].event_day_of_week == 1 and rows["e1"].event_hour == 10
    assert rows["e4"].timestamp is None and rows["e4"].price == 4.5


def test_weekday_conventions(events, frame):
    ev = events({"timestamp": at(7), "event_type": "page_view"}, {"timestamp": at(8), "event_type": "page_view"})
    assert {r.event_date.day: r.event_day_of_week for r in ev.collect()} == {7: 1, 8: 2}
    dates = wh.dim_date(etl.daily_metrics(ev))
    assert {r.day: (r.day_of_week, r.day_name, r.is_weekend) for r in dates.collect()} == {
        7: (6, "Sunday", True), 8: (0, "Monday", False)
    }
    sessions = wh.fact_sessions(etl.session_metrics(ev))
    users = wh.dim_users(etl.user_metrics(ev))
    assert views.session_analytics(sessions, users, dates).first().session_day_of_week == 0
    assert {r.day_name for r in q.q07_day_of_week(ev).collect()} == {"Sunday", "Monday"}


def test_cohort_retention_literal_and_corrected(frame):
    users = frame(
        [("a", datetime.datetime(2023, 1, 5)), ("b", datetime.datetime(2023, 1, 9))], "user_id string, first_seen timestamp"
    )
    events = frame(
        [("a", datetime.datetime(2023, 1, 5)), ("b", datetime.datetime(2023, 1, 9)), ("a", datetime.datetime(2024, 2, 1))],
        "user_id string, timestamp timestamp",
    )
    literal = {r.activity_month.year: r for r in views.cohort_retention_monthly_literal(users, events).collect()}
    assert (literal[2024].months_since_signup, literal[2024].retention_rate, literal[2024].cohort_size) == (1, 100.0, 1)
    fixed = {r.activity_month.year: r for r in views.cohort_retention_monthly(users, events).collect()}
    assert (fixed[2024].months_since_signup, fixed[2024].retention_rate, fixed[2024].cohort_size) == (13, 50.0, 2)


def test_bands_are_closed_on_the_right(frame):
    scores = frame([(v,) for v in (0.0, 0.3, 0.31, 0.7, 1.0, 1.5)], "v double")
    assert [r.risk for r in risk_bands(scores, "v").collect()] == ["Low", "Low", "Medium", "Medium", "High", None]
    values = frame([(v,) for v in (-5.0, 0.0, 50.0, 200.0, 500.0, 501.0)], "v double")
    assert [r.ltv_category for r in ltv_bands(values, "v").collect()] == ["Low", "Low", "Low", "Medium", "High", "VIP"]


def test_price_tiers_take_the_first_match(frame):
    products = frame(
        [("a", "A", "c", 49.99, 1.0), ("b", "B", "c", 50.0, 1.0), ("d", "D", "c", 150.0, 1.0), ("e", "E", "c", 500.0, 1.0), ("f", "F", "c", 500.01, 1.0)],
        "product_id string, product_name string, category string, price double, rating double",
    )
    metrics = frame(
        [(p, "c", 10, 1, 1, 0, 1, 1.0, 0.0) for p in "abdef"],
        "product_id string, category string, total_interactions long, unique_users long, unique_sessions long, "
        "num_clicks long, num_add_to_cart long, avg_price double, click_to_cart_rate double",
    )
    events = frame([], "product_id string, event_type string, cart_value double")
    rows = {r.product_id: r for r in views.product_analytics(products, metrics, events).collect()}
    assert [rows[p].price_tier for p in "abdef"] == ["Budget", "Mid-Range", "Mid-Range", "Premium", "Luxury"]
    assert (rows["a"].num_purchases, rows["a"].total_revenue, rows["a"].cart_conversion_rate) == (0, None, None)


def test_division_by_zero_is_null_and_rounding_is_half_up(frame):
    df = frame([(1, 0, 97.35, 6)], "a long, b long, x double, n long")
    row = df.select(percent("a", "b").alias("p"), rounded_ratio("x", "n").alias("r")).first()
    assert (row.p, row.r) == (None, 16.23)


def test_user_segments(frame):
    users = frame([(5, 1), (1, 1), (0, 3), (0, 2)], "total_purchases long, num_sessions long")
    assert [r.user_segment for r in etl.user_segments(users).collect()] == ["High Value", "Converted", "Engaged", "New/Inactive"]


def test_load_casts_drops_nan_and_duplicates(frame):
    rows = [("p1", "Toys", float("nan")), ("p1", "Art", 1.005), ("p2", "Art", 2.0)]
    loaded = wh.load_warehouse_table(
        frame(rows, "product_id string, category string, avg_price double"), WAREHOUSE["dim_product_metrics"]
    )
    assert loaded.columns == ["product_id", "category", "avg_price"]
    got = {r.product_id: (r.category, str(r.avg_price)) for r in loaded.collect()}
    assert got == {"p1": ("Art", "1.01"), "p2": ("Art", "2.00")}
    nan = wh.load_warehouse_table(frame(rows[:1], "product_id string, category string, avg_price double"), WAREHOUSE["dim_product_metrics"])
    assert nan.first().avg_price is None


def test_checks_find_violations(frame):
    child = frame([("1", "x"), ("1", None), ("2", "y"), ("3", "y")], "id string, ref string")
    parent = frame([("x",)], "ref string")
    assert wh.check_primary_key(child, "child", ["id"]).first().duplicate_keys == 1
    assert wh.check_foreign_key(child, parent, "child.ref", "ref", "ref").first().orphan_rows == 2
    assert {r.column_name: r.null_rows for r in wh.check_not_null(child, "child", ["id", "ref"]).collect()} == {"id": 0, "ref": 1}


def test_search_converts_only_when_the_purchase_is_later(events):
    rows = []
    for i in range(10):
        order = ("purchase", "page_view") if i < 4 else ("page_view", "purchase")
        for minute, kind in enumerate(order):
            search = {"page_type": "search", "search_query": "desk"} if kind == "page_view" else {}
            rows.append({"session_id": f"s{i}", "timestamp": at(1, 1, minute), "event_type": kind, **search})
    row = q.q22_search_effectiveness(events(*rows)).first()
    assert (row.search_count, row.sessions_with_search, row.sessions_converted_after_search, row.conversion_rate) == (10, 10, 6, 60.0)


@pytest.mark.parametrize("tile", [1000, 4])
@pytest.mark.parametrize("min_sessions", [1, 2, 5])
def test_affinity_equals_counting_all_pairs(frame, monkeypatch, min_sessions, tile):
    """Six huge sessions hold every product; the rest hold a few. One session has two users."""
    monkeypatch.setattr(views, "TILE_ITEMS", tile)
    rng = random.Random(min_sessions)
    products = [f"p{i:02d}" for i in range(25)]
    rows = []
    for s in range(80):
        chosen = products if s < 6 else rng.sample(products, rng.randrange(1, 5))
        for p in chosen:
            rows += [(f"s{s}", f"u{s % 7}", p, "add_to_cart")] * rng.choice([1, 2])
    rows += [("s9", "other", p, "add_to_cart") for p in products[:6]] + [("s9", "u2", "p00", "purchase")]
    got = {
        (r.product_a, r.product_b): (r.sessions_together, r.users_together)
        for r in views.product_affinity(
            frame(rows, "session_id string, user_id string, product_id string, event_type string"), min_sessions
        ).collect()
    }
    carts = {(s, p, u) for s, u, p, kind in rows if kind == "add_to_cart"}
    held = {}
    for s, p, u in carts:
        held.setdefault(p, {}).setdefault(s, set()).add(u)
    expected = {}
    for a, b in itertools.combinations(products, 2):
        both = set(held.get(a, {})) & set(held.get(b, {}))
        if len(both) >= min_sessions:
            expected[a, b] = (len(both), len(set().union(*(held[a][s] for s in both))))
    assert got == expected


def test_large_carts_are_paired_block_by_block(frame, monkeypatch):
    """Five carts of all products: one of them is set aside by no product, and is cut into tiles."""
    monkeypatch.setattr(views, "TILE_ITEMS", 40)
    n = 400
    rows = [(f"s{s}", f"u{s}", f"p{i:04d}", "add_to_cart") for s in range(5) for i in range(n)]
    found = views.product_affinity(frame(rows, "session_id string, user_id string, product_id string, event_type string"))
    assert found.count() == n * (n - 1) // 2
    assert {(r.sessions_together, r.users_together) for r in found.select("sessions_together", "users_together").distinct().collect()} == {(5, 5)}


def test_activity_masks_merge_and_tell_every_day(frame):
    rng = random.Random(12)
    start = datetime.datetime(2024, 1, 25)
    rows = [(f"u{rng.randrange(30)}", start + datetime.timedelta(days=rng.randrange(50), hours=rng.randrange(24))) for _ in range(600)]
    schema = "user_id string, timestamp timestamp"
    parts = [views.user_activity(frame(rows[i::3], schema)) for i in range(3)]
    merged = parts[0].union(parts[1]).union(parts[2]).groupBy("user_id", "month").agg(F.bit_or("days").alias("days"))
    users = frame([(u, min(t for v, t in rows if v == u)) for u in {u for u, _ in rows}], "user_id string, first_seen timestamp")
    got = {r.cohort_date: (r.cohort_size, r.day_0, r.day_1, r.day_7, r.day_30) for r in views.user_retention(users, activity=merged).collect()}
    active = {(u, t.date()) for u, t in rows}
    cohorts = {}
    for r in users.collect():
        cohorts.setdefault(r.first_seen.date(), []).append(r.user_id)
    assert got == {
        day: (len(us), *(sum((u, day + datetime.timedelta(days=d)) in active for u in us) for d in (0, 1, 7, 30))) for day, us in cohorts.items()
    }
    whole = {tuple(r) for r in views.user_retention(users, frame(rows, schema)).collect()}
    assert whole == {tuple(r) for r in views.user_retention(users, activity=merged).collect()}
