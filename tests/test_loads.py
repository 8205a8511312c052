"""Loading tables: null keys, repeated keys, and the plans that scale depends on."""

import datetime

from pyspark.sql import functions as F

from clickloom.operators import ordered, warehouse as wh
from clickloom.plans import queries, views
from clickloom.plans.lake import Lake
from clickloom.schemas import WAREHOUSE


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_without_a_key_are_rejected_and_counted(frame):
    day = datetime.date(2024, 1, 1)
    rows = frame([(None, "u1", day), (None, "u2", day), ("s1", "u1", day), ("s1", "u3", day)], "session_id string, user_id string, event_date date")
    loaded = wh.load_warehouse_table(rows, WAREHOUSE["fact_sessions"]).collect()
    assert [(r.session_id, r.user_id) for r in loaded] == [("s1", "u1")]
    assert wh.rejected_rows(rows, "fact_sessions", WAREHOUSE["fact_sessions"]).first().rejected_rows == 2


def test_the_row_kept_does_not_depend_on_the_time_of_the_run(frame):
    rows = frame([(f"s{i % 50}", i % 2, i / 1000, i % 2, "Low") for i in range(400)],
                 "session_id string, actual_converted int, conversion_probability double, predicted_converted int, conversion_risk string")
    first, second = (wh.ml_conversion_table(rows).drop("prediction_timestamp").orderBy("session_id").collect() for _ in range(2))
    assert first == second and len(first) == 50


def test_tables_grouped_by_their_key_are_loaded_without_a_shuffle(spark, sf_dir):
    users = Lake.of(spark, sf_dir)["users"]
    assert "Aggregate" not in plan(wh.dim_users(users)) and "Join" not in plan(wh.dim_users(users))


def test_distinct_counts_expand_visits_not_events(spark, sf_dir):
    events = Lake.of(spark, sf_dir)["fact_events"]
    for df in (views.touchpoint_performance(events), queries.q06_hourly_traffic(events), queries.q08_month_over_month(events)):
        text = plan(df)
        below = text[text.index("Expand"):]
        assert "Aggregate" in below and "session_id" in below.split("Aggregate", 1)[1]


def test_event_sequence_has_one_plan_of_slices(spark, sf_dir):
    events = Lake.of(spark, sf_dir)["events"]
    for rows in (events, events.limit(10)):
        assert "_slice" in plan(ordered.sequence_in_group(rows, "session_id", "timestamp", "event_id"))


def test_purchases_without_a_product_stay_out_of_the_join(spark, sf_dir):
    lake = Lake.of(spark, sf_dir)
    bought = lake["fact_events"].withColumn("product_id", F.lit(None).cast("string"))
    history = views.user_purchase_history(bought, lake["dim_users"], lake["dim_products"])
    assert "Union" in plan(views.user_purchase_history(lake["fact_events"], lake["dim_users"], lake["dim_products"]))
    assert history.filter("product_name is not null").count() == 0 and history.count() > 0


def test_percentiles_do_not_depend_on_the_slices(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).cast("double").alias("v"))
    named = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.999, "e": 1.0}
    whole, sliced = (ordered.exact_percentiles(rows, "v", named, n).first() for n in (10**6, 50))
    assert whole == sliced and whole.c == 499.5


def test_all_rows_of_an_id_share_their_rank(frame):
    rows = frame([(f"s{i // 3}", i % 2) for i in range(300)], "id string, label int")
    ranked = ordered.shuffled_rank(rows, ["label"], "id", 1, "rank", "size", 20).collect()
    per_id = {}
    for r in ranked:
        per_id.setdefault(r.id, set()).add((r.rank, r.size))
    assert len(ranked) == 300 and all(len(v) == 1 for v in per_id.values())
    assert sorted(next(iter(v))[0] for v in per_id.values()) == list(range(1, 101))
