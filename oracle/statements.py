"""DuckDB statement per registered query whose result SQL can state."""

from __future__ import annotations

from oracle.base import (
    EV_COLUMNS, REFERRERS, avg_int, div, money, money0, money_avg, n_type, n_where, pct, with_tables,
)

# --- building blocks -------------------------------------------------------


def hist(rows: str, bins: int, columns: str = "", tag: str = "") -> str:
    """Equal-width histogram of column v of a derived table."""
    lead = f"'{tag}' AS model, " if tag else ""
    return f"""
SELECT {lead}b.bin::int AS bin, round(lo + b.bin * w, 6) AS bin_start, round(lo + (b.bin + 1) * w, 6) AS bin_end,
       coalesce(n, 0)::bigint AS frequency{columns}
FROM (SELECT CASE WHEN l = h THEN l - 0.5 ELSE l END AS lo,
             ((CASE WHEN l = h THEN h + 0.5 ELSE h END) - (CASE WHEN l = h THEN l - 0.5 ELSE l END)) / {bins}.0::double AS w
      FROM (SELECT min(v)::double AS l, max(v)::double AS h FROM ({rows}) WHERE v IS NOT NULL) WHERE l IS NOT NULL) edges
CROSS JOIN (SELECT unnest(range({bins})) AS bin) b
LEFT JOIN (
  SELECT least(floor((v::double - lo2) / w2)::int, {bins - 1}) AS bin, count(*) AS n
  FROM ({rows}) r,
       (SELECT CASE WHEN min(v) = max(v) THEN min(v)::double - 0.5 ELSE min(v)::double END AS lo2,
               ((CASE WHEN min(v) = max(v) THEN max(v)::double + 0.5 ELSE max(v)::double END)
                - (CASE WHEN min(v) = max(v) THEN min(v)::double - 0.5 ELSE min(v)::double END)) / {bins}.0::double AS w2
        FROM ({rows}))
  WHERE v IS NOT NULL GROUP BY 1
) c ON c.bin = b.bin"""


def metric_rows(pairs: list[tuple[str, str]], source: str, section: str | None = None) -> str:
    lead = f"'{section}' AS section, " if section else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{name}' AS metric, ({expr})::double AS value FROM {source}" for name, expr in pairs
    )


def prf(tp: str, pp: str, ap: str) -> tuple[str, str, str]:
    return (
        f"coalesce({div(tp, pp)}, 0.0)",
        f"coalesce({div(tp, ap)}, 0.0)",
        f"coalesce({div(f'2 * ({tp})', f'({pp}) + ({ap})')}, 0.0)",
    )


WEEK = "date_trunc('week', first_seen)::date"
MONTH = "date_trunc('month', first_seen)::date"
PAID = "CASE WHEN event_type = 'purchase' THEN cart_value END"
PAID_OR_0 = "CASE WHEN event_type = 'purchase' THEN cart_value ELSE 0 END"
MINUTES = "session_duration_seconds / 60.0::double"

CARTS = """
carts AS (SELECT DISTINCT session_id, product_id, user_id FROM ev WHERE event_type = 'add_to_cart'),
affinity AS (
  SELECT a.product_id AS product_a, b.product_id AS product_b,
         count(DISTINCT a.session_id) AS sessions_together, count(DISTINCT a.user_id) AS users_together
  FROM carts a JOIN carts b ON a.session_id = b.session_id AND a.product_id < b.product_id
  GROUP BY ALL HAVING count(DISTINCT a.session_id) >= 5
)"""

FUNNEL = f"""
funnel AS (
  SELECT event_date, count(DISTINCT session_id) AS total_sessions,
         count(DISTINCT session_id) FILTER (WHERE num_page_views > 0) AS sessions_with_views,
         count(DISTINCT session_id) FILTER (WHERE num_product_clicks > 0) AS sessions_with_clicks,
         count(DISTINCT session_id) FILTER (WHERE num_add_to_cart > 0) AS sessions_with_cart,
         count(DISTINCT session_id) FILTER (WHERE num_purchases > 0) AS sessions_with_purchase,
         {pct('count(DISTINCT session_id) FILTER (WHERE num_purchases > 0)', 'count(DISTINCT session_id)')} AS conversion_rate
  FROM wsess GROUP BY event_date
)"""

COHORTS = """
activity AS (
  SELECT DISTINCT user_id, date_trunc('month', timestamp)::date AS activity_month FROM ev
),
active AS (
  SELECT date_trunc('month', first_seen)::date AS cohort_month, activity_month, count(DISTINCT u.user_id) AS n
  FROM usr u JOIN activity USING (user_id) GROUP BY ALL
)"""


def sessions_with(kind: str) -> str:
    return f"count(DISTINCT session_id) FILTER (WHERE event_type = '{kind}')"


# --- sources, ETL, warehouse -----------------------------------------------


# Columns of the ETL tables by how their values are written for a digest.
WHOLE = {
    "ev": "event_id session_id user_id event_type page_type product_id category cart_size num_items payment_method device "
          "browser ip_address referrer search_query event_date event_hour event_day_of_week event_month event_year",
    "sess": "session_id user_id event_date num_events num_unique_event_types device browser referrer num_page_views "
            "num_product_clicks num_add_to_cart num_purchases items_purchased session_duration_seconds converted",
    "prod": "product_id category total_interactions unique_users unique_sessions num_clicks num_add_to_cart",
    "usr": "user_id num_sessions total_events num_active_days total_purchases unique_products_viewed days_active user_segment",
    "daily": "event_date total_events unique_users unique_sessions total_purchases",
}
FRACTIONS = {
    "ev": "price cart_value", "sess": "total_cart_value avg_time_between_events", "prod": "avg_price click_to_cart_rate",
    "usr": "total_revenue avg_events_per_session avg_revenue_per_purchase",
    "daily": "total_revenue avg_order_value conversion_rate",
}
TIMES = {"ev": "timestamp", "sess": "session_start session_end", "prod": "", "usr": "first_seen last_seen", "daily": ""}


def digests(tables: tuple[tuple[str, str], ...]) -> str:
    """Per table and column: rows, known values and the sum of a hash of every value."""
    rows = []
    for name, cte in tables:
        texts = {c: f"{c}::varchar" for c in WHOLE[cte].split()}
        texts |= {c: f"round({c}::double * 10000)::bigint::varchar" for c in FRACTIONS[cte].split()}
        texts |= {c: f"epoch_us({c})::varchar" for c in TIMES[cte].split()}
        rows += [
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) AS num_rows, count({c}) AS num_known, "
            f"sum(('0x' || substr(md5({t}), 1, 7))::bigint)::bigint AS digest FROM {cte}"
            for c, t in texts.items()
        ]
    return " UNION ALL ".join(rows)


def _sources() -> dict[str, str]:
    etl = (
        ("fact_events", "ev"), ("fact_sessions", "sess"), ("dim_product_metrics", "prod"),
        ("dim_user_metrics", "usr"), ("fact_daily_metrics", "daily"),
    )
    found = digests((("fact_sessions", "sess"), ("dim_user_metrics", "usr"), ("fact_daily_metrics", "daily")))
    return {
        "read_events_csv": f"SELECT {EV_COLUMNS} FROM ev",
        "read_events_json": f"SELECT {EV_COLUMNS} FROM ev",
        "read_product_catalog": "SELECT * FROM catalog",
        "read_parquet_table": "SELECT event_date, count(*) AS num_rows, min(timestamp) AS first_at, "
                              "max(timestamp) AS last_at FROM ev GROUP BY event_date",
        "read_metric_tables": found,
        "read_sessions_users": digests((("sessions", "sess"), ("users", "usr"))),
        "write_parquet": "SELECT * FROM sess",
        "run_etl": digests(etl),
        "refresh_etl": digests(etl),
        "load_warehouse_table": "SELECT * FROM wsess",
        "write_features": _conversion_features(),
        "write_predictions": "SELECT * FROM conv",
        "write_metrics": _regression(),
    }


def _etl() -> dict[str, str]:
    return {
        "clean_events": "SELECT * FROM ev",
        "event_sequence": "SELECT event_id, session_id, timestamp, event_sequence, prev_timestamp, "
                          "time_since_prev_event FROM seq",
        "session_metrics": "SELECT * FROM sess",
        "product_metrics": "SELECT * FROM prod",
        "user_metrics": "SELECT * EXCLUDE (user_segment) FROM usr",
        "user_segments": "SELECT user_id, num_sessions, total_purchases, user_segment FROM usr",
        "daily_metrics": "SELECT * FROM daily ORDER BY event_date",
        "insight_last7_days": "SELECT * FROM daily ORDER BY event_date DESC LIMIT 7",
        "insight_segment_distribution":
            f"SELECT user_segment, count(*) AS num_users, {money('total_revenue')} AS total_revenue FROM usr GROUP BY 1",
        "insight_top10_products":
            "SELECT * FROM prod ORDER BY total_interactions DESC, product_id, category LIMIT 10",
        "insight_session_conversion": f"""
SELECT count(*) AS total_sessions, sum(converted)::bigint AS converted_sessions,
       rnd({avg_int('converted')} * 100, 2) AS conversion_rate_pct,
       rnd({avg_int('session_duration_seconds')}, 2) AS avg_session_duration,
       rnd({avg_int('num_events')}, 2) AS avg_events_per_session FROM sess""",
    }


def _warehouse() -> dict[str, str]:
    keys = (
        ("dim_users", "usr", "user_id"), ("dim_products", "catalog", "product_id"),
        ("dim_product_metrics", "wprod", "product_id"), ("dim_date", "days", "date_key"),
        ("fact_events", "ev", "event_id"), ("fact_sessions", "wsess", "session_id"),
        ("fact_daily_metrics", "wdaily", "metric_date"),
        ("dim_device", "(SELECT DISTINCT device AS device_type, browser FROM ev)", "device_type,browser"),
        ("ml_conversion_predictions", "conv", "session_id"), ("ml_churn_predictions", "churn", "user_id"),
        ("ml_ltv_predictions", "ltv", "user_id"),
    )
    links = (
        ("dim_product_metrics.product_id", "wprod", "product_id", "catalog", "product_id"),
        ("fact_events.user_id", "ev", "user_id", "usr", "user_id"),
        ("fact_events.product_id", "ev", "product_id", "catalog", "product_id"),
        ("fact_events.event_date", "ev", "event_date", "days", "date_key"),
        ("fact_sessions.user_id", "wsess", "user_id", "usr", "user_id"),
        ("fact_sessions.event_date", "wsess", "event_date", "days", "date_key"),
        ("fact_daily_metrics.metric_date", "wdaily", "metric_date", "days", "date_key"),
        ("ml_conversion_predictions.session_id", "conv", "session_id", "wsess", "session_id"),
        ("ml_churn_predictions.user_id", "churn", "user_id", "usr", "user_id"),
        ("ml_ltv_predictions.user_id", "ltv", "user_id", "usr", "user_id"),
    )
    required = (
        ("fact_events", "ev", ("session_id", "user_id", "timestamp", "event_date", "event_type")),
        ("fact_sessions", "wsess", ("user_id", "event_date", "session_start", "session_end")),
    )
    return {
        "dim_date": "SELECT * FROM days",
        "dim_users": "SELECT * FROM usr",
        "dim_products": "SELECT * FROM catalog",
        "dim_product_metrics": "SELECT * FROM wprod",
        "dim_device": "SELECT row_number() OVER (ORDER BY device, browser)::int AS device_id, device AS device_type, "
                      "browser FROM (SELECT DISTINCT device, browser FROM ev)",
        "fact_events": "SELECT * FROM ev",
        "fact_sessions": "SELECT * FROM wsess",
        "fact_daily_metrics": "SELECT * FROM wdaily",
        "agg_product_daily": f"""
SELECT product_id, event_date AS metric_date, {n_type('page_view')} AS num_views,
       {n_type('product_click')} AS num_clicks, {n_type('add_to_cart')} AS num_add_to_cart,
       {n_type('purchase')} AS num_purchases, {money0(PAID)} AS revenue, count(DISTINCT user_id) AS unique_users
FROM ev WHERE product_id IS NOT NULL GROUP BY product_id, event_date""",
        "agg_user_weekly": f"""
SELECT user_id, date_trunc('week', event_date)::date AS week_start_date, count(DISTINCT session_id) AS num_sessions,
       count(*) AS num_events, {n_type('purchase')} AS num_purchases, {money0(PAID)} AS total_spent
FROM ev GROUP BY 1, 2""",
        "agg_category_metrics": f"""
SELECT p.category, count(DISTINCT p.product_id) AS total_products, {n_type('page_view')} AS total_views,
       {n_type('product_click')} AS total_clicks, {n_type('add_to_cart')} AS total_add_to_cart,
       {n_type('purchase')} AS total_purchases, {money0(PAID)} AS total_revenue,
       any_value(m.avg_price) AS avg_price, {pct(n_type('purchase'), n_type('product_click'))} AS conversion_rate
FROM catalog p LEFT JOIN ev e ON e.product_id = p.product_id
JOIN (SELECT category, rnd({money_avg('price')}, 2) AS avg_price FROM catalog GROUP BY 1) m ON m.category = p.category
GROUP BY p.category""",
        "ml_prediction_tables_conversion_from_scores": """
SELECT session_id, rnd(conversion_probability, 4) AS conversion_probability, predicted_converted = 1 AS predicted_converted,
       conversion_risk, actual_converted = 1 AS actual_converted FROM conv""",
        "ml_prediction_tables_churn_from_scores": """
SELECT user_id, rnd(churn_probability, 4) AS churn_probability, predicted_churned = 1 AS predicted_churned, churn_risk,
       rnd(retention_priority, 2) AS retention_priority_score, actual_churned = 1 AS actual_churned FROM churn""",
        "ml_prediction_tables_ltv_from_scores": """
SELECT user_id, rnd(predicted_ltv_90days, 2) AS predicted_ltv_90days, ltv_category,
       rnd(actual_revenue, 2) AS actual_revenue FROM ltv""",
        "check_primary_keys": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{k}' AS key_columns, count(*) AS duplicate_keys FROM "
            f"(SELECT {k} FROM {cte} GROUP BY ALL HAVING count(*) > 1)" for t, cte, k in keys
        ),
        "check_foreign_keys": " UNION ALL ".join(
            f"SELECT '{name}' AS relation, count(*) AS orphan_rows FROM {child} c WHERE c.{col} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{col})"
            for name, child, col, parent, key in links
        ),
        "check_not_null": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, {n_where(f'{c} IS NULL')} AS null_rows FROM {cte}"
            for t, cte, cols in required for c in cols
        ),
    }


# The ladders of levels and buckets run from the top here and from the bottom in Spark,
# so that a slip in one limit shows.

# --- views -----------------------------------------------------------------


def _views() -> dict[str, str]:
    lost = "num_purchases = 0"
    return {
        "user_purchase_history": """
SELECT e.user_id, u.user_segment, e.timestamp, e.session_id, e.product_id, c.product_name, c.category,
       e.cart_value, e.num_items, e.payment_method
FROM ev e JOIN usr u USING (user_id) LEFT JOIN catalog c ON c.product_id = e.product_id
WHERE e.event_type = 'purchase'""",
        "session_funnel": "SELECT * FROM funnel",
        "product_affinity": "SELECT * FROM affinity",
        "user_retention": """
SELECT u.first_seen::date AS cohort_date, count(DISTINCT u.user_id) AS cohort_size,
       count(DISTINCT u.user_id) FILTER (WHERE e.event_date = u.first_seen::date) AS day_0,
       count(DISTINCT u.user_id) FILTER (WHERE e.event_date = u.first_seen::date + 1) AS day_1,
       count(DISTINCT u.user_id) FILTER (WHERE e.event_date = u.first_seen::date + 7) AS day_7,
       count(DISTINCT u.user_id) FILTER (WHERE e.event_date = u.first_seen::date + 30) AS day_30
FROM usr u LEFT JOIN ev e USING (user_id) GROUP BY 1""",
        "customer_journey_funnel": f"""
SELECT event_date, device, browser, referrer, total_sessions, step_1_page_view, step_2_product_click,
       step_3_add_to_cart, step_4_checkout, step_5_purchase,
       {pct('step_2_product_click', 'step_1_page_view')} AS pv_to_click_rate,
       {pct('step_3_add_to_cart', 'step_2_product_click')} AS click_to_cart_rate,
       {pct('step_4_checkout', 'step_3_add_to_cart')} AS cart_to_checkout_rate,
       {pct('step_5_purchase', 'step_4_checkout')} AS checkout_to_purchase_rate,
       {pct('step_5_purchase', 'total_sessions')} AS overall_conversion_rate,
       step_1_page_view - step_2_product_click AS dropoff_step_1_to_2,
       step_2_product_click - step_3_add_to_cart AS dropoff_step_2_to_3,
       step_3_add_to_cart - step_4_checkout AS dropoff_step_3_to_4,
       step_4_checkout - step_5_purchase AS dropoff_step_4_to_5,
       total_revenue, rnd({div('total_revenue', 'step_5_purchase')}, 2) AS avg_order_value,
       users_step_1, users_step_5
FROM (
  SELECT event_date, device, browser, referrer, count(DISTINCT session_id) AS total_sessions,
         {sessions_with('page_view')} AS step_1_page_view, {sessions_with('product_click')} AS step_2_product_click,
         {sessions_with('add_to_cart')} AS step_3_add_to_cart, {sessions_with('checkout')} AS step_4_checkout,
         {sessions_with('purchase')} AS step_5_purchase, {money(PAID_OR_0)} AS total_revenue,
         count(DISTINCT user_id) FILTER (WHERE event_type = 'page_view') AS users_step_1,
         count(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS users_step_5
  FROM ev GROUP BY ALL
)""",
        "session_analytics": f"""
SELECT s.session_id, s.user_id, u.user_segment, s.event_date, d.day_name, d.is_weekend, s.session_start,
       s.session_end, s.session_duration_seconds, rnd({MINUTES}, 2) AS session_duration_minutes,
       s.device, s.browser, s.referrer, s.num_events, s.num_unique_event_types, s.avg_time_between_events,
       CASE WHEN s.num_events > 15 THEN 'High Engagement' WHEN s.num_events >= 6 THEN 'Medium Engagement'
            WHEN s.num_events >= 2 THEN 'Low Engagement' ELSE 'Bounce' END AS engagement_level,
       s.num_page_views, s.num_product_clicks, s.num_add_to_cart, s.num_purchases, s.converted,
       s.num_add_to_cart > 0 AND s.num_purchases = 0 AS cart_abandoned, s.total_cart_value, s.items_purchased,
       rnd({div('s.total_cart_value', 's.items_purchased')}, 2) AS avg_item_price,
       least(100, s.num_events * 5 + s.num_unique_event_types * 10 + CASE WHEN s.converted THEN 50 ELSE 0 END)::bigint
         AS session_quality_score,
       hour(s.session_start)::int AS session_hour, dayofweek(s.session_start)::int AS session_day_of_week
FROM wsess s JOIN usr u USING (user_id) JOIN days d ON d.date_key = s.event_date""",
        "user_segment_performance": f"""
SELECT user_segment, count(*) AS total_users, sum(num_sessions)::bigint AS total_sessions,
       sum(total_events)::bigint AS total_events,
       rnd({money_avg('avg_events_per_session')}, 2) AS avg_events_per_session,
       rnd({avg_int('num_active_days')}, 2) AS avg_active_days, sum(total_purchases)::bigint AS total_purchases,
       {money('total_revenue')} AS total_revenue, rnd({money_avg('total_revenue')}, 2) AS avg_revenue_per_user,
       rnd({money_avg('avg_revenue_per_purchase')}, 2) AS avg_order_value,
       {pct(n_where('total_purchases > 0'), 'count(*)')} AS user_conversion_rate,
       rnd({avg_int('unique_products_viewed')}, 2) AS avg_products_viewed,
       {pct('count(*)', '(SELECT count(*) FROM usr)')} AS segment_share_pct,
       {pct(money('total_revenue'), f"(SELECT {money('total_revenue')} FROM usr)")} AS revenue_share_pct
FROM usr GROUP BY user_segment""",
        "cohort_retention_monthly_literal": f"""
SELECT cohort_month, n AS cohort_size, activity_month,
       (datediff('month', cohort_month, activity_month) % 12)::int AS months_since_signup,
       n AS active_users, {pct('n', 'n')} AS retention_rate FROM active""",
        "cohort_retention_monthly": f"""
SELECT cohort_month, c.cohort_size, activity_month,
       datediff('month', cohort_month, activity_month)::int AS months_since_signup,
       n AS active_users, {pct('n', 'c.cohort_size')} AS retention_rate
FROM active JOIN (SELECT {MONTH} AS cohort_month, count(*) AS cohort_size FROM usr GROUP BY 1) c USING (cohort_month)""",
        "touchpoint_performance": f"""
SELECT event_date, device AS touchpoint_device, browser AS touchpoint_browser, referrer AS touchpoint_referrer,
       count(*) AS total_interactions, count(DISTINCT session_id) AS unique_sessions,
       count(DISTINCT user_id) AS unique_users, {n_type('page_view')} AS page_views,
       {n_type('product_click')} AS product_clicks, {n_type('add_to_cart')} AS add_to_carts,
       {n_type('purchase')} AS purchases, {pct(n_type('purchase'), 'count(DISTINCT session_id)')} AS session_conversion_rate,
       {money(PAID_OR_0)} AS total_revenue, rnd({money_avg(PAID)}, 2) AS avg_order_value,
       rnd({div(n_where("event_type <> 'page_view'"), 'count(*)')} * 100, 2) AS engagement_rate
FROM ev GROUP BY event_date, device, browser, referrer""",
        "executive_kpis": f"""
SELECT metric_date, day_name, is_weekend, total_events, unique_users, unique_sessions, total_purchases, total_revenue,
       avg_order_value, conversion_rate, rnd({div('total_revenue', 'unique_users')}, 2) AS revenue_per_user,
       rnd({div('total_events', 'unique_sessions')}, 2) AS events_per_session,
       rnd({div('total_purchases', 'unique_sessions')} * 100, 2) AS purchase_rate,
       {pct('unique_users - lag(unique_users, 7) OVER o', 'lag(unique_users, 7) OVER o')} AS users_wow_change_pct,
       {pct('total_revenue - lag(total_revenue, 7) OVER o', 'lag(total_revenue, 7) OVER o')} AS revenue_wow_change_pct,
       rnd(conversion_rate - lag(conversion_rate, 7) OVER o, 2) AS conversion_wow_change_pp,
       rnd(sum(total_revenue::decimal(18,2)) OVER w::double / count(*) OVER w, 2) AS revenue_7day_ma,
       rnd(sum(unique_users) OVER w::double / count(*) OVER w, 2) AS users_7day_ma
FROM wdaily JOIN days ON date_key = metric_date
WINDOW o AS (ORDER BY metric_date), w AS (ORDER BY metric_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
        "product_analytics": f"""
SELECT c.product_id, c.product_name, c.category, c.price, c.rating, m.total_interactions, m.unique_users,
       m.unique_sessions, m.num_clicks, m.num_add_to_cart, m.click_to_cart_rate,
       coalesce(s.num_purchases, 0) AS num_purchases, s.total_revenue,
       {pct('m.num_clicks', 'm.total_interactions')} AS click_through_rate,
       {pct('m.num_add_to_cart', 'm.num_clicks')} AS cart_conversion_rate,
       rnd(m.total_interactions * 0.3::double + m.unique_users * 0.4::double + m.num_clicks * 0.3::double, 2) AS engagement_score,
       CASE WHEN c.price < 50 THEN 'Budget' WHEN c.price <= 150 THEN 'Mid-Range' WHEN c.price <= 500 THEN 'Premium'
            ELSE 'Luxury' END AS price_tier,
       CASE WHEN m.total_interactions > 1.5 * a.mean THEN 'Top Performer' WHEN m.total_interactions > a.mean THEN 'Above Average'
            WHEN m.total_interactions > 0.5 * a.mean THEN 'Average' ELSE 'Underperforming' END AS performance_tier
FROM catalog c JOIN wprod m USING (product_id)
LEFT JOIN (SELECT product_id, count(*) AS num_purchases, {money('cart_value')} AS total_revenue
           FROM ev WHERE event_type = 'purchase' GROUP BY 1) s USING (product_id),
     (SELECT {avg_int('total_interactions')} AS mean FROM wprod) a""",
        "cart_abandonment": f"""
SELECT event_date, device, browser, user_segment, count(*) AS total_cart_sessions,
       {n_where(lost)} AS abandoned_sessions, {n_where(f'NOT {lost}')} AS completed_sessions,
       {money(f'CASE WHEN {lost} THEN total_cart_value ELSE 0 END')} AS potential_lost_revenue,
       rnd({money_avg(f'CASE WHEN {lost} THEN total_cart_value END')}, 2) AS avg_abandoned_cart_value,
       rnd({avg_int(f'CASE WHEN {lost} THEN session_duration_seconds END')}, 2) AS avg_abandoned_session_duration,
       rnd({avg_int(f'CASE WHEN {lost} THEN num_add_to_cart END')}, 2) AS avg_items_in_abandoned_cart,
       {pct(n_where(lost), 'count(*)')} AS abandonment_rate
FROM wsess JOIN usr USING (user_id) WHERE num_add_to_cart > 0
GROUP BY event_date, device, browser, user_segment""",
        "cart_abandonment_value": f"""
SELECT started AS event_date, count(*) AS abandoned_sessions, sum(items)::bigint AS abandoned_items,
       {money('value')} AS abandoned_value
FROM (SELECT session_id, min(event_date) AS started, count(*) AS items, {money0('price')} AS value
      FROM ev a WHERE event_type = 'add_to_cart'
        AND NOT EXISTS (SELECT 1 FROM ev b WHERE b.session_id = a.session_id AND b.event_type = 'purchase')
      GROUP BY session_id)
GROUP BY 1""",
        "ml_performance_summary_from_scores": f"""
SELECT 'Conversion' AS model_name, count(*) AS total_predictions, round(avg(conversion_probability), 6) AS avg_probability,
       {div(n_where('predicted_converted = actual_converted'), 'count(*)')} AS accuracy FROM conv
UNION ALL SELECT 'Churn', count(*), round(avg(churn_probability), 6), {div(n_where('predicted_churned = actual_churned'), 'count(*)')} FROM churn
UNION ALL SELECT 'LTV', count(*), round(avg(predicted_ltv_90days), 6), NULL::double FROM ltv""",
    }


# --- analytical queries ----------------------------------------------------


def _queries() -> dict[str, str]:
    converted = n_where("converted")
    return {
        "q01_daily_revenue_trend": f"""
SELECT event_date, total_events, unique_users, unique_sessions, total_purchases, total_revenue,
       rnd({div('total_revenue', 'total_purchases')}, 2) AS avg_order_value, conversion_rate
FROM daily ORDER BY event_date DESC LIMIT 30""",
        "q02_segment_distribution": f"""
SELECT user_segment, count(*) AS num_users, sum(total_purchases)::bigint AS total_purchases,
       {money('total_revenue')} AS total_revenue, rnd({money_avg('total_revenue')}, 2) AS avg_revenue_per_user,
       rnd({avg_int('num_sessions')}, 2) AS avg_sessions_per_user
FROM usr GROUP BY user_segment""",
        "q03_top20_products": """
SELECT product_id, c.product_name, c.category, m.total_interactions, m.unique_users, m.num_add_to_cart,
       m.click_to_cart_rate, c.price
FROM wprod m JOIN catalog c USING (product_id) ORDER BY m.total_interactions DESC, product_id LIMIT 20""",
        "q04_session_funnel_rates": f"""
SELECT event_date, total_sessions, sessions_with_views, sessions_with_clicks, sessions_with_cart, sessions_with_purchase,
       {pct('sessions_with_clicks', 'sessions_with_views')} AS view_to_click_rate,
       {pct('sessions_with_cart', 'sessions_with_clicks')} AS click_to_cart_rate,
       {pct('sessions_with_purchase', 'sessions_with_cart')} AS cart_to_purchase_rate,
       conversion_rate AS overall_conversion_rate FROM funnel""",
        "q05_event_funnel": f"""
SELECT pv AS page_views, pc AS product_clicks, {pct('pc', 'pv')} AS pv_to_click_rate, ac AS add_to_cart,
       {pct('ac', 'pc')} AS click_to_cart_rate, co AS checkout, {pct('co', 'ac')} AS cart_to_checkout_rate,
       pu AS purchase, {pct('pu', 'co')} AS checkout_to_purchase_rate
FROM (SELECT {sessions_with('page_view')} AS pv, {sessions_with('product_click')} AS pc,
             {sessions_with('add_to_cart')} AS ac, {sessions_with('checkout')} AS co,
             {sessions_with('purchase')} AS pu FROM ev)""",
        "q06_hourly_traffic": f"""
SELECT event_hour, count(*) AS num_events, count(DISTINCT user_id) AS unique_users,
       count(DISTINCT session_id) AS unique_sessions, {n_type('purchase')} AS purchases FROM ev GROUP BY 1""",
        "q07_day_of_week": f"""
SELECT dayname(event_date) AS day_name, count(DISTINCT session_id) AS sessions, {n_type('purchase')} AS purchases,
       {money(PAID_OR_0)} AS revenue FROM ev GROUP BY 1""",
        "q08_month_over_month": f"""
SELECT event_year, event_month, unique_users, sessions, purchases, rnd(revenue, 2) AS revenue,
       {pct('revenue - lag(revenue) OVER o', 'lag(revenue) OVER o')} AS revenue_growth_pct
FROM (SELECT event_year, event_month, count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS sessions,
             {n_type('purchase')} AS purchases, {money(PAID_OR_0)} AS revenue FROM ev GROUP BY 1, 2)
WINDOW o AS (ORDER BY event_year, event_month)""",
        "q09_weekly_cohorts": f"""
SELECT {WEEK} AS cohort_week, count(*) AS cohort_size, rnd({avg_int('num_sessions')}, 2) AS avg_sessions,
       rnd({money_avg('total_revenue')}, 2) AS avg_revenue, {n_where('total_purchases > 0')} AS converted_users
FROM usr GROUP BY 1""",
        "q10_purchase_frequency_cohorts": f"""
SELECT {MONTH} AS cohort_month, count(*) AS total_users, {n_where('total_purchases = 0')} AS zero_purchases,
       {n_where('total_purchases = 1')} AS one_purchase, {n_where('total_purchases >= 2 AND total_purchases <= 5')} AS two_to_five,
       {n_where('total_purchases > 5')} AS more_than_five FROM usr GROUP BY 1""",
        "q11_category_performance": f"""
SELECT category, count(*) AS num_products, sum(total_interactions)::bigint AS total_interactions,
       sum(unique_users)::bigint AS total_unique_users, sum(num_add_to_cart)::bigint AS total_add_to_cart,
       rnd(sum(click_to_cart_rate::decimal(18,4))::double / count(*), 4) AS avg_click_to_cart_rate,
       rnd({money_avg('avg_price')}, 2) AS avg_product_price FROM wprod GROUP BY category""",
        "q12_product_affinity_named": """
SELECT a.product_name AS product_a, b.product_name AS product_b, sessions_together, users_together
FROM affinity f JOIN catalog a ON a.product_id = f.product_a JOIN catalog b ON b.product_id = f.product_b
ORDER BY sessions_together DESC, f.product_a, f.product_b LIMIT 20""",
        "q13_abandoned_cart_products": f"""
SELECT product_id, product_name, c.category, count(*) AS times_added_to_cart, {n_where('NOT bought')} AS times_abandoned,
       {pct(n_where('NOT bought'), 'count(*)')} AS abandonment_rate
FROM (SELECT DISTINCT session_id, product_id,
             session_id IN (SELECT session_id FROM ev WHERE event_type = 'purchase') AS bought
      FROM ev WHERE event_type = 'add_to_cart') JOIN catalog c USING (product_id)
GROUP BY product_id, product_name, c.category HAVING count(*) >= 10
ORDER BY times_abandoned DESC, product_id LIMIT 20""",
        "q14_session_duration_buckets": f"""
SELECT CASE WHEN session_duration_seconds >= 1800 THEN '>30 min' WHEN session_duration_seconds >= 900 THEN '15-30 min'
            WHEN session_duration_seconds >= 300 THEN '5-15 min' WHEN session_duration_seconds >= 60 THEN '1-5 min'
            ELSE '<1 min' END AS duration_bucket,
       count(*) AS num_sessions, {converted} AS converted_sessions, {pct(converted, 'count(*)')} AS conversion_rate
FROM wsess GROUP BY 1""",
        "q15_device_browser": f"""
SELECT device, browser, count(*) AS sessions, count(DISTINCT user_id) AS unique_users, {converted} AS conversions,
       {pct(converted, 'count(*)')} AS conversion_rate,
       rnd({avg_int('session_duration_seconds')}, 2) AS avg_session_duration FROM wsess GROUP BY 1, 2""",
        "q16_referrer": f"""
SELECT referrer, count(*) AS sessions, count(DISTINCT user_id) AS unique_users, {converted} AS conversions,
       {pct(converted, 'count(*)')} AS conversion_rate, {money('total_cart_value')} AS total_revenue,
       rnd({avg_int('num_events')}, 2) AS avg_events_per_session FROM wsess GROUP BY 1""",
        "q17_top5_per_category": """
SELECT c.category, product_id, product_name, m.total_interactions, m.unique_users,
       row_number() OVER (PARTITION BY c.category ORDER BY m.total_interactions DESC, product_id)::int AS rank
FROM wprod m JOIN catalog c USING (product_id) QUALIFY rank <= 5""",
        "q18_running_revenue": """
SELECT event_date, total_revenue, sum(total_revenue::decimal(18,2)) OVER (ORDER BY event_date)::double AS cumulative_revenue,
       round(sum(total_revenue::decimal(18,2)) OVER w::double / count(*) OVER w, 6) AS revenue_7day_ma
FROM daily WINDOW w AS (ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
        "q19_ltv_percentiles": "SELECT " + ", ".join(
            f"round(quantile_cont(total_revenue, {p}), 6) AS {name}"
            for name, p in (("p25_ltv", 0.25), ("median_ltv", 0.5), ("p75_ltv", 0.75), ("p90_ltv", 0.9), ("p95_ltv", 0.95))
        ) + ", max(total_revenue) AS max_ltv FROM usr WHERE total_revenue > 0",
        "q20_ltv_by_acquisition": f"""
SELECT f.referrer AS acquisition_source, count(*) AS acquired_users, {money('total_revenue')} AS total_ltv,
       rnd({money_avg('total_revenue')}, 2) AS avg_ltv, rnd({avg_int('num_sessions')}, 2) AS avg_sessions,
       rnd({avg_int('total_purchases')}, 2) AS avg_purchases
FROM (SELECT user_id, referrer FROM wsess
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY session_start, session_id) = 1) f
JOIN usr USING (user_id) GROUP BY 1""",
        "q21_time_to_first_purchase": f"""
SELECT CASE WHEN d > 30 THEN '>30 days' WHEN d > 7 THEN '8-30 days' WHEN d > 1 THEN '2-7 days' WHEN d = 1 THEN '1 day'
            ELSE 'Same day' END AS time_to_purchase,
       count(*) AS num_users, rnd({money_avg('total_revenue')}, 2) AS avg_revenue
FROM (SELECT u.user_id, u.total_revenue, datediff('day', u.first_seen::date, min(e.event_date)) AS d
      FROM usr u JOIN ev e USING (user_id) WHERE e.event_type = 'purchase' GROUP BY u.user_id, u.total_revenue, u.first_seen)
GROUP BY 1""",
        "q22_search_effectiveness": f"""
SELECT search_query, count(*) AS search_count, count(DISTINCT session_id) AS sessions_with_search,
       count(DISTINCT session_id) FILTER (WHERE later) AS sessions_converted_after_search,
       {pct('count(DISTINCT session_id) FILTER (WHERE later)', 'count(DISTINCT session_id)')} AS conversion_rate
FROM (SELECT s.search_query, s.session_id,
             EXISTS (SELECT 1 FROM ev b WHERE b.session_id = s.session_id AND b.event_type = 'purchase'
                     AND b.timestamp > s.timestamp) AS later
      FROM ev s WHERE s.page_type = 'search' AND s.search_query IS NOT NULL)
GROUP BY 1 HAVING count(DISTINCT session_id) >= 10 ORDER BY search_count DESC, search_query LIMIT 20""",
    }


# --- questions and SQL text ------------------------------------------------

# Words that may not occur outside string literals, in order of report.
FORBIDDEN = [
    "INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "TRUNCATE", "CREATE", "GRANT",
    "REVOKE", "EXEC", "EXECUTE", "CALL", "COPY", "VACUUM", "REINDEX", "CLUSTER",
]

REPLIES = """(
  SELECT conv_id, turn, CASE (coalesce(conv_id, 0) + coalesce(turn, 0)) % 6
    WHEN 0 THEN '```sql' || chr(10) || 'SELECT * FROM dim_users WHERE note = ''' || replace(t, '''', '') || ''';' || chr(10) || '```'
    WHEN 1 THEN t || chr(10) || 'SELECT device, COUNT(*)' || chr(10) || 'FROM fact_sessions GROUP BY device;'
    WHEN 2 THEN 'DROP TABLE dim_users -- ' || t
    WHEN 3 THEN 'SELECT 1; SELECT ''' || replace(t, '''', '') || ''''
    WHEN 4 THEN 'WITH t AS (SELECT 1) ' || t || ' delete grant'
    ELSE 'Note: ' || t END AS reply
  FROM (SELECT conv_id, turn, coalesce(text, '') AS t FROM conversations))"""


def _questions() -> dict[str, str]:
    bought = "FROM ev e JOIN catalog c ON c.product_id = e.product_id WHERE e.event_type = 'purchase'"
    kpis = ("SELECT metric_date, unique_users, unique_sessions, total_purchases, rnd(total_revenue, 2) AS total_revenue, "
            "conversion_rate FROM wdaily ORDER BY metric_date")
    bad_words = " ".join(
        f"WHEN regexp_matches(code, '(?i)\\b{w}\\b') THEN 'Forbidden SQL keyword detected: {w}'" for w in FORBIDDEN
    )
    return {
        "ask_top10_products_by_revenue": f"""
SELECT e.product_id, c.product_name, c.category, rnd({money('cart_value')}, 2) AS total_revenue {bought}
GROUP BY ALL ORDER BY total_revenue DESC NULLS LAST, e.product_id LIMIT 10""",
        "ask_conversion_by_device": f"""
SELECT device, count(*) AS total_sessions, {n_where('converted')} AS converted_sessions,
       {pct(n_where('converted'), 'count(*)')} AS conversion_rate FROM wsess GROUP BY 1""",
        "ask_users_per_segment":
            f"SELECT user_segment, count(*) AS num_users, rnd({money('total_revenue')}, 2) AS total_revenue FROM usr GROUP BY 1",
        "ask_daily_revenue_trend": kpis,
        "ask_daily_revenue_trend_last7": kpis + " DESC LIMIT 7",
        "ask_avg_duration_by_browser":
            f"SELECT browser, rnd({avg_int('session_duration_seconds')}, 2) AS avg_session_duration FROM wsess GROUP BY 1",
        "ask_top5_categories_by_purchases":
            f"SELECT c.category, count(*) AS num_purchases {bought} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
        "ask_revenue_by_category": f"SELECT c.category, {money('cart_value')} AS total_revenue {bought} GROUP BY 1",
        "ask_vip_predicted_ltv_from_scores": f"""
SELECT count(*) AS vip_users, {money('predicted_ltv_90days')} AS total_predicted_ltv,
       rnd({money_avg('predicted_ltv_90days')}, 2) AS avg_predicted_ltv FROM ltv WHERE ltv_category = 'VIP'""",
        "ask_highest_churn_risk_from_scores": """
SELECT c.user_id, u.user_segment, rnd(churn_probability, 4) AS churn_probability, churn_risk,
       rnd(retention_priority, 2) AS retention_priority
FROM churn c JOIN usr u USING (user_id) ORDER BY churn_probability DESC, c.user_id LIMIT 20""",
        "limit_result": "SELECT * FROM usr ORDER BY user_id LIMIT 100",
        "extract_sql": f"""
SELECT conv_id, turn, reply, regexp_replace(CASE WHEN regexp_matches(u, '(?i)^(select|with)') OR inside = '' THEN u ELSE inside END,
                                            '\\s*;*\\s*(```)?\\s*$', '') AS sql
FROM (SELECT *, regexp_extract(u, '(?is)(select|with)\\s+\\S.*') AS inside
      FROM (SELECT *, regexp_replace(regexp_replace(reply, '^\\s+', ''), '^```(sql)?\\s*', '') AS u FROM {REPLIES}))""",
        "validate_sql_text": f"""
SELECT conv_id, turn, reply, reason = '' AS is_valid, reason
FROM (SELECT conv_id, turn, reply,
        CASE WHEN flat = '' THEN 'Empty SQL query'
             WHEN upper(split_part(flat, ' ', 1)) NOT IN ('SELECT', 'WITH')
               THEN 'Query must start with SELECT or WITH, got: ' || upper(split_part(flat, ' ', 1))
             {bad_words}
             WHEN len(list_filter(string_split(code, ';'), lambda p: trim(p) <> '')) > 1 THEN 'Multiple SQL statements not allowed'
             ELSE '' END AS reason
      FROM (SELECT *, regexp_replace(flat, '''[^'']*''', '''''', 'g') AS code
            FROM (SELECT *, trim(regexp_replace(reply, '\\s+', ' ', 'g')) AS flat FROM {REPLIES})))""",
    }


# --- dashboards ------------------------------------------------------------

NUMERIC_DAILY = (
    "total_events", "unique_users", "unique_sessions", "total_purchases",
    "total_revenue", "avg_order_value", "conversion_rate",
)


def _dashboards() -> dict[str, str]:
    minutes = f"SELECT {MINUTES} AS v FROM sess WHERE {MINUTES} < "
    describe = " UNION ALL ".join(
        f"SELECT '{c}' AS metric, count({c}) AS count, round(avg({c}::double), 6) AS mean, "
        f"round(stddev_samp({c}::double), 6) AS std, round(min({c})::double, 6) AS min, "
        f"round(quantile_cont({c}::double, 0.25), 6) AS p25, round(quantile_cont({c}::double, 0.5), 6) AS p50, "
        f"round(quantile_cont({c}::double, 0.75), 6) AS p75, round(max({c})::double, 6) AS max FROM daily"
        for c in NUMERIC_DAILY
    )
    share = f"SELECT user_segment, count(*) AS num_users, {pct('count(*)', '(SELECT count(*) FROM usr)', 1)} AS share_pct FROM usr GROUP BY 1"
    report = " UNION ALL ".join([
        metric_rows([
            ("total_revenue", money("total_revenue")), ("total_purchases", "sum(total_purchases)"),
            ("avg_conversion_rate", f"rnd({money_avg('conversion_rate')}, 2)"),
        ], "daily", "overall"),
        metric_rows([
            ("total_users", "count(*)"), ("avg_sessions_per_user", f"rnd({avg_int('num_sessions')}, 2)"),
            ("avg_revenue_per_user", f"rnd({money_avg('total_revenue')}, 2)"),
        ], "usr", "users"),
        f"SELECT 'users', 'users in segment: ' || user_segment, num_users::double FROM ({share})",
        f"SELECT 'users', 'percent in segment: ' || user_segment, share_pct FROM ({share})",
        metric_rows([
            ("total_sessions", "count(*)"), ("avg_events_per_session", f"rnd({avg_int('num_events')}, 2)"),
            ("avg_session_minutes", f"rnd({avg_int('session_duration_seconds')} / 60, 2)"),
            ("conversion_rate", f"rnd({avg_int('converted')} * 100, 2)"),
        ], "sess", "sessions"),
        metric_rows([
            ("total_products", "count(*)"),
            ("avg_interactions_per_product", f"rnd({avg_int('total_interactions')}, 2)"),
        ], "prod", "products"),
        "SELECT 'products', 'top product: ' || product_id, total_interactions::double FROM "
        "(SELECT * FROM prod ORDER BY total_interactions DESC, product_id, category LIMIT 5)",
    ])
    risky = "churn WHERE churn_risk = 'High' AND total_revenue > 200"
    vip = "ltv WHERE ltv_category = 'VIP'"
    return {
        "dash_daily_trends": "SELECT event_date, unique_users, unique_sessions, total_revenue, conversion_rate, "
                             "round(avg_order_value, 6) AS avg_order_value FROM daily",
        "dash_segment_share": share,
        "dash_segment_revenue": f"SELECT user_segment, {money('total_revenue')} AS total_revenue FROM usr GROUP BY 1",
        "dash_duration_histogram": hist(minutes + "60", 30),
        "dash_events_histogram": hist("SELECT num_events AS v FROM sess WHERE num_events < 50", 30),
        "dash_sessions_by_device": "SELECT device, count(*) AS num_sessions FROM sess GROUP BY 1",
        "dash_conversion_by_device": f"SELECT device, round({avg_int('converted')} * 100, 6) AS conversion_rate FROM sess GROUP BY 1",
        "dash_top15_products": "SELECT product_id, category, total_interactions FROM prod "
                               "ORDER BY total_interactions DESC, product_id, category LIMIT 15",
        "dash_category_interactions": "SELECT category, sum(total_interactions)::bigint AS total_interactions FROM prod GROUP BY 1",
        "dash_click_to_cart_histogram": hist("SELECT click_to_cart_rate AS v FROM prod WHERE click_to_cart_rate > 0", 30),
        "dash_ltv_actual_vs_predicted_from_scores":
            "SELECT user_id, actual_revenue, predicted_ltv_90days FROM ltv ORDER BY md5(user_id || '-42'), user_id LIMIT 1000",
        "dash_price_interactions_sample":
            "SELECT product_id, category, round(avg_price, 6) AS avg_price, total_interactions, unique_users FROM prod "
            "ORDER BY md5(product_id || '-42'), product_id, category LIMIT 1000",
        "report_summary": report,
        "nb_overall_metrics": f"""
SELECT {money('total_revenue')} AS total_revenue, sum(total_purchases)::bigint AS total_purchases,
       rnd({money_avg('total_revenue')}, 2) AS avg_daily_revenue,
       rnd({money_avg('conversion_rate')}, 2) AS avg_conversion_rate,
       rnd(avg(avg_order_value), 2) AS avg_order_value FROM daily""",
        "nb_describe_daily": describe,
        "nb_duration_histogram_median": hist(
            minutes + "30", 50, f", (SELECT round(quantile_cont({MINUTES}, 0.5), 6) FROM sess) AS median_minutes"),
        "nb_category_performance": """
SELECT category, sum(total_interactions)::bigint AS total_interactions, sum(unique_users)::bigint AS unique_users,
       sum(num_add_to_cart)::bigint AS num_add_to_cart,
       round(sum(click_to_cart_rate::decimal(18,4))::double / count(*), 6) AS click_to_cart_rate FROM prod GROUP BY 1""",
        "nb_conversion_by_device": f"""
SELECT device, count(*) AS sessions, sum(converted)::bigint AS converted,
       round({div('sum(converted)', 'count(*)')} * 100, 6) AS conversion_rate FROM sess GROUP BY 1""",
        "nb_key_insights": f"""
SELECT (SELECT user_segment FROM usr GROUP BY 1 ORDER BY {money('total_revenue')} DESC, 1 LIMIT 1) AS top_segment,
       rnd({avg_int('session_duration_seconds')} / 60, 2) AS avg_session_minutes,
       rnd({avg_int('converted')} * 100, 2) AS conversion_rate,
       (SELECT category FROM prod GROUP BY 1 ORDER BY sum(total_interactions) DESC, 1 LIMIT 1) AS top_category,
       (SELECT device FROM sess GROUP BY 1 ORDER BY {avg_int('converted')} DESC, 1 LIMIT 1) AS best_device
FROM sess""",
        "dash_probability_histogram_from_scores":
            hist("SELECT conversion_probability AS v FROM conv", 50, tag="conversion")
            + " UNION ALL " + hist("SELECT churn_probability AS v FROM churn", 50, tag="churn"),
        "dash_risk_counts_from_scores": """
SELECT 'conversion' AS model, conversion_risk AS risk, count(*) AS num_rows FROM conv GROUP BY 2
UNION ALL SELECT 'churn', churn_risk, count(*) FROM churn GROUP BY 2""",
        "dash_ltv_categories_from_scores": "SELECT ltv_category, count(*) AS num_users FROM ltv GROUP BY 1",
        "nb_actual_conversion_by_risk_from_scores":
            f"SELECT conversion_risk, round({avg_int('actual_converted')} * 100, 6) AS actual_conversion_rate FROM conv GROUP BY 1",
        "nb_retention_priority_histogram_from_scores": hist("SELECT retention_priority AS v FROM churn", 50),
        "nb_avg_ltv_by_category_from_scores":
            "SELECT ltv_category, rnd(avg(predicted_ltv_90days), 4) AS avg_predicted_ltv FROM ltv GROUP BY 1",
        "nb_retention_targets_from_scores": f"""
SELECT user_id, churn_probability, total_revenue, retention_priority, (SELECT count(*) FROM {risky}) AS num_targets,
       (SELECT {money('total_revenue')} FROM {risky}) AS revenue_at_risk
FROM {risky} ORDER BY retention_priority DESC, user_id LIMIT 20""",
        "nb_high_probability_sessions_from_scores": f"""
SELECT count(*) AS num_sessions, rnd({avg_int('actual_converted')} * 100, 1) AS actual_conversion_rate
FROM conv WHERE conversion_probability > 0.7::double""",
        "nb_vip_customers_from_scores": f"""
SELECT user_id, actual_revenue, predicted_ltv_90days, ltv_category, (SELECT count(*) FROM {vip}) AS num_vip,
       (SELECT {money('predicted_ltv_90days')} FROM {vip}) AS vip_revenue,
       (SELECT rnd({money_avg('predicted_ltv_90days')}, 2) FROM {vip}) AS avg_vip_ltv
FROM {vip} ORDER BY predicted_ltv_90days DESC, user_id LIMIT 10""",
    }


# --- models ----------------------------------------------------------------


def dummies(column: str, prefix: str, levels: list[str]) -> str:
    return ", ".join(f"CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END::int AS \"{prefix}_{v}\"" for v in sorted(levels))


DEVICES = ["desktop", "mobile", "tablet"]
BROWSERS = ["Chrome", "Edge", "Firefox", "Safari"]
SEGMENTS = ["Converted", "Engaged", "High Value"]


def _conversion_features() -> str:
    plain = ", ".join(
        f"{c}::double AS {c}" for c in (
            "num_events", "num_page_views", "num_product_clicks", "num_add_to_cart", "session_duration_seconds",
            "avg_time_between_events", "num_unique_event_types",
        )
    )
    return f"""
SELECT session_id, {plain}, num_events / (greatest(session_duration_seconds, 1) / 60.0::double) AS events_per_minute,
       num_add_to_cart::double / greatest(num_product_clicks, 1) AS cart_to_click_ratio,
       {dummies('device', 'device', DEVICES)}, {dummies('browser', 'browser', BROWSERS)},
       {dummies('referrer', 'referrer', REFERRERS)}, converted AS label
FROM sess"""


def _regression() -> str:
    return f"""
SELECT metric, round(value, 9) AS value FROM (
  {metric_rows([
      ('rmse', 'sqrt(avg((actual - predicted) ** 2))'),
      ('mae', 'avg(abs(actual - predicted))'),
      ('r2', '1 - sum((actual - predicted) ** 2) / (var_pop(actual) * count(*))'),
      ('mape', 'coalesce(avg(abs((actual - predicted) / actual)) FILTER (WHERE actual <> 0), 0) * 100'),
  ], 'fits')})"""


def _models() -> dict[str, str]:
    since = "floor((epoch_us((SELECT max(last_seen) FROM usr)) - epoch_us({})) / 86400000000)::bigint"
    segments = dummies("user_segment", "segment", SEGMENTS)
    as_double = lambda *names: ", ".join(f"{n}::double AS {n}" for n in names)
    precision, recall, f1 = prf(
        n_where("actual = 1 AND predicted = 1"), n_where("predicted = 1"), n_where("actual = 1")
    )
    report = []
    for c in (0, 1):
        p, r, f = prf(n_where(f"actual = {c} AND predicted = {c}"), n_where(f"predicted = {c}"), n_where(f"actual = {c}"))
        report.append(f"SELECT '{c}' AS class_name, {p} AS precision, {r} AS recall, {f} AS f1_score, "
                      f"{n_where(f'actual = {c}')} AS support FROM scores")
    per_class = " UNION ALL ".join(report)
    weighted = ", ".join(f"sum({m} * support) / sum(support)" for m in ("precision", "recall", "f1_score"))
    return {
        "conversion_features": _conversion_features(),
        "churn_features": f"""
SELECT user_id, {as_double('num_sessions', 'total_events', 'num_active_days', 'avg_events_per_session')},
       {since.format('last_seen')}::double AS days_since_last_seen,
       {as_double('total_purchases', 'total_revenue', 'avg_revenue_per_purchase', 'unique_products_viewed', 'days_active')},
       total_purchases::double / greatest(num_sessions, 1) AS purchase_frequency,
       num_sessions * avg_events_per_session / greatest(days_active, 1) AS engagement_score,
       {segments}, ({since.format('last_seen')} > 7)::int AS label
FROM usr""",
        "ltv_features": f"""
SELECT user_id, {as_double('num_sessions', 'total_events', 'num_active_days', 'total_purchases',
                           'unique_products_viewed', 'days_active', 'avg_events_per_session')},
       total_revenue / greatest(num_sessions, 1) AS revenue_per_session,
       total_purchases::double / greatest(num_sessions, 1) AS purchase_rate,
       {since.format('first_seen')}::double AS days_since_first_seen,
       unique_products_viewed::double / greatest(total_events, 1) AS product_diversity,
       {segments}, total_revenue AS label
FROM usr""",
        "one_hot": f"SELECT session_id, event_date, {dummies('device', 'device', DEVICES)} FROM sess",
        "balanced_weights": """
SELECT converted AS label, (SELECT count(*) FROM sess)::double / ((SELECT count(DISTINCT converted) FROM sess) * count(*)) AS weight
FROM sess GROUP BY 1""",
        "train_test_split": """
SELECT s.session_id, s.converted AS label, t.is_test
FROM sess s JOIN (
  SELECT session_id, row_number() OVER (PARTITION BY label ORDER BY md5(session_id || '-42'), session_id)
                       <= round(count(*) OVER (PARTITION BY label) * 0.2::double) AS is_test
  FROM (SELECT session_id, max(converted) AS label FROM sess GROUP BY 1)) t USING (session_id)""",
        "prediction_actuals": """
SELECT 'conversion' AS model, session_id AS id, converted::double AS actual FROM sess
UNION ALL SELECT 'churn', user_id, (date_diff('microsecond', last_seen, (SELECT max(last_seen) FROM usr)) // 86400000000 > 7)::int::double FROM usr
UNION ALL SELECT 'ltv', user_id, total_revenue FROM usr""",
        "model_properties": """
SELECT * FROM (WITH ids AS (
  SELECT 'conversion' AS model, session_id AS id, max(converted) AS class, count(*) AS n FROM sess GROUP BY ALL
  UNION ALL SELECT 'churn', user_id, (date_diff('microsecond', last_seen, (SELECT max(last_seen) FROM usr)) // 86400000000 > 7)::int, 1 FROM usr
  UNION ALL SELECT 'ltv', user_id, 0, 1 FROM usr
),
split AS (
  SELECT model, n, row_number() OVER (PARTITION BY model, class ORDER BY md5(id || '-42'), id)
                     <= round(count(*) OVER (PARTITION BY model, class) * 0.2::double) AS is_test FROM ids
),
dummies AS (
  SELECT 'conversion' AS model, 9 + (SELECT count(DISTINCT device) + count(DISTINCT browser) + count(DISTINCT referrer) FROM sess) AS n
  UNION ALL SELECT 'churn', 12 + (SELECT count(DISTINCT user_segment) FROM usr)
  UNION ALL SELECT 'ltv', 11 + (SELECT count(DISTINCT user_segment) FROM usr)
)
SELECT model, 'test_size' AS property, (sum(n) FILTER (WHERE is_test))::double AS value FROM split GROUP BY 1
UNION ALL SELECT model, 'train_size', (sum(n) FILTER (WHERE NOT is_test))::double FROM split GROUP BY 1
UNION ALL SELECT model, 'features', n::double FROM dummies
UNION ALL SELECT model, 'importance_sum', 1.0::double FROM dummies
UNION ALL SELECT model, 'reload_difference', 0.0::double FROM dummies
UNION ALL SELECT model, 'metric_difference', 0.0::double FROM dummies
UNION ALL SELECT model, 'scores_out_of_range', 0.0::double FROM dummies WHERE model <> 'ltv')""",
        "classification_metrics": f"""
SELECT metric, round(value, 9) AS value FROM (
  {metric_rows([('accuracy', div(n_where('actual = predicted'), 'count(*)')), ('precision', precision),
                ('recall', recall), ('f1', f1)], 'scores')}
  UNION ALL
  SELECT 'roc_auc', sum(neg * (above + pos / 2.0::double))::double / (sum(pos)::double * sum(neg)::double)
  FROM (SELECT score, sum(actual) AS pos, sum(1 - actual) AS neg,
               coalesce(sum(sum(actual)) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
        FROM scores GROUP BY score))""",
        "confusion_matrix": f"""
SELECT a.c::int AS actual, p.c::int AS predicted,
       (SELECT count(*) FROM scores s WHERE s.actual = a.c AND s.predicted = p.c) AS num_rows
FROM (VALUES (0), (1)) a(c), (VALUES (0), (1)) p(c)""",
        "classification_report": f"""
SELECT class_name, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1_score, 9) AS f1_score,
       support::bigint AS support
FROM ({per_class}
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM ({per_class})
      UNION ALL SELECT 'weighted avg', {weighted}, sum(support) FROM ({per_class}))""",
        "roc_curve": """
SELECT threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM (
  SELECT score AS threshold, fp::double / (SELECT count(*) FROM scores WHERE actual = 0) AS fpr,
         tp::double / (SELECT count(*) FROM scores WHERE actual = 1) AS tpr
  FROM (SELECT *, lag(fp) OVER w AS fp0, lead(fp) OVER w AS fp2, lag(tp) OVER w AS tp0, lead(tp) OVER w AS tp2
        FROM (SELECT score, sum(sum(1 - actual)) OVER (ORDER BY score DESC) AS fp, sum(sum(actual)) OVER (ORDER BY score DESC) AS tp
              FROM scores GROUP BY score)
        WINDOW w AS (ORDER BY score DESC))
  WHERE fp0 IS NULL OR fp2 IS NULL OR fp2 - 2 * fp + fp0 <> 0 OR tp2 - 2 * tp + tp0 <> 0
  UNION ALL SELECT 'infinity'::double, 0.0, 0.0)""",
        "regression_metrics": _regression(),
        "residual_histogram": hist("SELECT round(actual - predicted, 6) AS v FROM fits", 30),
        "risk_bands": "SELECT session_id AS id, conversion_probability AS score, conversion_risk AS risk FROM conv",
        "ltv_bands": "SELECT user_id, predicted_ltv_90days AS predicted, ltv_category FROM ltv",
        "conversion_predictions_from_scores": "SELECT * FROM conv",
        "churn_predictions_from_scores": "SELECT * FROM churn",
        "ltv_predictions_from_scores": "SELECT * FROM ltv",
    }


EXTRA = {
    "product_affinity": CARTS,
    "q12_product_affinity_named": CARTS,
    "session_funnel": FUNNEL,
    "q04_session_funnel_rates": FUNNEL,
    "cohort_retention_monthly_literal": COHORTS,
    "cohort_retention_monthly": COHORTS,
}


def all_statements() -> dict[str, str]:
    selects: dict[str, str] = {}
    for group in (_sources, _etl, _warehouse, _views, _queries, _questions, _dashboards, _models):
        selects.update(group())
    return {name: with_tables(sql.strip(), EXTRA.get(name, "").strip()) for name, sql in selects.items()}
