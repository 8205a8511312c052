"""Common table expressions that rebuild the click tables in DuckDB.

They are written independently of the Spark code: sessions come from plain
windows over all events, metrics from one-step aggregates.
"""

from __future__ import annotations


def pct(n: str, d: str, digits: int = 2) -> str:
    return f"rnd(100.0::double * ({n})::double / nullif(({d})::double, 0), {digits})"


def div(n: str, d: str) -> str:
    return f"(({n})::double / nullif(({d})::double, 0))"


def money(x: str) -> str:
    return f"(sum(({x})::decimal(18,2))::double)"


def money0(x: str) -> str:
    return f"(coalesce(sum(({x})::decimal(18,2)), 0)::double)"


def money_avg(x: str) -> str:
    return f"({money(x)} / nullif(count({x}), 0))"


def avg_int(x: str) -> str:
    return f"(sum({x})::double / nullif(count({x}), 0))"


def n_where(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def n_type(kind: str) -> str:
    return n_where(f"event_type = '{kind}'")


def choose(index: str, values: list[str]) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[({index}) + 1]"


# The domains of the derived columns.
PAGES = ["home", "category", "product", "cart", "checkout", "account", "search"]
REFERRERS = [
    "direct", "google.com", "facebook.com", "instagram.com",
    "twitter.com", "email_campaign", "organic_search", "paid_ad",
]
TERMS = [
    "laptop", "headphones", "shoes", "book", "camera",
    "phone", "watch", "desk", "chair", "backpack",
]

EV_COLUMNS = (
    "event_id, session_id, user_id, timestamp, event_type, page_type, product_id, category, price, "
    "cart_size, cart_value, num_items, payment_method, device, browser, ip_address, referrer, search_query"
)

CTES = f"""
clicks AS (
  SELECT event_id, user_id, value, regexp_extract(props, '[0-9]+')::int AS k,
         ts + to_days((20 * (user_id % 6))::int) AS happened,
         CASE event_type
           WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_click'
           WHEN 'signup' THEN 'add_to_cart' WHEN 'error' THEN 'checkout'
           WHEN 'purchase' THEN CASE WHEN user_id % 4 = 0 OR event_id % 8 = 0
                                     THEN 'purchase' ELSE 'remove_from_cart' END
         END AS kind
  FROM events
),
paused AS (
  SELECT *, coalesce(epoch_us(happened) - epoch_us(lag(happened) OVER w) <= 43200000000, false) AS goes_on
  FROM clicks WINDOW w AS (PARTITION BY user_id ORDER BY happened, event_id)
),
visits AS (
  SELECT *, count(*) FILTER (WHERE NOT goes_on)
              OVER (PARTITION BY user_id ORDER BY happened, event_id ROWS UNBOUNDED PRECEDING) AS nth,
         CASE WHEN kind IN ('product_click', 'add_to_cart', 'remove_from_cart', 'purchase')
              THEN (CASE WHEN k < 60 THEN k % 20 ELSE event_id % (SELECT count(*) FROM part) END)::varchar END AS pid,
         kind = 'purchase' AND k % 10 <> 0 AS paid
  FROM paused
),
catalog AS (
  SELECT p_partkey::varchar AS product_id, p_name AS product_name, p_type AS category,
         p_retailprice AS price, (p_size * 10)::int AS stock_quantity,
         (1 + p_partkey % 5)::double AS rating, (p_partkey * 7)::int AS num_reviews
  FROM part
),
ev AS (
  SELECT v.event_id::varchar AS event_id, v.user_id::varchar || '-' || v.nth::varchar AS session_id,
         v.user_id::varchar AS user_id, v.happened AS timestamp, v.kind AS event_type,
         {choose('v.event_id % 7', PAGES)} AS page_type,
         v.pid AS product_id, c.category, c.price,
         CASE WHEN v.kind IN ('add_to_cart', 'remove_from_cart') THEN 1 + v.k % 4 END::int AS cart_size,
         CASE WHEN v.paid THEN v.value END AS cart_value,
         CASE WHEN v.paid THEN 1 + v.event_id % 5 END::int AS num_items,
         CASE WHEN v.paid THEN {choose('v.event_id % 4', ['credit_card', 'debit_card', 'paypal', 'apple_pay'])} END AS payment_method,
         {choose('v.user_id % 3', ['desktop', 'mobile', 'tablet'])} AS device,
         {choose('v.user_id % 4', ['Chrome', 'Firefox', 'Safari', 'Edge'])} AS browser,
         '10.0.' || (v.user_id % 256)::varchar || '.1' AS ip_address,
         {choose('v.event_id % 8', REFERRERS)} AS referrer,
         CASE WHEN v.event_id % 7 = 6 THEN {choose('v.k % 10', TERMS)} || ' ' || (v.event_id % 5)::varchar END AS search_query,
         v.happened::date AS event_date, hour(v.happened)::int AS event_hour,
         (dayofweek(v.happened) + 1)::int AS event_day_of_week,
         month(v.happened)::int AS event_month, year(v.happened)::int AS event_year
  FROM visits v LEFT JOIN catalog c ON c.product_id = v.pid
),
seq AS (
  SELECT event_id, session_id, user_id, event_date, timestamp,
         row_number() OVER w AS event_sequence,
         lag(timestamp) OVER w AS prev_timestamp,
         coalesce((floor(epoch(timestamp)) - floor(epoch(lag(timestamp) OVER w)))::bigint, 0) AS time_since_prev_event
  FROM ev WINDOW w AS (PARTITION BY session_id ORDER BY timestamp, event_id)
),
sess AS (
  SELECT e.session_id, e.user_id, e.event_date, count(*) AS num_events,
         count(DISTINCT event_type) AS num_unique_event_types,
         min(e.timestamp) AS session_start, max(e.timestamp) AS session_end,
         arg_min(device, {{'t': e.timestamp, 'i': e.event_id}}) AS device,
         arg_min(browser, {{'t': e.timestamp, 'i': e.event_id}}) AS browser,
         arg_min(referrer, {{'t': e.timestamp, 'i': e.event_id}}) AS referrer,
         {n_type('page_view')} AS num_page_views, {n_type('product_click')} AS num_product_clicks,
         {n_type('add_to_cart')} AS num_add_to_cart, {n_type('purchase')} AS num_purchases,
         max(cart_value) AS total_cart_value, max(num_items) AS items_purchased,
         sum(time_since_prev_event)::double / count(*) AS avg_time_between_events,
         (floor(epoch(max(e.timestamp))) - floor(epoch(min(e.timestamp))))::bigint AS session_duration_seconds,
         CASE WHEN {n_type('purchase')} > 0 THEN 1 ELSE 0 END::int AS converted
  FROM ev e JOIN seq USING (event_id)
  GROUP BY ALL
),
prod AS (
  SELECT product_id, category, count(*) AS total_interactions,
         count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS unique_sessions,
         {n_type('product_click')} AS num_clicks, {n_type('add_to_cart')} AS num_add_to_cart,
         {money_avg('price')} AS avg_price,
         coalesce(rnd({div(n_type('add_to_cart'), n_type('product_click'))}, 4), 0.0)::double AS click_to_cart_rate
  FROM ev WHERE product_id IS NOT NULL GROUP BY product_id, category
),
usr0 AS (
  SELECT user_id, count(DISTINCT session_id) AS num_sessions, count(*) AS total_events,
         count(DISTINCT event_date) AS num_active_days,
         min(timestamp) AS first_seen, max(timestamp) AS last_seen,
         {n_type('purchase')} AS total_purchases, {money0('cart_value')} AS total_revenue,
         count(DISTINCT product_id) AS unique_products_viewed
  FROM ev GROUP BY user_id
),
usr AS (
  SELECT *, (datediff('day', first_seen::date, last_seen::date) + 1)::int AS days_active,
         rnd(total_events::double / num_sessions, 2) AS avg_events_per_session,
         coalesce(rnd({div('total_revenue', 'total_purchases')}, 2), 0.0)::double AS avg_revenue_per_purchase,
         CASE WHEN total_purchases >= 5 THEN 'High Value' WHEN total_purchases >= 1 THEN 'Converted'
              WHEN num_sessions >= 3 THEN 'Engaged' ELSE 'New/Inactive' END AS user_segment
  FROM usr0
),
daily AS (
  SELECT event_date, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
         count(DISTINCT session_id) AS unique_sessions, {n_type('purchase')} AS total_purchases,
         {money0('cart_value')} AS total_revenue, {money_avg('cart_value')} AS avg_order_value,
         rnd({div(n_type('purchase'), 'count(DISTINCT session_id)')} * 100, 2) AS conversion_rate
  FROM ev GROUP BY event_date
),
days AS (
  SELECT event_date AS date_key, year(event_date)::int AS year, month(event_date)::int AS month,
         day(event_date)::int AS day, quarter(event_date)::int AS quarter,
         (isodow(event_date) - 1)::int AS day_of_week, dayname(event_date) AS day_name,
         monthname(event_date) AS month_name, isodow(event_date) >= 6 AS is_weekend, false AS is_holiday
  FROM daily
),
wsess AS (
  SELECT session_id, user_id, event_date, session_start, session_end, session_duration_seconds,
         num_events, num_unique_event_types, device, browser, referrer, num_page_views,
         num_product_clicks, num_add_to_cart, num_purchases, total_cart_value, items_purchased,
         rnd(avg_time_between_events, 2) AS avg_time_between_events, converted = 1 AS converted
  FROM sess QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY event_date, user_id) = 1
),
wprod AS (
  SELECT * REPLACE (rnd(avg_price, 2) AS avg_price)
  FROM prod QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY category) = 1
),
wdaily AS (
  SELECT event_date AS metric_date, * EXCLUDE (event_date) REPLACE (rnd(avg_order_value, 2) AS avg_order_value)
  FROM daily
),
scores AS (
  SELECT event_id::varchar AS id, regexp_extract(props, '[0-9]+')::int / 100.0::double AS score,
         (value > 50)::int AS actual,
         (regexp_extract(props, '[0-9]+')::int / 100.0::double >= 0.5)::int AS predicted, value
  FROM events
),
fits AS (
  SELECT event_id::varchar AS id,
         CASE WHEN regexp_extract(props, '[0-9]+')::int = 0 THEN 0.0::double ELSE value END AS actual,
         rnd(value * 0.9::double + regexp_extract(props, '[0-9]+')::int / 10.0::double, 4) AS predicted
  FROM events
),
conv AS (
  SELECT id AS session_id, actual AS actual_converted, score AS conversion_probability,
         predicted AS predicted_converted,
         CASE WHEN score <= 0.3::double THEN 'Low' WHEN score <= 0.7::double THEN 'Medium' ELSE 'High' END AS conversion_risk
  FROM scores
),
churn AS (
  SELECT session_id AS user_id, actual_converted AS actual_churned, conversion_probability AS churn_probability,
         predicted_converted AS predicted_churned, conversion_risk AS churn_risk,
         rnd(s.value * 5, 2) AS total_revenue, c.conversion_probability * rnd(s.value * 5, 2) AS retention_priority
  FROM conv c JOIN scores s ON s.id = c.session_id
),
ltv AS (
  SELECT id AS user_id, actual AS actual_revenue, rnd(predicted * 4 - 20, 2) AS predicted_ltv_90days,
         CASE WHEN rnd(predicted * 4 - 20, 2) <= 50 THEN 'Low' WHEN rnd(predicted * 4 - 20, 2) <= 200 THEN 'Medium'
              WHEN rnd(predicted * 4 - 20, 2) <= 500 THEN 'High' ELSE 'VIP' END AS ltv_category
  FROM fits
)
"""


def _expand_rnd(sql: str) -> str:
    """rnd(x, n) rounds half up on the decimal digits of x, as numeric columns do.

    DuckDB's round() scales the binary double, so 19.455 would become 19.45.
    """
    while (start := sql.find("rnd(")) >= 0:
        depth, end, comma = 0, start + 3, -1
        while True:
            c = sql[end]
            if c == "," and depth == 1:
                comma = end
            depth += (c == "(") - (c == ")")
            if depth == 0:
                break
            end += 1
        value, digits = sql[start + 4:comma], sql[comma + 1:end]
        sql = f"{sql[:start]}(round(({value})::decimal(28,10),{digits})::double){sql[end + 1:]}"
    return sql


def with_tables(select: str, extra: str = "") -> str:
    """A statement over the tables above, with further expressions in ``extra``."""
    tail = f",\n{extra}" if extra else ""
    return _expand_rnd(f"WITH {CTES.strip()}{tail}\n{select}")
