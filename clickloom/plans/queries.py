"""Analytical queries over the warehouse tables.

Top-k queries end their sort with the key, so equal values have a fixed order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions.exprs import (
    cents, count_type, is_type, mean, money_avg, money_sum, month_start, percent, rounded_ratio, week_start,
)
from clickloom.operators.ordered import exact_percentiles, rollup_visits
from clickloom.plans.views import session_funnel


def _revenue() -> Column:
    """Amount of purchase events, 0 for other events."""
    return F.when(is_type("purchase"), F.col("cart_value")).otherwise(0)


def _bucket(limits: list[tuple[Column, str]], last: str) -> tuple[Column, Column]:
    """Label and order of the first condition that holds."""
    label, order = F, F
    for i, (cond, name) in enumerate(limits):
        label, order = label.when(cond, name), order.when(cond, i)
    return label.otherwise(last), order.otherwise(len(limits))


def q01_daily_revenue_trend(daily: DataFrame) -> DataFrame:
    return daily.select(
        "event_date", "total_events", "unique_users", "unique_sessions", "total_purchases",
        "total_revenue",
        rounded_ratio("total_revenue", "total_purchases", 2).alias("avg_order_value"),
        "conversion_rate",
    ).orderBy(F.desc("event_date")).limit(30)


def q02_segment_distribution(users: DataFrame) -> DataFrame:
    return (
        users.groupBy("user_segment")
        .agg(
            F.count("*").alias("num_users"),
            F.sum("total_purchases").alias("total_purchases"),
            money_sum("total_revenue").alias("total_revenue"),
            money_avg("total_revenue").alias("avg_revenue_per_user"),
            mean("num_sessions").alias("avg_sessions_per_user"),
        )
        .orderBy(F.desc("total_revenue"), "user_segment")
    )


def q03_top20_products(metrics: DataFrame, products: DataFrame) -> DataFrame:
    catalog = products.select("product_id", "product_name", "category", "price")
    return (
        metrics.drop("category")
        .join(catalog, "product_id")
        .select(
            "product_id", "product_name", "category", "total_interactions", "unique_users",
            "num_add_to_cart", "click_to_cart_rate", "price",
        )
        .orderBy(F.desc("total_interactions"), "product_id")
        .limit(20)
    )


def q04_session_funnel_rates(sessions: DataFrame) -> DataFrame:
    return session_funnel(sessions).select(
        "event_date", "total_sessions", "sessions_with_views", "sessions_with_clicks",
        "sessions_with_cart", "sessions_with_purchase",
        percent("sessions_with_clicks", "sessions_with_views").alias("view_to_click_rate"),
        percent("sessions_with_cart", "sessions_with_clicks").alias("click_to_cart_rate"),
        percent("sessions_with_purchase", "sessions_with_cart").alias("cart_to_purchase_rate"),
        F.col("conversion_rate").alias("overall_conversion_rate"),
    ).orderBy(F.desc("event_date"))


def q05_event_funnel(events: DataFrame) -> DataFrame:
    """Sessions that contain each step; flags per session first, then one global count."""
    steps = {
        "page_views": "page_view", "product_clicks": "product_click", "add_to_cart": "add_to_cart",
        "checkout": "checkout", "purchase": "purchase",
    }
    per_session = events.groupBy("session_id").agg(
        *[F.max(F.when(is_type(kind), 1).otherwise(0)).alias(name) for name, kind in steps.items()]
    )
    totals = per_session.agg(*[F.count_if(F.col(name) == 1).alias(name) for name in steps])
    return totals.select(
        "page_views", "product_clicks",
        percent("product_clicks", "page_views").alias("pv_to_click_rate"),
        "add_to_cart",
        percent("add_to_cart", "product_clicks").alias("click_to_cart_rate"),
        "checkout",
        percent("checkout", "add_to_cart").alias("cart_to_checkout_rate"),
        "purchase",
        percent("purchase", "checkout").alias("checkout_to_purchase_rate"),
    )


def q06_hourly_traffic(events: DataFrame) -> DataFrame:
    return (
        rollup_visits(events, ["event_hour"], {"num_events": F.lit(True), "purchases": is_type("purchase")})
        .select("event_hour", "num_events", "unique_users", "unique_sessions", "purchases")
        .orderBy("event_hour")
    )


def q07_day_of_week(events: DataFrame) -> DataFrame:
    names = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    day_name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("event_day_of_week"))
    return (
        events.groupBy("event_day_of_week")
        .agg(
            F.count_distinct("session_id").alias("sessions"),
            count_type("purchase").alias("purchases"),
            money_sum(_revenue()).alias("revenue"),
        )
        .orderBy("event_day_of_week")
        .select(day_name.alias("day_name"), "sessions", "purchases", "revenue")
    )


def q08_month_over_month(events: DataFrame) -> DataFrame:
    """Monthly metrics with revenue growth; the window runs over one row per month."""
    months = rollup_visits(
        events, ["event_year", "event_month"], {"purchases": is_type("purchase")}, {"cents": cents(_revenue())}
    ).select(
        "event_year", "event_month", "unique_users", F.col("unique_sessions").alias("sessions"), "purchases",
        (F.col("cents") / 100.0).alias("revenue"),
    )
    before = F.lag("revenue").over(Window.orderBy("event_year", "event_month"))
    return (
        months.withColumn("revenue_growth_pct", percent(F.col("revenue") - before, before))
        .withColumn("revenue", F.round("revenue", 2))
        .orderBy("event_year", "event_month")
    )


def q09_weekly_cohorts(users: DataFrame) -> DataFrame:
    return (
        users.groupBy(week_start("first_seen").alias("cohort_week"))
        .agg(
            F.count("user_id").alias("cohort_size"),
            mean("num_sessions").alias("avg_sessions"),
            money_avg("total_revenue").alias("avg_revenue"),
            F.count_if(F.col("total_purchases") > 0).alias("converted_users"),
        )
        .orderBy(F.desc("cohort_week"))
    )


def q10_purchase_frequency_cohorts(users: DataFrame) -> DataFrame:
    n = F.col("total_purchases")
    return (
        users.groupBy(month_start("first_seen").alias("cohort_month"))
        .agg(
            F.count("*").alias("total_users"),
            F.count_if(n == 0).alias("zero_purchases"),
            F.count_if(n == 1).alias("one_purchase"),
            F.count_if(n.between(2, 5)).alias("two_to_five"),
            F.count_if(n > 5).alias("more_than_five"),
        )
        .orderBy(F.desc("cohort_month"))
    )


def q11_category_performance(metrics: DataFrame) -> DataFrame:
    rate_units = F.rint(F.col("click_to_cart_rate").cast("double") * 10000).cast("long")
    return (
        metrics.groupBy("category")
        .agg(
            F.count("product_id").alias("num_products"),
            F.sum("total_interactions").alias("total_interactions"),
            F.sum("unique_users").alias("total_unique_users"),
            F.sum("num_add_to_cart").alias("total_add_to_cart"),
            rounded_ratio(F.sum(rate_units), F.count("click_to_cart_rate") * 10000, 4).alias("avg_click_to_cart_rate"),
            money_avg("avg_price").alias("avg_product_price"),
        )
        .orderBy(F.desc("total_interactions"), "category")
    )


def q12_product_affinity_named(affinity: DataFrame, products: DataFrame) -> DataFrame:
    """The 20 pairs of ``product_affinity`` with most sessions, by name."""
    names = products.select("product_id", "product_name")

    def named(side: str) -> DataFrame:
        return names.select(F.col("product_id").alias(f"product_{side}"), F.col("product_name").alias(f"name_{side}"))

    return (
        affinity.join(named("a"), "product_a")
        .join(named("b"), "product_b")
        .orderBy(F.desc("sessions_together"), "product_a", "product_b")
        .limit(20)
        .select(
            F.col("name_a").alias("product_a"), F.col("name_b").alias("product_b"),
            "sessions_together", "users_together",
        )
    )


def q13_abandoned_cart_products(events: DataFrame, products: DataFrame, min_sessions: int = 10) -> DataFrame:
    """Products most often left in a cart whose session bought nothing."""
    added = (
        events.filter(is_type("add_to_cart") & F.col("product_id").isNotNull())
        .select("session_id", "product_id")
        .distinct()
    )
    bought = events.filter(is_type("purchase")).select("session_id").distinct().withColumn("bought", F.lit(True))
    counted = (
        added.join(bought, "session_id", "left")
        .groupBy("product_id")
        .agg(
            F.count("*").alias("times_added_to_cart"),
            F.count_if(F.col("bought").isNull()).alias("times_abandoned"),
        )
        .filter(F.col("times_added_to_cart") >= min_sessions)
    )
    return (
        counted.join(products.select("product_id", "product_name", "category"), "product_id")
        .select(
            "product_id", "product_name", "category", "times_added_to_cart", "times_abandoned",
            percent("times_abandoned", "times_added_to_cart").alias("abandonment_rate"),
        )
        .orderBy(F.desc("times_abandoned"), "product_id")
        .limit(20)
    )


def q14_session_duration_buckets(sessions: DataFrame) -> DataFrame:
    seconds = F.col("session_duration_seconds")
    label, order = _bucket(
        [(seconds < 60, "<1 min"), (seconds < 300, "1-5 min"), (seconds < 900, "5-15 min"), (seconds < 1800, "15-30 min")],
        ">30 min",
    )
    return (
        sessions.groupBy(label.alias("duration_bucket"), order.alias("bucket_order"))
        .agg(F.count("*").alias("num_sessions"), F.count_if("converted").alias("converted_sessions"))
        .withColumn("conversion_rate", percent("converted_sessions", "num_sessions"))
        .orderBy("bucket_order")
        .drop("bucket_order")
    )


def _session_breakdown(sessions: DataFrame, keys: list[str], *extra: Column) -> DataFrame:
    """Sessions, users and conversions per key; ``sessions`` has one row per session."""
    return (
        sessions.groupBy(*keys)
        .agg(
            F.count("session_id").alias("sessions"),
            F.count_distinct("user_id").alias("unique_users"),
            F.count_if("converted").alias("conversions"),
            percent(F.count_if("converted"), F.count("*")).alias("conversion_rate"),
            *extra,
        )
        .orderBy(F.desc("sessions"), *keys)
    )


def q15_device_browser(sessions: DataFrame) -> DataFrame:
    return _session_breakdown(
        sessions, ["device", "browser"],
        mean("session_duration_seconds").alias("avg_session_duration"),
    )


def q16_referrer(sessions: DataFrame) -> DataFrame:
    return _session_breakdown(
        sessions, ["referrer"],
        money_sum("total_cart_value").alias("total_revenue"),
        mean("num_events").alias("avg_events_per_session"),
    )


def q17_top5_per_category(metrics: DataFrame, products: DataFrame) -> DataFrame:
    best = Window.partitionBy("category").orderBy(F.desc("total_interactions"), "product_id")
    return (
        metrics.select("product_id", "total_interactions", "unique_users")
        .join(products.select("product_id", "product_name", "category"), "product_id")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= 5)
        .select("category", "product_id", "product_name", "total_interactions", "unique_users", "rank")
        .orderBy("category", "rank")
    )


def q18_running_revenue(daily: DataFrame) -> DataFrame:
    """Running total and seven-row average; the windows run over one row per day."""
    cents = F.rint(F.col("total_revenue").cast("double") * 100).cast("long")
    by_date = Window.orderBy("event_date")
    week = by_date.rowsBetween(-6, 0)
    so_far = by_date.rangeBetween(Window.unboundedPreceding, 0)
    return daily.select(
        "event_date",
        "total_revenue",
        (F.sum(cents).over(so_far) / F.lit(100.0)).alias("cumulative_revenue"),
        rounded_ratio(F.sum(cents).over(week), F.count("*").over(week) * 100, 6).alias("revenue_7day_ma"),
    ).orderBy("event_date")


def q19_ltv_percentiles(users: DataFrame) -> DataFrame:
    buyers = users.select(F.col("total_revenue").cast("double").alias("total_revenue")).filter("total_revenue > 0")
    wanted = {"p25_ltv": 0.25, "median_ltv": 0.5, "p75_ltv": 0.75, "p90_ltv": 0.9, "p95_ltv": 0.95}
    largest = buyers.agg(F.max("total_revenue")).scalar()
    return exact_percentiles(buyers, "total_revenue", wanted).select(
        *[F.round(name, 6).alias(name) for name in wanted], largest.alias("max_ltv")
    )


def q20_ltv_by_acquisition(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Lifetime value by the referrer of each user's first session."""
    first = sessions.groupBy("user_id").agg(
        F.min_by("referrer", F.struct("session_start", "session_id")).alias("acquisition_source")
    )
    return (
        first.join(users.select("user_id", "total_revenue", "num_sessions", "total_purchases"), "user_id")
        .groupBy("acquisition_source")
        .agg(
            F.count("user_id").alias("acquired_users"),
            money_sum("total_revenue").alias("total_ltv"),
            money_avg("total_revenue").alias("avg_ltv"),
            mean("num_sessions").alias("avg_sessions"),
            mean("total_purchases").alias("avg_purchases"),
        )
        .orderBy(F.desc("total_ltv"), "acquisition_source")
    )


def q21_time_to_first_purchase(users: DataFrame, events: DataFrame) -> DataFrame:
    first = events.filter(is_type("purchase")).groupBy("user_id").agg(
        F.min(F.to_date("timestamp")).alias("first_purchase")
    )
    waited = first.join(users.select("user_id", "first_seen", "total_revenue"), "user_id").withColumn(
        "days", F.datediff("first_purchase", F.to_date("first_seen"))
    )
    days = F.col("days")
    label, order = _bucket(
        [(days == 0, "Same day"), (days <= 1, "1 day"), (days <= 7, "2-7 days"), (days <= 30, "8-30 days")],
        ">30 days",
    )
    return (
        waited.groupBy(label.alias("time_to_purchase"), order.alias("bucket_order"))
        .agg(F.count("*").alias("num_users"), money_avg("total_revenue").alias("avg_revenue"))
        .orderBy("bucket_order")
        .drop("bucket_order")
    )


def q22_search_effectiveness(events: DataFrame, min_sessions: int = 10) -> DataFrame:
    """Search terms by use, and sessions that bought after searching.

    A session bought after one of its searches exactly when its last purchase is
    later than its first search, so both sides join as one row per session and
    term instead of comparing every pair of events.
    """
    searches = (
        events.filter((F.col("page_type") == "search") & F.col("search_query").isNotNull())
        .groupBy("search_query", "session_id")
        .agg(F.count("*").alias("searches"), F.min("timestamp").alias("first_search"))
    )
    bought = events.filter(is_type("purchase")).groupBy("session_id").agg(F.max("timestamp").alias("last_purchase"))
    return (
        searches.join(bought, "session_id", "left")
        .groupBy("search_query")
        .agg(
            F.sum("searches").alias("search_count"),
            F.count("*").alias("sessions_with_search"),
            F.count_if(F.col("last_purchase") > F.col("first_search")).alias("sessions_converted_after_search"),
        )
        .filter(F.col("sessions_with_search") >= min_sessions)
        .withColumn("conversion_rate", percent("sessions_converted_after_search", "sessions_with_search"))
        .orderBy(F.desc("search_count"), "search_query")
        .limit(20)
    )
