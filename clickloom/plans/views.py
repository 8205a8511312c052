"""Reporting views over the warehouse tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions.exprs import (
    cents, count_type, is_type, mean, money_avg, money_sum, money_sum_or_zero, month_start, percent,
    purchase_amount, ratio, rounded_ratio,
)
from clickloom.operators.ordered import rollup_entities, rollup_visits
from clickloom.session import stage

CHANNEL = ["device", "browser", "referrer"]
TILE_ITEMS = 1000  # items of a block of a large cart


def user_purchase_history(events: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Purchases with the buyer's segment and the product's name."""
    bought = events.filter(is_type("purchase")).select(
        "user_id", "timestamp", "session_id", "product_id", "cart_value", "num_items", "payment_method"
    )
    columns = [
        "user_id", "user_segment", "timestamp", "session_id", "product_id", "product_name",
        "category", "cart_value", "num_items", "payment_method",
    ]
    by_users = bought.join(users.select("user_id", "user_segment"), "user_id")
    # purchases without a product stay out of the join, where they would meet in one task
    named = by_users.filter(F.col("product_id").isNotNull()).join(
        products.select("product_id", "product_name", "category"), "product_id", "left"
    )
    unnamed = by_users.filter(F.col("product_id").isNull()).withColumns(
        {c: F.lit(None).cast("string") for c in ("product_name", "category")}
    )
    return named.select(*columns).unionByName(unnamed.select(*columns))


def session_funnel(sessions: DataFrame) -> DataFrame:
    """Sessions per day that reached each step; ``sessions`` has one row per session."""
    counts = sessions.groupBy("event_date").agg(
        F.count("session_id").alias("total_sessions"),
        F.count_if(F.col("num_page_views") > 0).alias("sessions_with_views"),
        F.count_if(F.col("num_product_clicks") > 0).alias("sessions_with_clicks"),
        F.count_if(F.col("num_add_to_cart") > 0).alias("sessions_with_cart"),
        F.count_if(F.col("num_purchases") > 0).alias("sessions_with_purchase"),
    )
    return counts.withColumn("conversion_rate", percent("sessions_with_purchase", "total_sessions"))


def product_affinity(events: DataFrame, min_sessions: int = 5) -> DataFrame:
    """Product pairs added to the cart in the same session, in at least ``min_sessions``.

    Pairs are not formed in every session. Sessions are ordered by how many
    products they hold, and for each product the ``min_sessions - 1`` fullest ones
    are set aside. Two products that share ``min_sessions`` sessions must share one
    that is set aside by neither, so pairing the remaining rows finds every
    candidate, while a session holding a large share of all carts pairs nothing.
    The sessions set aside are then looked up for the candidates alone, which
    makes the counts exact. Large carts that remain are cut into blocks of items, and
    each pair of blocks is joined by itself, so no task pairs more than two blocks.
    """
    same_cart = Window.partitionBy("session_id", "product_id")
    carts = (
        events.filter(is_type("add_to_cart") & F.col("product_id").isNotNull())
        .select("session_id", "product_id", "user_id")
        .distinct()
        # one row per session and product stands for the session in its count
        .withColumn("counts", (F.col("user_id") == F.min("user_id").over(same_cart)).cast("long"))
    )
    frequent = carts.groupBy("product_id").agg(F.sum("counts").alias("sessions")).filter(
        F.col("sessions") >= min_sessions
    )
    carts = carts.join(frequent.select("product_id"), "product_id", "left_semi")
    items = carts.filter("counts = 1").select("session_id", "product_id")
    sizes = items.groupBy("session_id").agg(F.count("*").alias("items"))
    fullest = Window.partitionBy("product_id").orderBy(F.desc("items"), F.desc("session_id"))
    aside = (
        items.join(sizes, "session_id")
        .withColumn("_rank", F.row_number().over(fullest))
        .filter(F.col("_rank") <= min_sessions - 1)
        .select("session_id", "product_id", F.lit(True).alias("aside"))
    )
    blocks = sizes.filter(F.col("items") > TILE_ITEMS).select("session_id", F.ceil(F.col("items") / F.lit(TILE_ITEMS)).cast("int").alias("blocks"))
    carts = stage(
        carts.join(aside, ["session_id", "product_id"], "left").join(blocks, "session_id", "left").withColumns(
            {"aside": F.coalesce("aside", F.lit(False)), "blocks": F.coalesce("blocks", F.lit(1))}
        ),
        "carts",
    )

    def side(name: str, rows: DataFrame) -> DataFrame:
        return rows.withColumnRenamed("product_id", f"product_{name}")

    def tiled(name: str, rows: DataFrame) -> DataFrame:
        """Each row in the pairs of blocks that its own block is part of; small carts are one block."""
        own = F.pmod(F.xxhash64("product_id"), F.col("blocks")).cast("int")
        others = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        tiles = others.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other", "blocks")
        return side(name, tiles).withColumnRenamed("own", f"own_{name}")

    items = carts.filter("counts = 1").select("session_id", "product_id", "aside", "blocks")
    kept = tiled("a", carts.filter("not aside").drop("aside"))
    paired = kept.join(tiled("b", items.filter("not aside").drop("aside")), ["session_id", "low", "high"]).filter(
        "product_a < product_b AND low = least(own_a, own_b) AND high = greatest(own_a, own_b)"
    )
    kept_carts = side("a", carts.filter("not aside").drop("aside", "blocks"))
    items = items.drop("blocks")
    pair = ["product_a", "product_b"]
    together = F.sum("counts").alias("sessions")
    # the pairs are formed once; candidates and counts both come from this table
    paired = stage(paired.groupBy(*pair, "user_id").agg(together), "pairs")
    candidates = paired.select(*pair).distinct()
    # the session is set aside by the first product
    by_first = candidates.join(side("a", carts.drop("blocks").filter("aside")), "product_a").join(
        side("b", items.drop("aside")), ["session_id", "product_b"], "left_semi"
    )
    # the session is set aside by the second product only
    by_second = candidates.join(side("b", items.filter("aside")), "product_b").join(
        kept_carts, ["session_id", "product_a"]
    )

    looked_up = [df.groupBy(*pair, "user_id").agg(together) for df in (by_first, by_second)]
    per_user = reduce(DataFrame.unionByName, [paired, *looked_up]).groupBy(*pair, "user_id").agg(
        F.sum("sessions").alias("sessions")
    )
    return (
        per_user.groupBy(*pair)
        .agg(F.sum("sessions").alias("sessions_together"), F.count("user_id").alias("users_together"))
        .filter(F.col("sessions_together") >= min_sessions)
    )


def _day_bit(day: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.dayofmonth(day) - 1)


def user_activity(events: DataFrame) -> DataFrame:
    """(user_id, month, days): per user and month the days with events, one bit a day.

    Masks of several loads merge by ``bit_or``. Events without a time have a null month.
    """
    day = _day_bit(F.col("timestamp"))
    return events.groupBy("user_id", month_start("timestamp").alias("month")).agg(F.bit_or(day).alias("days"))


def user_retention(users: DataFrame, events: DataFrame | None = None, activity: DataFrame | None = None) -> DataFrame:
    """Per cohort day: users active on days 0, 1, 7 and 30 after they were first seen.

    Reads ``user_activity``, from ``events`` if it is not given: every offset is a bit of
    the mask of its month.
    """
    activity = user_activity(events) if activity is None else activity
    offsets = (0, 1, 7, 30)
    cohort = users.select("user_id", F.to_date("first_seen").alias("cohort_date"))

    def active(offset: int) -> Column:
        day = F.date_add("cohort_date", offset)
        bit = F.col("days").bitwiseAND(_day_bit(day)) != 0
        return F.max(F.when((F.col("month") == month_start(day)) & bit, 1).otherwise(0)).alias(f"day_{offset}")

    per_user = cohort.join(activity, "user_id", "left").groupBy("cohort_date", "user_id").agg(*map(active, offsets))
    return per_user.groupBy("cohort_date").agg(
        F.count("user_id").alias("cohort_size"), *[F.sum(f"day_{d}").alias(f"day_{d}") for d in offsets]
    )


def customer_journey_funnel(events: DataFrame) -> DataFrame:
    """Per day and channel: sessions at each of five steps, step rates, drop-offs, revenue."""
    steps = {
        "step_1_page_view": "page_view",
        "step_2_product_click": "product_click",
        "step_3_add_to_cart": "add_to_cart",
        "step_4_checkout": "checkout",
        "step_5_purchase": "purchase",
    }
    counted = rollup_entities(
        events,
        ["event_date", *CHANNEL],
        {"session": "session_id", "user": "user_id"},
        {
            "total_sessions": ("session", None),
            **{name: ("session", is_type(kind)) for name, kind in steps.items()},
            "users_step_1": ("user", is_type("page_view")),
            "users_step_5": ("user", is_type("purchase")),
        },
        {
            "cents": F.when(
                is_type("purchase"), F.rint(F.col("cart_value").cast("double") * 100).cast("long")
            ).otherwise(F.lit(0).cast("long")),
        },
    )
    s1, s2, s3, s4, s5 = steps
    return counted.withColumn("total_revenue", F.col("cents") / F.lit(100.0)).select(
        "event_date", *CHANNEL, "total_sessions", *steps,
        percent(s2, s1).alias("pv_to_click_rate"),
        percent(s3, s2).alias("click_to_cart_rate"),
        percent(s4, s3).alias("cart_to_checkout_rate"),
        percent(s5, s4).alias("checkout_to_purchase_rate"),
        percent(s5, "total_sessions").alias("overall_conversion_rate"),
        (F.col(s1) - F.col(s2)).alias("dropoff_step_1_to_2"),
        (F.col(s2) - F.col(s3)).alias("dropoff_step_2_to_3"),
        (F.col(s3) - F.col(s4)).alias("dropoff_step_3_to_4"),
        (F.col(s4) - F.col(s5)).alias("dropoff_step_4_to_5"),
        "total_revenue",
        rounded_ratio("total_revenue", s5, 2).alias("avg_order_value"),
        "users_step_1",
        "users_step_5",
    )


def session_analytics(sessions: DataFrame, users: DataFrame, dates: DataFrame) -> DataFrame:
    """Sessions with user segment, calendar attributes, engagement level and quality score."""
    n = F.col("num_events")
    # Limits and names of the levels, weights of the score.
    engagement = (
        F.when(n == 1, "Bounce")
        .when(n.between(2, 5), "Low Engagement")
        .when(n.between(6, 15), "Medium Engagement")
        .otherwise("High Engagement")
    )
    abandoned = (F.col("num_add_to_cart") > 0) & (F.col("num_purchases") == 0)
    score = n * 5 + F.col("num_unique_event_types") * 10 + F.when(F.col("converted"), 50).otherwise(0)
    joined = sessions.join(users.select("user_id", "user_segment"), "user_id").join(
        dates.select(F.col("date_key").alias("event_date"), "day_name", "is_weekend"), "event_date"
    )
    return joined.select(
        "session_id", "user_id", "user_segment", "event_date", "day_name", "is_weekend",
        "session_start", "session_end", "session_duration_seconds",
        F.round(F.col("session_duration_seconds") / 60.0, 2).alias("session_duration_minutes"),
        *CHANNEL,
        "num_events", "num_unique_event_types", "avg_time_between_events",
        engagement.alias("engagement_level"),
        "num_page_views", "num_product_clicks", "num_add_to_cart", "num_purchases", "converted",
        F.coalesce(abandoned, F.lit(False)).alias("cart_abandoned"),
        "total_cart_value", "items_purchased",
        rounded_ratio("total_cart_value", "items_purchased", 2).alias("avg_item_price"),
        F.least(F.lit(100), score).cast("long").alias("session_quality_score"),
        F.hour("session_start").alias("session_hour"),
        (F.dayofweek("session_start") - 1).alias("session_day_of_week"),
    )


def user_segment_performance(users: DataFrame) -> DataFrame:
    """Per segment: activity, revenue and shares of all users and all revenue.

    The share windows run over one row per segment.
    """
    whole = Window.partitionBy()
    cents = F.rint(F.col("total_revenue") * 100).cast("long")
    totals = users.groupBy("user_segment").agg(
        F.count("user_id").alias("total_users"),
        F.sum("num_sessions").alias("total_sessions"),
        F.sum("total_events").alias("total_events"),
        money_avg("avg_events_per_session").alias("avg_events_per_session"),
        mean("num_active_days").alias("avg_active_days"),
        F.sum("total_purchases").alias("total_purchases"),
        money_sum("total_revenue").alias("total_revenue"),
        money_avg("total_revenue").alias("avg_revenue_per_user"),
        money_avg("avg_revenue_per_purchase").alias("avg_order_value"),
        F.count_if(F.col("total_purchases") > 0).alias("buyers"),
        mean("unique_products_viewed").alias("avg_products_viewed"),
    )
    return totals.select(
        "user_segment", "total_users", "total_sessions", "total_events", "avg_events_per_session",
        "avg_active_days", "total_purchases", "total_revenue", "avg_revenue_per_user",
        "avg_order_value",
        percent("buyers", "total_users").alias("user_conversion_rate"),
        "avg_products_viewed",
        percent("total_users", F.sum("total_users").over(whole)).alias("segment_share_pct"),
        percent("total_revenue", F.sum(cents).over(whole) / F.lit(100.0)).alias("revenue_share_pct"),
    )


def _cohort_activity(users: DataFrame, events: DataFrame | None, activity: DataFrame | None) -> DataFrame:
    """Users with their cohort month, one row per month in which they were active."""
    activity = user_activity(events) if activity is None else activity
    cohort = users.select("user_id", month_start("first_seen").alias("cohort_month"))
    return cohort.join(activity.select("user_id", F.col("month").alias("activity_month")), "user_id")


def _months_apart(later: str, earlier: str):
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def cohort_retention_monthly_literal(users: DataFrame, events: DataFrame | None = None, activity: DataFrame | None = None) -> DataFrame:
    """Retention with the cohort counted among the active users of the same month.

    The rate is therefore always 100, and the month offset wraps after a year.
    """
    active = _cohort_activity(users, events, activity).groupBy("cohort_month", "activity_month").agg(
        F.count("user_id").alias("cohort_size")
    )
    return active.select(
        "cohort_month", "cohort_size", "activity_month",
        (_months_apart("activity_month", "cohort_month") % 12).alias("months_since_signup"),
        F.col("cohort_size").alias("active_users"),
        percent("cohort_size", "cohort_size").alias("retention_rate"),
    )


def cohort_retention_monthly(users: DataFrame, events: DataFrame | None = None, activity: DataFrame | None = None) -> DataFrame:
    """Retention against the whole cohort, with the full month offset."""
    sizes = users.groupBy(month_start("first_seen").alias("cohort_month")).agg(
        F.count("user_id").alias("cohort_size")
    )
    active = _cohort_activity(users, events, activity).groupBy("cohort_month", "activity_month").agg(
        F.count("user_id").alias("active_users")
    )
    return active.join(sizes, "cohort_month").select(
        "cohort_month", "cohort_size", "activity_month",
        _months_apart("activity_month", "cohort_month").alias("months_since_signup"),
        "active_users",
        percent("active_users", "cohort_size").alias("retention_rate"),
    )


def touchpoint_performance(events: DataFrame) -> DataFrame:
    """Per day and channel: volume, event mix, conversion, revenue and engagement."""
    by_channel = rollup_visits(
        events, ["event_date", *CHANNEL],
        {
            "total_interactions": F.lit(True),
            "page_views": is_type("page_view"), "product_clicks": is_type("product_click"),
            "add_to_carts": is_type("add_to_cart"), "purchases": is_type("purchase"),
            "engaged": ~is_type("page_view"), "orders": purchase_amount().isNotNull(),
        },
        {
            "cents": cents(F.when(is_type("purchase"), F.col("cart_value")).otherwise(0)),
            "order_cents": cents(purchase_amount()),
        },
    ).withColumns(
        {
            "total_revenue": F.col("cents") / 100.0,
            "avg_order_value": rounded_ratio(F.col("order_cents") / 100.0, "orders"),
        }
    )
    return by_channel.select(
        "event_date",
        F.col("device").alias("touchpoint_device"),
        F.col("browser").alias("touchpoint_browser"),
        F.col("referrer").alias("touchpoint_referrer"),
        "total_interactions", "unique_sessions", "unique_users",
        "page_views", "product_clicks", "add_to_carts", "purchases",
        percent("purchases", "unique_sessions").alias("session_conversion_rate"),
        "total_revenue",
        "avg_order_value",
        rounded_ratio("engaged", "total_interactions", 2, 100).alias("engagement_rate"),
    )


def executive_kpis(daily: DataFrame, dates: DataFrame) -> DataFrame:
    """Daily KPIs with change against seven rows earlier and seven-row averages.

    The windows have no partition but run over one row per day.
    """
    by_date = Window.orderBy("metric_date")
    week = by_date.rowsBetween(-6, 0)
    days = daily.join(
        dates.select(F.col("date_key").alias("metric_date"), "day_name", "is_weekend"), "metric_date"
    ).withColumns({c: F.col(c).cast("double") for c in ("total_revenue", "avg_order_value", "conversion_rate")})
    prior = days.withColumns(
        {
            "users_before": F.lag("unique_users", 7).over(by_date),
            "revenue_before": F.lag("total_revenue", 7).over(by_date),
            "conversion_before": F.lag("conversion_rate", 7).over(by_date),
            "revenue_cents": F.rint(F.col("total_revenue") * 100).cast("long"),
        }
    )
    return prior.select(
        "metric_date", "day_name", "is_weekend", "total_events", "unique_users", "unique_sessions",
        "total_purchases", "total_revenue", "avg_order_value", "conversion_rate",
        rounded_ratio("total_revenue", "unique_users", 2).alias("revenue_per_user"),
        rounded_ratio("total_events", "unique_sessions", 2).alias("events_per_session"),
        rounded_ratio("total_purchases", "unique_sessions", 2, 100).alias("purchase_rate"),
        percent(F.col("unique_users") - F.col("users_before"), "users_before").alias("users_wow_change_pct"),
        percent(F.col("total_revenue") - F.col("revenue_before"), "revenue_before").alias("revenue_wow_change_pct"),
        F.round(F.col("conversion_rate") - F.col("conversion_before"), 2).alias("conversion_wow_change_pp"),
        rounded_ratio(F.sum("revenue_cents").over(week), F.count("*").over(week) * 100).alias("revenue_7day_ma"),
        rounded_ratio(F.sum("unique_users").over(week), F.count("*").over(week)).alias("users_7day_ma"),
    )


def product_analytics(products: DataFrame, metrics: DataFrame, events: DataFrame) -> DataFrame:
    """Products with interaction metrics, purchases, revenue, score and two tiers."""
    sales = (
        events.filter(is_type("purchase") & F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.count("*").alias("num_purchases"), money_sum("cart_value").alias("total_revenue"))
    )
    average = metrics.agg(ratio(F.sum("total_interactions"), F.count("*"))).scalar()
    total = F.col("total_interactions")
    price = F.col("price").cast("double")
    # Limits and names of the tiers, weights of the score.
    price_tier = (
        F.when(price < 50, "Budget")
        .when(price <= 150, "Mid-Range")
        .when(price <= 500, "Premium")
        .otherwise("Luxury")
    )
    performance = (
        F.when(total > average * 1.5, "Top Performer")
        .when(total > average, "Above Average")
        .when(total > average * 0.5, "Average")
        .otherwise("Underperforming")
    )
    score = total * 0.3 + F.col("unique_users") * 0.4 + F.col("num_clicks") * 0.3
    return (
        products.join(metrics.drop("category", "avg_price"), "product_id")
        .join(sales, "product_id", "left")
        .select(
            "product_id", "product_name", "category", "price", "rating", "total_interactions",
            "unique_users", "unique_sessions", "num_clicks", "num_add_to_cart", "click_to_cart_rate",
            F.coalesce("num_purchases", F.lit(0).cast("long")).alias("num_purchases"),
            "total_revenue",
            percent("num_clicks", "total_interactions").alias("click_through_rate"),
            percent("num_add_to_cart", "num_clicks").alias("cart_conversion_rate"),
            F.round(score.cast("double"), 2).alias("engagement_score"),
            price_tier.alias("price_tier"),
            performance.alias("performance_tier"),
        )
    )


def cart_abandonment(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Cart sessions per day, channel and segment, split into abandoned and completed.

    The cart value of a session is only known after a purchase, so the value of
    abandoned carts is 0 or NULL here; ``cart_abandonment_value`` prices the items.
    """
    lost = F.col("num_purchases") == 0
    carts = sessions.filter(F.col("num_add_to_cart") > 0).join(users.select("user_id", "user_segment"), "user_id")
    return (
        carts.groupBy("event_date", "device", "browser", "user_segment")
        .agg(
            F.count("*").alias("total_cart_sessions"),
            F.count_if(lost).alias("abandoned_sessions"),
            F.count_if(~lost).alias("completed_sessions"),
            money_sum(F.when(lost, F.col("total_cart_value")).otherwise(0)).alias("potential_lost_revenue"),
            money_avg(F.when(lost, F.col("total_cart_value"))).alias("avg_abandoned_cart_value"),
            mean(F.when(lost, F.col("session_duration_seconds"))).alias("avg_abandoned_session_duration"),
            mean(F.when(lost, F.col("num_add_to_cart"))).alias("avg_items_in_abandoned_cart"),
        )
        .withColumn("abandonment_rate", percent("abandoned_sessions", "total_cart_sessions"))
    )


def cart_abandonment_value(events: DataFrame) -> DataFrame:
    """Per day the sessions started: abandoned carts, their items and the items' value."""
    carts = (
        events.filter(F.col("event_type").isin("add_to_cart", "purchase"))
        .groupBy("session_id")
        .agg(
            F.min(F.when(is_type("add_to_cart"), F.col("event_date"))).alias("event_date"),
            count_type("add_to_cart").alias("items"),
            money_sum_or_zero(F.when(is_type("add_to_cart"), F.col("price"))).alias("value"),
            count_type("purchase").alias("purchases"),
        )
        .filter((F.col("items") > 0) & (F.col("purchases") == 0))
    )
    return carts.groupBy("event_date").agg(
        F.count("*").alias("abandoned_sessions"),
        F.sum("items").alias("abandoned_items"),
        money_sum("value").alias("abandoned_value"),
    )


def ml_performance_summary(conversion: DataFrame, churn: DataFrame, ltv: DataFrame) -> DataFrame:
    """Per model: predictions, average score and accuracy (none for the regressor)."""

    def summary(df: DataFrame, model: str, score: str, hit) -> DataFrame:
        accuracy = F.lit(None).cast("double") if hit is None else ratio(F.count_if(hit), F.count("*"))
        return df.agg(
            F.count("*").alias("total_predictions"),
            F.round(F.avg(F.col(score).cast("double")), 6).alias("avg_probability"),
            accuracy.alias("accuracy"),
        ).select(F.lit(model).alias("model_name"), "*")

    return reduce(
        DataFrame.unionByName,
        [
            summary(conversion, "Conversion", "conversion_probability",
                    F.col("predicted_converted") == F.col("actual_converted")),
            summary(churn, "Churn", "churn_probability",
                    F.col("predicted_churned") == F.col("actual_churned")),
            summary(ltv, "LTV", "predicted_ltv_90days", None),
        ],
    )
