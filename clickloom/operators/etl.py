"""ETL transforms: cleaned events and the four metric tables built from them."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions.exprs import (
    count_type, mean, money_sum_or_zero, ratio, rounded_ratio,
)
from clickloom.operators.ordered import sequence_in_group
from clickloom.session import stage
from clickloom.sources.writers import write_parquet


def clean_events(raw: DataFrame) -> DataFrame:
    """Typed events with calendar columns; rows without session or user are dropped.

    Text that is not a valid timestamp or number becomes NULL.
    """
    casts = {"timestamp": "timestamp", "price": "double", "cart_value": "double"}
    typed = raw.filter(F.col("session_id").isNotNull() & F.col("user_id").isNotNull()).withColumns(
        {c: F.col(c).try_cast(t) for c, t in casts.items() if c in raw.columns}
    )
    return typed.withColumns(
        {
            "event_date": F.to_date("timestamp"),
            "event_hour": F.hour("timestamp"),
            "event_day_of_week": F.dayofweek("timestamp"),
            "event_month": F.month("timestamp"),
            "event_year": F.year("timestamp"),
        }
    )


def event_sequence(ev: DataFrame) -> DataFrame:
    """Position in the session and whole seconds since the previous event (0 for the first)."""
    ordered = sequence_in_group(ev, "session_id", "timestamp", "event_id")
    gap = F.unix_timestamp("timestamp") - F.unix_timestamp("prev_timestamp")
    return ordered.withColumn("time_since_prev_event", F.coalesce(gap, F.lit(0)))


def session_metrics(ev: DataFrame) -> DataFrame:
    """One row per session, user and date.

    The gaps between consecutive events telescope: within a row they add up to
    its last time minus the last time of the session's previous row (or minus its
    own first time). So the average gap needs no event-level window, only a look
    at the previous day's row of the same session. A session belongs to one user.
    The handful of event types is collected as a set, which spares the second
    shuffle of a distinct count.
    """
    return _session_rows(_session_parts(ev))


def _session_parts(ev: DataFrame) -> DataFrame:
    """What one day's events tell of its sessions."""
    earliest = F.struct("timestamp", "event_id")
    return ev.groupBy("session_id", "user_id", "event_date").agg(
        F.count("*").alias("num_events"),
        F.collect_set("event_type").alias("event_types"),
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
        F.min_by(F.struct("device", "browser", "referrer"), earliest).alias("entry"),
        count_type("page_view").alias("num_page_views"),
        count_type("product_click").alias("num_product_clicks"),
        count_type("add_to_cart").alias("num_add_to_cart"),
        count_type("purchase").alias("num_purchases"),
        F.max("cart_value").alias("total_cart_value"),
        F.max("num_items").alias("items_purchased"),
    )


def _session_rows(grouped: DataFrame) -> DataFrame:
    by_session = Window.partitionBy("session_id", "user_id").orderBy("event_date")
    since = F.coalesce(F.lag("session_end").over(by_session), F.col("session_start"))
    gaps = F.unix_timestamp("session_end") - F.unix_timestamp(since)
    return grouped.select(
        "session_id", "user_id", "event_date", "num_events",
        F.size("event_types").cast("long").alias("num_unique_event_types"),
        "session_start", "session_end", "entry.device", "entry.browser", "entry.referrer",
        "num_page_views", "num_product_clicks", "num_add_to_cart", "num_purchases",
        "total_cart_value", "items_purchased",
        ratio(gaps, "num_events").alias("avg_time_between_events"),
        (F.unix_timestamp("session_end") - F.unix_timestamp("session_start")).alias("session_duration_seconds"),
        F.when(F.col("num_purchases") > 0, 1).otherwise(0).alias("converted"),
    )


def product_metrics(ev: DataFrame) -> DataFrame:
    """Interactions per product and category.

    Rows are reduced to (product, category, user, session) first, which spreads a
    popular product over its sessions before the distinct counts.
    """
    return _product_rows(_product_visits(ev))


def _product_visits(ev: DataFrame, *days: str) -> DataFrame:
    return (
        ev.filter(F.col("product_id").isNotNull())
        .groupBy("product_id", "category", "user_id", "session_id", *days)
        .agg(
            F.count("*").alias("interactions"),
            count_type("product_click").alias("clicks"),
            count_type("add_to_cart").alias("adds"),
            F.sum(F.rint(F.col("price") * 100).cast("long")).alias("cents"),
            F.count("price").alias("priced"),
        )
    )


def _product_rows(visits: DataFrame) -> DataFrame:
    grouped = visits.groupBy("product_id", "category").agg(
        F.sum("interactions").alias("total_interactions"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("session_id").alias("unique_sessions"),
        F.sum("clicks").alias("num_clicks"),
        F.sum("adds").alias("num_add_to_cart"),
        (F.sum("cents") / F.lit(100.0) / F.nullif(F.sum("priced"), F.lit(0).cast("long"))).alias("avg_price"),
    )
    rate = F.coalesce(rounded_ratio("num_add_to_cart", "num_clicks", 4), F.lit(0.0))
    return grouped.withColumn("click_to_cart_rate", rate)


def _session_days(ev: DataFrame) -> DataFrame:
    """Events reduced to (user, session, date), the common input of two tables."""
    return ev.groupBy("user_id", "session_id", "event_date").agg(
        F.count("*").alias("events"),
        F.min("timestamp").alias("first_at"),
        F.max("timestamp").alias("last_at"),
        count_type("purchase").alias("purchases"),
        money_sum_or_zero("cart_value").alias("revenue"),
        F.count("cart_value").alias("paid_orders"),
    )


def user_metrics(ev: DataFrame) -> DataFrame:
    """Lifetime metrics and segment per user."""
    return _user_rows(_session_days(ev), ev.filter(F.col("product_id").isNotNull()).select("user_id", "product_id"))


def _user_rows(session_days: DataFrame, viewed: DataFrame) -> DataFrame:
    """Metrics from the sessions of all days and the products (user_id, product_id) they touched."""
    activity = (
        session_days
        .groupBy("user_id")
        .agg(
            F.count_distinct("session_id").alias("num_sessions"),
            F.sum("events").alias("total_events"),
            F.count_distinct("event_date").alias("num_active_days"),
            F.min("first_at").alias("first_seen"),
            F.max("last_at").alias("last_seen"),
            F.sum("purchases").alias("total_purchases"),
            money_sum_or_zero("revenue").alias("total_revenue"),
        )
    )
    products = viewed.groupBy("user_id").agg(F.count_distinct("product_id").alias("unique_products_viewed"))
    per_purchase = F.coalesce(rounded_ratio("total_revenue", "total_purchases", 2), F.lit(0.0))
    return user_segments(
        activity.join(products, "user_id", "left").withColumns(
            {
                "unique_products_viewed": F.coalesce("unique_products_viewed", F.lit(0).cast("long")),
                "days_active": F.datediff("last_seen", "first_seen") + 1,
                "avg_events_per_session": rounded_ratio("total_events", "num_sessions", 2),
                "avg_revenue_per_purchase": per_purchase,
            }
        )
    )


def user_segments(users: DataFrame) -> DataFrame:
    """Segment by purchases, then by number of sessions."""
    return users.withColumn(
        "user_segment",
        F.when(F.col("total_purchases") >= 5, "High Value")
        .when(F.col("total_purchases") >= 1, "Converted")
        .when(F.col("num_sessions") >= 3, "Engaged")
        .otherwise("New/Inactive"),
    )


def daily_metrics(ev: DataFrame) -> DataFrame:
    """Traffic, revenue and conversion per day, in date order."""
    return _daily_rows(_session_days(ev))


def _daily_rows(session_days: DataFrame) -> DataFrame:
    return (
        session_days
        .groupBy("event_date")
        .agg(
            F.sum("events").alias("total_events"),
            F.count_distinct("user_id").alias("unique_users"),
            F.count_distinct("session_id").alias("unique_sessions"),
            F.sum("purchases").alias("total_purchases"),
            money_sum_or_zero("revenue").alias("total_revenue"),
            F.sum("paid_orders").alias("paid_orders"),
        )
        .withColumn("avg_order_value", ratio("total_revenue", "paid_orders"))
        .withColumn("conversion_rate", rounded_ratio("total_purchases", "unique_sessions", 2, 100))
        .drop("paid_orders")
        .orderBy("event_date")
    )


def insight_last7_days(daily: DataFrame) -> DataFrame:
    return daily.orderBy(F.desc("event_date")).limit(7)


def insight_segment_distribution(users: DataFrame) -> DataFrame:
    return (
        users.groupBy("user_segment")
        .agg(F.count("*").alias("num_users"), money_sum_or_zero("total_revenue").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "user_segment")
    )


def insight_top10_products(products: DataFrame) -> DataFrame:
    return products.orderBy(F.desc("total_interactions"), "product_id", "category").limit(10)


def insight_session_conversion(sessions: DataFrame) -> DataFrame:
    return sessions.agg(
        F.count("*").alias("total_sessions"),
        F.sum("converted").alias("converted_sessions"),
        mean("converted", 2, 100).alias("conversion_rate_pct"),
        mean("session_duration_seconds").alias("avg_session_duration"),
        mean("num_events").alias("avg_events_per_session"),
    )


def run_etl(raw: DataFrame, output: str) -> dict[str, str]:
    """Write the cleaned events, then the four metric tables; returns the paths.

    The metric tables read the written events back instead of a cache: each scan
    is limited to the columns it needs, and a lost executor costs no recomputation
    of the cleaning step.
    """
    paths = {name: f"{output}/{name}" for name in ETL_TABLES}
    write_parquet(clean_events(raw), paths["fact_events"], ETL_TABLES["fact_events"][1])
    ev = raw.sparkSession.read.parquet(paths["fact_events"])
    for name, (build, partition_by) in ETL_TABLES.items():
        if build is not None:
            write_parquet(build(ev), paths[name], partition_by)
    return paths


# Table names and partition columns of the ETL output.
ETL_TABLES = {
    "fact_events": (None, ["event_date"]),
    "fact_sessions": (session_metrics, ["event_date"]),
    "dim_product_metrics": (product_metrics, None),
    "dim_user_metrics": (user_metrics, None),
    "fact_daily_metrics": (daily_metrics, None),
}


def _state_tables(ev: DataFrame) -> dict[str, DataFrame]:
    """What the metric tables need of each day's events, exact sets included, to be merged over days."""
    return {
        "session_parts": _session_parts(ev),
        "session_days": _session_days(ev),
        "product_visits": _product_visits(ev, "event_date"),
    }


def refresh_etl(raw: DataFrame, output: str) -> dict[str, str]:
    """As ``run_etl``, for the days that ``raw`` has events of, all of each; other days stay.

    The tables become those of a full run over all days. Of the events only the days of
    ``raw`` are read: their part in the metric tables is kept as one row per session, and
    per product and session, in day folders below ``_state``, and the metric tables are
    merged from those. Sessions are rewritten on the days of ``raw``, and on those to
    which one of their sessions goes on. The first call makes the state of days that
    ``run_etl`` wrote.
    """
    spark = raw.sparkSession
    paths = {name: f"{output}/{name}" for name in ETL_TABLES}
    states = {name: f"{output}/_state/{name}" for name in ("session_parts", "session_days", "product_visits")}
    cleaned = stage(clean_events(raw), "refresh-events")
    days = [row[0] for row in cleaned.select("event_date").distinct().collect()]  # as many as the day folders written
    if not days:
        return paths
    of_days = reduce(Column.__or__, [F.col("event_date").eqNullSafe(F.lit(day)) for day in days])

    def written(path: str) -> DataFrame | None:
        try:
            return spark.read.parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    before = written(states["session_parts"])
    if before is None and (events := written(paths["fact_events"])) is not None:
        for name, state in _state_tables(events).items():
            write_parquet(state, states[name], ["event_date"])
        before = spark.read.parquet(states["session_parts"])
    # sessions that had or have rows on these days, and where they go on
    keys = ["session_id", "user_id"]
    touched = cleaned.select(*keys).distinct()
    if before is not None:
        touched = touched.union(before.filter(of_days).select(*keys)).distinct()
    touched = stage(touched, "refresh-sessions")

    write_parquet(cleaned, paths["fact_events"], ["event_date"])
    for name, state in _state_tables(spark.read.parquet(paths["fact_events"]).filter(of_days)).items():
        write_parquet(state, states[name], ["event_date"])
    parts = spark.read.parquet(states["session_parts"])
    others = parts.join(touched, keys, "left_semi").select("event_date").distinct().collect()
    rewritten = reduce(Column.__or__, [F.col("event_date").eqNullSafe(F.lit(row[0])) for row in others], of_days)
    # whole sessions, so that the gap to an earlier day is seen
    sessions = parts.join(parts.filter(rewritten).select(*keys).distinct(), keys, "left_semi")
    write_parquet(_session_rows(sessions).filter(rewritten), paths["fact_sessions"], ["event_date"])

    visits, session_days = spark.read.parquet(states["product_visits"]), spark.read.parquet(states["session_days"])
    write_parquet(_product_rows(visits), paths["dim_product_metrics"])
    write_parquet(_user_rows(session_days, visits.select("user_id", "product_id")), paths["dim_user_metrics"])
    daily = _daily_rows(session_days.filter(of_days))
    if (old := written(paths["fact_daily_metrics"])) is not None:
        daily = stage(old.filter(~of_days).unionByName(daily), "refresh-daily").orderBy("event_date")
    write_parquet(daily, paths["fact_daily_metrics"])
    return paths
