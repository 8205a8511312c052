"""The data under each dashboard chart, report line and notebook cell."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions.exprs import mean, money_avg, money_sum, percent, rounded_ratio
from clickloom.operators.ordered import exact_percentiles, histogram


def _minutes(sessions: DataFrame) -> DataFrame:
    return sessions.select((F.col("session_duration_seconds") / 60.0).alias("minutes"))


def _avg_minutes() -> Column:
    return rounded_ratio(F.sum("session_duration_seconds"), F.count("session_duration_seconds") * 60, 2)


def _total_by(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    return df.groupBy(key).agg(value.alias(name)).orderBy(F.desc(name), key)


# --- daily -----------------------------------------------------------------


def dash_daily_trends(daily: DataFrame) -> DataFrame:
    return daily.select(
        "event_date", "unique_users", "unique_sessions", "total_revenue", "conversion_rate",
        F.round("avg_order_value", 6).alias("avg_order_value"),
    ).orderBy("event_date")


def nb_overall_metrics(daily: DataFrame) -> DataFrame:
    return daily.agg(
        money_sum("total_revenue").alias("total_revenue"),
        F.sum("total_purchases").alias("total_purchases"),
        money_avg("total_revenue").alias("avg_daily_revenue"),
        money_avg("conversion_rate").alias("avg_conversion_rate"),
        F.round(F.avg("avg_order_value"), 2).alias("avg_order_value"),
    )


def nb_describe_daily(daily: DataFrame) -> DataFrame:
    """Count, mean, deviation and quartiles of every numeric column, one row each.

    The exact percentile aggregate is safe here: the input has one row per day.
    """
    numeric = [
        "total_events", "unique_users", "unique_sessions", "total_purchases",
        "total_revenue", "avg_order_value", "conversion_rate",
    ]
    long = daily.select(*[F.col(c).cast("double").alias(c) for c in numeric]).unpivot(
        [], numeric, "metric", "value"
    )
    return long.groupBy("metric").agg(
        F.count("value").alias("count"),
        F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.stddev_samp("value"), 6).alias("std"),
        F.round(F.min("value"), 6).alias("min"),
        F.round(F.percentile("value", 0.25), 6).alias("p25"),
        F.round(F.percentile("value", 0.5), 6).alias("p50"),
        F.round(F.percentile("value", 0.75), 6).alias("p75"),
        F.round(F.max("value"), 6).alias("max"),
    )


# --- segments --------------------------------------------------------------


def dash_segment_share(users: DataFrame) -> DataFrame:
    """Users per segment; the share window runs over one row per segment."""
    counts = users.groupBy("user_segment").agg(F.count("*").alias("num_users"))
    share = percent("num_users", F.sum("num_users").over(Window.partitionBy()), 1)
    return counts.withColumn("share_pct", share).orderBy(F.desc("num_users"), "user_segment")


def dash_segment_revenue(users: DataFrame) -> DataFrame:
    return _total_by(users, "user_segment", money_sum("total_revenue"), "total_revenue")


# --- sessions --------------------------------------------------------------


def dash_duration_histogram(sessions: DataFrame, max_minutes: int = 60, bins: int = 30) -> DataFrame:
    return histogram(_minutes(sessions).filter(F.col("minutes") < max_minutes), "minutes", bins)


def dash_events_histogram(sessions: DataFrame, max_events: int = 50, bins: int = 30) -> DataFrame:
    return histogram(sessions.filter(F.col("num_events") < max_events), "num_events", bins)


def dash_sessions_by_device(sessions: DataFrame) -> DataFrame:
    return _total_by(sessions, "device", F.count("*"), "num_sessions")


def dash_conversion_by_device(sessions: DataFrame) -> DataFrame:
    rate = mean("converted", 6, 100)
    return sessions.groupBy("device").agg(rate.alias("conversion_rate")).orderBy("device")


def nb_duration_histogram_median(sessions: DataFrame, max_minutes: int = 30, bins: int = 50) -> DataFrame:
    """Histogram of short sessions, each row with the exact median of all sessions."""
    minutes = _minutes(sessions)
    median = exact_percentiles(minutes, "minutes", {"median": 0.5}).scalar()
    return histogram(minutes.filter(F.col("minutes") < max_minutes), "minutes", bins).withColumn(
        "median_minutes", F.round(median, 6)
    )


def nb_conversion_by_device(sessions: DataFrame) -> DataFrame:
    grouped = sessions.groupBy("device").agg(
        F.count("session_id").alias("sessions"), F.sum("converted").alias("converted")
    )
    return grouped.withColumn(
        "conversion_rate", rounded_ratio("converted", "sessions", 6, 100)
    ).orderBy("device")


# --- products --------------------------------------------------------------


def dash_top15_products(products: DataFrame) -> DataFrame:
    return (
        products.select("product_id", "category", "total_interactions")
        .orderBy(F.desc("total_interactions"), "product_id", "category")
        .limit(15)
    )


def dash_category_interactions(products: DataFrame) -> DataFrame:
    return _total_by(products, "category", F.sum("total_interactions"), "total_interactions")


def dash_click_to_cart_histogram(products: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(products.filter(F.col("click_to_cart_rate") > 0), "click_to_cart_rate", bins)


def _hash_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Up to n rows in an order drawn from a hash of the key, the same on every run."""
    return df.orderBy(F.md5(F.concat_ws("-", F.col(key), F.lit(str(seed)))), *df.columns).limit(n)


def dash_price_interactions_sample(products: DataFrame, n: int = 1000) -> DataFrame:
    return _hash_sample(products, "product_id", n, 42).select(
        "product_id", "category", F.round("avg_price", 6).alias("avg_price"), "total_interactions", "unique_users"
    )


def nb_category_performance(products: DataFrame) -> DataFrame:
    rate_units = F.rint(F.col("click_to_cart_rate") * 10000).cast("long")
    return (
        products.groupBy("category")
        .agg(
            F.sum("total_interactions").alias("total_interactions"),
            F.sum("unique_users").alias("unique_users"),
            F.sum("num_add_to_cart").alias("num_add_to_cart"),
            rounded_ratio(F.sum(rate_units), F.count("click_to_cart_rate") * 10000, 6).alias("click_to_cart_rate"),
        )
        .orderBy(F.desc("total_interactions"), "category")
    )


# --- whole report ----------------------------------------------------------


def report_summary(daily: DataFrame, users: DataFrame, sessions: DataFrame, products: DataFrame) -> DataFrame:
    """Every figure of the summary report as (section, metric, value)."""

    def section(name: str, totals: DataFrame) -> DataFrame:
        figures = totals.select(*[F.col(c).cast("double").alias(c) for c in totals.columns])
        return figures.unpivot([], figures.columns, "metric", "value").select(F.lit(name).alias("section"), "metric", "value")

    def listed(name: str, df: DataFrame, prefix: str, label: str, value: str) -> DataFrame:
        return df.select(
            F.lit(name).alias("section"),
            F.concat(F.lit(f"{prefix}: "), F.col(label)).alias("metric"),
            F.col(value).cast("double").alias("value"),
        )

    shares = dash_segment_share(users)
    top = products.orderBy(F.desc("total_interactions"), "product_id", "category").limit(5)
    parts = [
        section("overall", daily.agg(
            money_sum("total_revenue").alias("total_revenue"),
            F.sum("total_purchases").alias("total_purchases"),
            money_avg("conversion_rate").alias("avg_conversion_rate"),
        )),
        section("users", users.agg(
            F.count("*").alias("total_users"),
            mean("num_sessions").alias("avg_sessions_per_user"),
            money_avg("total_revenue").alias("avg_revenue_per_user"),
        )),
        listed("users", shares, "users in segment", "user_segment", "num_users"),
        listed("users", shares, "percent in segment", "user_segment", "share_pct"),
        section("sessions", sessions.agg(
            F.count("*").alias("total_sessions"),
            mean("num_events").alias("avg_events_per_session"),
            _avg_minutes().alias("avg_session_minutes"),
            mean("converted", 2, 100).alias("conversion_rate"),
        )),
        section("products", products.agg(
            F.count("*").alias("total_products"),
            mean("total_interactions").alias("avg_interactions_per_product"),
        )),
        listed("products", top, "top product", "product_id", "total_interactions"),
    ]
    return reduce(DataFrame.unionByName, parts)


def nb_key_insights(users: DataFrame, sessions: DataFrame, products: DataFrame) -> DataFrame:
    """One row: best segment, category and device, and two session averages."""

    def best(totals: DataFrame, key: str, value: str) -> Column:
        # the first name wins among equal values
        return totals.agg(F.min_by(key, F.struct(-F.col(value), F.col(key)))).scalar()

    return sessions.agg(
        _avg_minutes().alias("avg_session_minutes"),
        mean("converted", 2, 100).alias("conversion_rate"),
    ).select(
        best(dash_segment_revenue(users), "user_segment", "total_revenue").alias("top_segment"),
        "avg_session_minutes",
        "conversion_rate",
        best(dash_category_interactions(products), "category", "total_interactions").alias("top_category"),
        best(nb_conversion_by_device(sessions), "device", "conversion_rate").alias("best_device"),
    )


# --- model outputs ---------------------------------------------------------


def dash_probability_histogram(conversion: DataFrame, churn: DataFrame, bins: int = 50) -> DataFrame:
    def tagged(df: DataFrame, column: str, model: str) -> DataFrame:
        return histogram(df, column, bins).select(F.lit(model).alias("model"), "*")

    return tagged(conversion, "conversion_probability", "conversion").unionByName(
        tagged(churn, "churn_probability", "churn")
    )


def dash_risk_counts(conversion: DataFrame, churn: DataFrame) -> DataFrame:
    def counted(df: DataFrame, column: str, model: str) -> DataFrame:
        return df.groupBy(F.col(column).alias("risk")).agg(F.count("*").alias("num_rows")).select(
            F.lit(model).alias("model"), "risk", "num_rows"
        )

    return counted(conversion, "conversion_risk", "conversion").unionByName(
        counted(churn, "churn_risk", "churn")
    ).orderBy("model", F.desc("num_rows"), "risk")


def dash_ltv_actual_vs_predicted(ltv: DataFrame, n: int = 1000) -> DataFrame:
    return _hash_sample(ltv, "user_id", n, 42).select("user_id", "actual_revenue", "predicted_ltv_90days")


def dash_ltv_categories(ltv: DataFrame) -> DataFrame:
    return _total_by(ltv, "ltv_category", F.count("*"), "num_users")


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    """The n most important features of each model."""
    best = Window.partitionBy("model").orderBy(F.desc("importance"), "feature")
    return importance.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n).orderBy("model", "rank")


def nb_model_metrics(metrics: DataFrame) -> DataFrame:
    """Metrics side by side: one row per metric, one column per model."""
    return metrics.groupBy("metric").pivot("model", ["conversion", "churn", "ltv"]).agg(F.first("value")).orderBy("metric")


def nb_actual_conversion_by_risk(conversion: DataFrame) -> DataFrame:
    return (
        conversion.groupBy("conversion_risk")
        .agg(mean("actual_converted", 6, 100).alias("actual_conversion_rate"))
        .orderBy("conversion_risk")
    )


def nb_retention_priority_histogram(churn: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(churn, "retention_priority", bins)


def nb_avg_ltv_by_category(ltv: DataFrame) -> DataFrame:
    return (
        ltv.groupBy("ltv_category")
        .agg(F.round(F.avg("predicted_ltv_90days"), 4).alias("avg_predicted_ltv"))
        .orderBy("ltv_category")
    )


def nb_retention_targets(churn: DataFrame, n: int = 20) -> DataFrame:
    """Valuable users likely to leave, each row with the size of the whole group."""
    risky = churn.filter((F.col("churn_risk") == "High") & (F.col("total_revenue") > 200))
    whole = risky.agg(
        F.struct(F.count("*").alias("n"), money_sum("total_revenue").alias("revenue"))
    ).scalar()
    return (
        risky.select("user_id", "churn_probability", "total_revenue", "retention_priority")
        .orderBy(F.desc("retention_priority"), "user_id")
        .limit(n)
        .select("*", whole["n"].alias("num_targets"), whole["revenue"].alias("revenue_at_risk"))
    )


def nb_high_probability_sessions(conversion: DataFrame, threshold: float = 0.7) -> DataFrame:
    return conversion.filter(F.col("conversion_probability") > threshold).agg(
        F.count("*").alias("num_sessions"),
        mean("actual_converted", 1, 100).alias("actual_conversion_rate"),
    )


def nb_vip_customers(ltv: DataFrame, n: int = 10) -> DataFrame:
    """The most valuable VIP users, each row with count, sum and mean of the group."""
    vip = ltv.filter(F.col("ltv_category") == "VIP")
    whole = vip.agg(
        F.struct(
            F.count("*").alias("n"),
            money_sum("predicted_ltv_90days").alias("total"),
            money_avg("predicted_ltv_90days").alias("mean"),
        )
    ).scalar()
    return (
        vip.select("user_id", "actual_revenue", "predicted_ltv_90days", "ltv_category")
        .orderBy(F.desc("predicted_ltv_90days"), "user_id")
        .limit(n)
        .select(
            "*", whole["n"].alias("num_vip"), whole["total"].alias("vip_revenue"), whole["mean"].alias("avg_vip_ltv")
        )
    )
