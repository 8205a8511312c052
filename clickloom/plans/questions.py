"""Business questions asked of the warehouse in plain language, answered as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.exprs import is_type, mean, money_avg, money_sum, percent


def _purchases_by_product(events: DataFrame) -> DataFrame:
    """Purchases and cents per product; the hot products are reduced before any join."""
    return (
        events.filter(is_type("purchase") & F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.count("*").alias("purchases"), money_sum("cart_value").alias("revenue"))
    )


def ask_top10_products_by_revenue(events: DataFrame, products: DataFrame) -> DataFrame:
    return (
        _purchases_by_product(events)
        .join(products.select("product_id", "product_name", "category"), "product_id")
        .select("product_id", "product_name", "category", F.round("revenue", 2).alias("total_revenue"))
        .orderBy(F.desc_nulls_last("total_revenue"), "product_id")
        .limit(10)
    )


def ask_conversion_by_device(sessions: DataFrame) -> DataFrame:
    return (
        sessions.groupBy("device")
        .agg(F.count("*").alias("total_sessions"), F.count_if("converted").alias("converted_sessions"))
        .withColumn("conversion_rate", percent("converted_sessions", "total_sessions"))
        .orderBy(F.desc("conversion_rate"), "device")
    )


def ask_users_per_segment(users: DataFrame) -> DataFrame:
    return (
        users.groupBy("user_segment")
        .agg(F.count("*").alias("num_users"), F.round(money_sum("total_revenue"), 2).alias("total_revenue"))
        .orderBy(F.desc("num_users"), "user_segment")
    )


def ask_daily_revenue_trend(daily: DataFrame, last_days: int | None = None) -> DataFrame:
    """Daily KPIs by date, optionally of the most recent days only."""
    days = daily.select(
        "metric_date", "unique_users", "unique_sessions", "total_purchases",
        F.round(F.col("total_revenue").cast("double"), 2).alias("total_revenue"), "conversion_rate",
    )
    if last_days is not None:
        days = days.orderBy(F.desc("metric_date")).limit(last_days)
    return days.orderBy("metric_date")


def ask_highest_churn_risk(churn: DataFrame, users: DataFrame, n: int = 20) -> DataFrame:
    return (
        churn.join(users.select("user_id", "user_segment"), "user_id")
        .select(
            "user_id", "user_segment",
            F.round(F.col("churn_probability").cast("double"), 4).alias("churn_probability"),
            "churn_risk",
            F.round(F.col("retention_priority_score").cast("double"), 2).alias("retention_priority"),
        )
        .orderBy(F.desc("churn_probability"), "user_id")
        .limit(n)
    )


def ask_avg_duration_by_browser(sessions: DataFrame) -> DataFrame:
    return (
        sessions.groupBy("browser")
        .agg(mean("session_duration_seconds").alias("avg_session_duration"))
        .orderBy(F.desc("avg_session_duration"), "browser")
    )


def ask_top5_categories_by_purchases(events: DataFrame, products: DataFrame) -> DataFrame:
    return (
        _purchases_by_product(events)
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("purchases").alias("num_purchases"))
        .orderBy(F.desc("num_purchases"), "category")
        .limit(5)
    )


def ask_revenue_by_category(events: DataFrame, products: DataFrame) -> DataFrame:
    return (
        _purchases_by_product(events)
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(money_sum("revenue").alias("total_revenue"))
        .orderBy(F.desc_nulls_last("total_revenue"), "category")
    )


def ask_vip_predicted_ltv(ltv: DataFrame) -> DataFrame:
    return ltv.filter(F.col("ltv_category") == "VIP").agg(
        F.count("*").alias("vip_users"),
        money_sum("predicted_ltv_90days").alias("total_predicted_ltv"),
        money_avg("predicted_ltv_90days").alias("avg_predicted_ltv"),
    )


def limit_result(df: DataFrame, n: int = 100) -> DataFrame:
    """Cap the rows of an ad-hoc answer; always applied."""
    return df.limit(n)
