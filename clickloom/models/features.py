"""Feature tables for the three models, row ids and labels included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions.exprs import ratio

# The numeric features of each model, in order.
CONVERSION_NUMERIC = [
    "num_events", "num_page_views", "num_product_clicks", "num_add_to_cart",
    "session_duration_seconds", "avg_time_between_events", "num_unique_event_types",
    "events_per_minute", "cart_to_click_ratio",
]
CHURN_NUMERIC = [
    "num_sessions", "total_events", "num_active_days", "avg_events_per_session",
    "days_since_last_seen", "total_purchases", "total_revenue", "avg_revenue_per_purchase",
    "unique_products_viewed", "days_active", "purchase_frequency", "engagement_score",
]
LTV_NUMERIC = [
    "num_sessions", "total_events", "num_active_days", "total_purchases",
    "unique_products_viewed", "days_active", "avg_events_per_session", "revenue_per_session",
    "purchase_rate", "days_since_first_seen", "product_diversity",
]


def at_least_one(c: str) -> Column:
    return F.greatest(F.col(c), F.lit(1))


def levels_of(df: DataFrame, column: str) -> list[str]:
    """The distinct values of a categorical column, sorted.

    They become column names, so the driver has to know them. Columns of free text
    are better left as they are: training encodes them as sparse vectors.
    """
    return sorted(row[0] for row in df.select(column).distinct().filter(F.col(column).isNotNull()).collect())


def one_hot(df: DataFrame, column: str, prefix: str, levels: list[str] | None = None) -> DataFrame:
    """Add a 0/1 column ``<prefix>_<level>`` per value; a NULL gets all zeros."""
    levels = levels_of(df, column) if levels is None else levels
    return df.withColumns(
        {f"{prefix}_{v}": F.when(F.col(column) == v, 1).otherwise(0) for v in levels}
    )


def _feature_table(df: DataFrame, row_id: str, numeric: list[str], dummies: list[str], label: Column) -> DataFrame:
    """Row id, numeric features as doubles without NULL or NaN, dummies, label."""

    def filled(name: str) -> Column:
        return F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(name)

    return df.select(row_id, *[filled(c) for c in numeric], *[F.col(f"`{d}`") for d in dummies], label.alias("label"))


def conversion_features(sessions: DataFrame, encode: bool = True) -> DataFrame:
    """Behaviour and channel of a session; label: it contained a purchase.

    Without ``encode`` the channel columns stay text, whatever number of values
    they have, and training encodes them.
    """
    df = sessions.withColumns(
        {
            "events_per_minute": F.col("num_events") / (at_least_one("session_duration_seconds") / 60.0),
            "cart_to_click_ratio": ratio("num_add_to_cart", at_least_one("num_product_clicks")),
        }
    )
    dummies: list[str] = []
    for column in ("device", "browser", "referrer"):
        if column in sessions.columns and not encode:
            dummies.append(column)
        elif column in sessions.columns:
            levels = levels_of(sessions, column)
            df = one_hot(df, column, column, levels)
            dummies += [f"{column}_{v}" for v in levels]
    return _feature_table(df, "session_id", CONVERSION_NUMERIC, dummies, F.col("converted").cast("int"))


def _days_before(latest: Column, c: str) -> Column:
    """Whole days from a timestamp to the latest one."""
    day = 24 * 3600 * 1_000_000
    return F.floor((F.unix_micros(latest) - F.unix_micros(c)) / F.lit(day))


def _with_segments(df: DataFrame) -> tuple[DataFrame, list[str]]:
    levels = levels_of(df, "user_segment")
    return one_hot(df, "user_segment", "segment", levels), [f"segment_{v}" for v in levels]


def churn_features(users: DataFrame, quiet_days: int = 7) -> DataFrame:
    """Engagement of a user; label: not seen for more than ``quiet_days`` days.

    days_since_last_seen is both a feature and the base of the label. This leak is
    part of the specified feature list and is kept.
    """
    latest = users.agg(F.max("last_seen")).scalar()
    df = users.withColumns(
        {
            "days_since_last_seen": _days_before(latest, "last_seen"),
            "purchase_frequency": ratio("total_purchases", at_least_one("num_sessions")),
            "engagement_score": F.col("num_sessions") * F.col("avg_events_per_session") / at_least_one("days_active"),
        }
    )
    df, dummies = _with_segments(df)
    label = F.when(F.col("days_since_last_seen") > quiet_days, 1).otherwise(0)
    return _feature_table(df.withColumn("_label", label), "user_id", CHURN_NUMERIC, dummies, F.col("_label"))


def ltv_features(users: DataFrame) -> DataFrame:
    """Engagement of a user; label: total revenue.

    revenue_per_session contains the label, and "90 days" is not a window on the
    data. Both are part of the specified feature list and are kept.
    """
    latest = users.agg(F.max("last_seen")).scalar()
    df = users.withColumns(
        {
            "revenue_per_session": ratio("total_revenue", at_least_one("num_sessions")),
            "purchase_rate": ratio("total_purchases", at_least_one("num_sessions")),
            "days_since_first_seen": _days_before(latest, "first_seen"),
            "product_diversity": ratio("unique_products_viewed", at_least_one("total_events")),
        }
    )
    df, dummies = _with_segments(df)
    return _feature_table(df, "user_id", LTV_NUMERIC, dummies, F.col("total_revenue").cast("double"))
