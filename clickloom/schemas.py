"""Table definitions: raw inputs and the star-schema warehouse.

Counts are ``bigint`` and amounts ``decimal(18,2)``: the scale is the two digits
of the data model, the precision leaves room for totals over very large inputs.
"""

from __future__ import annotations

from dataclasses import dataclass, field


def columns_of(ddl: str) -> dict[str, str]:
    """Column name to type name."""
    return dict(column.split(" ", 1) for column in ddl.split(", "))


# Column names and types of the event record.
EVENT_COLUMNS = columns_of(
    "event_id string, session_id string, user_id string, timestamp timestamp, "
    "event_type string, page_type string, product_id string, category string, "
    "price double, cart_size int, cart_value double, num_items int, "
    "payment_method string, device string, browser string, ip_address string, "
    "referrer string, search_query string"
)

# Column names and types of the product catalog.
CATALOG_COLUMNS = columns_of(
    "product_id string, product_name string, category string, price double, "
    "stock_quantity int, rating double, num_reviews int"
)


@dataclass(frozen=True)
class TableSpec:
    """Columns, key and constraints of one warehouse table."""

    name: str
    columns: dict[str, str]
    key: tuple[str, ...]
    tie_break: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)


def _spec(name: str, ddl: str, key: str, **rest) -> TableSpec:
    return TableSpec(name, columns_of(ddl), tuple(key.split()), **rest)


# Names, columns and keys of the warehouse tables.
WAREHOUSE: dict[str, TableSpec] = {
    s.name: s
    for s in (
        _spec(
            "dim_users",
            "user_id string, first_seen timestamp, last_seen timestamp, num_sessions bigint, "
            "total_events bigint, num_active_days bigint, total_purchases bigint, "
            "total_revenue decimal(18,2), unique_products_viewed bigint, days_active int, "
            "avg_events_per_session decimal(18,2), avg_revenue_per_purchase decimal(18,2), "
            "user_segment string",
            "user_id",
        ),
        _spec(
            "dim_products",
            "product_id string, product_name string, category string, price decimal(18,2), "
            "stock_quantity int, rating decimal(3,2), num_reviews int",
            "product_id",
        ),
        _spec(
            "dim_product_metrics",
            "product_id string, category string, total_interactions bigint, unique_users bigint, "
            "unique_sessions bigint, num_clicks bigint, num_add_to_cart bigint, "
            "avg_price decimal(18,2), click_to_cart_rate decimal(18,4)",
            "product_id",
            tie_break=("category",),
            foreign_keys={"product_id": ("dim_products", "product_id")},
        ),
        _spec(
            "dim_date",
            "date_key date, year int, month int, day int, quarter int, day_of_week int, "
            "day_name string, month_name string, is_weekend boolean, is_holiday boolean",
            "date_key",
        ),
        _spec("dim_device", "device_id int, device_type string, browser string", "device_type browser"),
        _spec(
            "fact_events",
            "event_id string, session_id string, user_id string, timestamp timestamp, "
            "event_date date, event_type string, page_type string, product_id string, "
            "category string, price decimal(18,2), cart_size int, cart_value decimal(18,2), "
            "num_items int, payment_method string, device string, browser string, "
            "ip_address string, referrer string, search_query string, event_hour int, "
            "event_day_of_week int, event_month int, event_year int",
            "event_id",
            tie_break=("timestamp", "session_id"),
            not_null=("session_id", "user_id", "timestamp", "event_date", "event_type"),
            foreign_keys={
                "user_id": ("dim_users", "user_id"),
                "product_id": ("dim_products", "product_id"),
                "event_date": ("dim_date", "date_key"),
            },
        ),
        _spec(
            "fact_sessions",
            "session_id string, user_id string, event_date date, session_start timestamp, "
            "session_end timestamp, session_duration_seconds bigint, num_events bigint, "
            "num_unique_event_types bigint, device string, browser string, referrer string, "
            "num_page_views bigint, num_product_clicks bigint, num_add_to_cart bigint, "
            "num_purchases bigint, total_cart_value decimal(18,2), items_purchased int, "
            "avg_time_between_events decimal(18,2), converted boolean",
            "session_id",
            tie_break=("event_date", "user_id"),
            not_null=("user_id", "event_date", "session_start", "session_end"),
            foreign_keys={
                "user_id": ("dim_users", "user_id"),
                "event_date": ("dim_date", "date_key"),
            },
        ),
        _spec(
            "fact_daily_metrics",
            "metric_date date, total_events bigint, unique_users bigint, unique_sessions bigint, "
            "total_purchases bigint, total_revenue decimal(18,2), avg_order_value decimal(18,2), "
            "conversion_rate decimal(18,2)",
            "metric_date",
            foreign_keys={"metric_date": ("dim_date", "date_key")},
        ),
        _spec(
            "ml_conversion_predictions",
            "session_id string, prediction_timestamp timestamp, "
            "conversion_probability decimal(5,4), predicted_converted boolean, "
            "conversion_risk string, actual_converted boolean",
            "session_id",
            foreign_keys={"session_id": ("fact_sessions", "session_id")},
        ),
        _spec(
            "ml_churn_predictions",
            "user_id string, prediction_timestamp timestamp, churn_probability decimal(5,4), "
            "predicted_churned boolean, churn_risk string, "
            "retention_priority_score decimal(18,2), actual_churned boolean",
            "user_id",
            foreign_keys={"user_id": ("dim_users", "user_id")},
        ),
        _spec(
            "ml_ltv_predictions",
            "user_id string, prediction_timestamp timestamp, predicted_ltv_90days decimal(18,2), "
            "ltv_category string, actual_revenue decimal(18,2)",
            "user_id",
            foreign_keys={"user_id": ("dim_users", "user_id")},
        ),
    )
}
