"""Clickstream view over the event and part tables.

The stored events carry no session, product or device. They are derived here so
that the ETL has a complete click record to work on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickloom.functions.exprs import pick

SESSION_GAP_HOURS = 12
# Share (in hundredths) of clicks on the first HEAD_PRODUCTS products; the others fall on all products alike.
HEAD_CLICKS = 60
HEAD_PRODUCTS = 20

# The domains of the derived columns.
PAGE_TYPES = ["home", "category", "product", "cart", "checkout", "account", "search"]
DEVICES = ["desktop", "mobile", "tablet"]
BROWSERS = ["Chrome", "Firefox", "Safari", "Edge"]
PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "apple_pay"]
REFERRERS = [
    "direct", "google.com", "facebook.com", "instagram.com",
    "twitter.com", "email_campaign", "organic_search", "paid_ad",
]
SEARCH_TERMS = [
    "laptop", "headphones", "shoes", "book", "camera",
    "phone", "watch", "desk", "chair", "backpack",
]


def number_sessions(
    events: DataFrame, user: str, timestamp: str, gap_hours: int = SESSION_GAP_HOURS
) -> DataFrame:
    """Add ``session_number``: a new session starts after a pause of more than the gap.

    A slot of the gap's own length cannot contain such a pause, so boundaries lie
    only between slots. Events are first reduced to (user, slot) with their first
    and last time, the running count is taken over those few rows, and the number
    is joined back per slot. A single very active user is therefore spread over
    its slots instead of being sorted in one task.
    """
    gap = gap_hours * 3600 * 1_000_000
    slot = F.floor(F.unix_micros(timestamp) / F.lit(gap)).alias("_slot")
    slotted = events.select("*", slot)
    slots = slotted.groupBy(user, "_slot").agg(
        F.min(F.unix_micros(timestamp)).alias("first_at"),
        F.max(F.unix_micros(timestamp)).alias("last_at"),
    )
    by_user = Window.partitionBy(user).orderBy("_slot")
    pause = F.col("first_at") - F.lag("last_at").over(by_user)
    numbered = (
        slots.withColumn("starts", F.when(pause <= gap, 0).otherwise(1))
        .withColumn(
            "session_number",
            F.sum("starts").over(by_user.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .select(user, "_slot", "session_number")
    )
    return slotted.join(numbered, [user, "_slot"]).drop("_slot")


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw click records (EVENT_COLUMNS) derived from the stored tables."""
    stored = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    based = stored.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        k.alias("k"),
        F.expr(
            "cast(ts + cast(user_id % 6 as int) * interval '20' day as timestamp)"
        ).alias("timestamp"),
    )
    sessions = number_sessions(based, "user_id", "timestamp")

    buys = (F.col("user_id") % 4 == 0) | (F.col("event_id") % 8 == 0)
    event_type = (
        F.when(F.col("event_type") == "view", "page_view")
        .when(F.col("event_type") == "click", "product_click")
        .when(F.col("event_type") == "signup", "add_to_cart")
        .when(F.col("event_type") == "error", "checkout")
        .when(F.col("event_type") == "purchase", F.when(buys, "purchase").otherwise("remove_from_cart"))
    )
    typed = sessions.withColumn("event_type", event_type).withColumn(
        "page_type", pick(F.col("event_id") % 7, PAGE_TYPES)
    )
    on_product = F.col("event_type").isin(
        "product_click", "add_to_cart", "remove_from_cart", "purchase"
    )
    in_cart = F.col("event_type").isin("add_to_cart", "remove_from_cart")
    paid = (F.col("event_type") == "purchase") & (F.col("k") % 10 != 0)
    products = spark.read.parquet(f"{sf_dir}/part.parquet").agg(F.count("*")).scalar()
    product = F.when(F.col("k") < HEAD_CLICKS, F.col("k") % HEAD_PRODUCTS).otherwise(F.col("event_id") % products)
    shaped = typed.withColumn("product_id", F.when(on_product, product.cast("string")))
    goods = product_catalog(spark, sf_dir).select("product_id", "category", "price")
    return shaped.join(goods, "product_id", "left").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("session_number").cast("string")).alias("session_id"),
        F.col("user_id").cast("string").alias("user_id"),
        "timestamp",
        "event_type",
        "page_type",
        "product_id",
        "category",
        "price",
        F.when(in_cart, 1 + F.col("k") % 4).alias("cart_size"),
        F.when(paid, F.col("value")).alias("cart_value"),
        F.when(paid, (1 + F.col("event_id") % 5).cast("int")).alias("num_items"),
        F.when(paid, pick(F.col("event_id") % 4, PAYMENT_METHODS)).alias("payment_method"),
        pick(F.col("user_id") % 3, DEVICES).alias("device"),
        pick(F.col("user_id") % 4, BROWSERS).alias("browser"),
        F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit(".1")).alias("ip_address"),
        pick(F.col("event_id") % 8, REFERRERS).alias("referrer"),
        F.when(
            F.col("page_type") == "search",
            F.concat_ws(" ", pick(F.col("k") % 10, SEARCH_TERMS), (F.col("event_id") % 5).cast("string")),
        ).alias("search_query"),
    )


def product_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog of all products, the stored parts."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    return parts.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") * 10).alias("stock_quantity"),
        (1 + F.col("p_partkey") % 5).cast("double").alias("rating"),
        (F.col("p_partkey") * 7).cast("int").alias("num_reviews"),
    )
