"""Warehouse tables: typed projections of the ETL output, summary tables and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, FloatType

from clickloom.functions.exprs import (
    count_type, money_sum_or_zero, percent, purchase_amount, rounded_ratio, week_start,
)
from clickloom.schemas import WAREHOUSE, TableSpec
from clickloom.session import stage

RUN_COLUMNS = ("prediction_timestamp",)  # differ from run to run


def _typed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Those of the columns that the input has, cast, with NaN turned into NULL."""

    def as_typed(name: str, target: str) -> Column:
        c = F.col(name)
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            c = F.when(~F.isnan(c), c)
            if target.startswith("decimal"):
                # drops the noise of binary fractions before rounding half up
                c = c.cast("decimal(28,10)")
        return c.cast(target).alias(name)

    return df.select(*[as_typed(name, kind) for name, kind in columns.items() if name in df.columns])


def load_warehouse_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Project onto the table's columns and keep one row per primary key.

    Rows without a complete key cannot be loaded; ``rejected_rows`` counts them.
    Among duplicates the first by the table's tie-break columns stays, then the first
    by a hash of what does not depend on the time of the run. Repeated
    keys are found first, from the key columns alone. They are usually few, so the
    joins on them broadcast (their written size decides) and the wide rows with
    unique keys are neither shuffled nor sorted.
    """
    keys = list(spec.key)
    typed = _typed(df, spec.columns).dropna(subset=keys)
    repeated = stage(typed.groupBy(*keys).count().filter("count > 1").select(*keys), "repeated_keys")
    content = [c for c in typed.columns if c not in RUN_COLUMNS]
    first = Window.partitionBy(*keys).orderBy(*spec.tie_break, F.xxhash64(*content))
    resolved = (
        typed.join(repeated, keys, "left_semi")
        .withColumn("_rank", F.row_number().over(first))
        .filter("_rank = 1")
        .drop("_rank")
    )
    return typed.join(repeated, keys, "left_anti").unionByName(resolved)


def load_grouped_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Load a table whose producer groups by the primary key, so that no key repeats."""
    return _typed(df, spec.columns).dropna(subset=list(spec.key))


def rejected_rows(df: DataFrame, table: str, spec: TableSpec) -> DataFrame:
    """One row: how many rows a load leaves out because their key is not complete."""
    without = reduce(Column.__or__, [F.col(k).isNull() for k in spec.key])
    return df.agg(F.count_if(without).alias("rejected_rows")).select(F.lit(table).alias("table_name"), "rejected_rows")


def dim_date(daily: DataFrame) -> DataFrame:
    """Calendar rows for the dates that occur; weekday 0 is Monday."""
    d = F.col("date_key")
    date_col = "event_date" if "event_date" in daily.columns else "metric_date"
    return daily.select(F.col(date_col).alias("date_key")).distinct().select(
        "date_key",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def dim_users(users: DataFrame) -> DataFrame:
    return load_grouped_table(users, WAREHOUSE["dim_users"])


def dim_products(catalog: DataFrame) -> DataFrame:
    return load_warehouse_table(catalog, WAREHOUSE["dim_products"])


def dim_product_metrics(products: DataFrame) -> DataFrame:
    return load_warehouse_table(products, WAREHOUSE["dim_product_metrics"])


def dim_device(ev: DataFrame) -> DataFrame:
    """Distinct device and browser pairs with a stable id.

    The window has no partition, but runs over the few distinct pairs only.
    """
    pairs = ev.select(F.col("device").alias("device_type"), "browser").distinct()
    return pairs.select(
        F.row_number().over(Window.orderBy("device_type", "browser")).alias("device_id"),
        "device_type",
        "browser",
    )


def fact_events(ev: DataFrame) -> DataFrame:
    return load_warehouse_table(ev, WAREHOUSE["fact_events"])


def fact_sessions(sessions: DataFrame) -> DataFrame:
    """One row per session: a session that crosses midnight keeps its first date."""
    return load_warehouse_table(sessions, WAREHOUSE["fact_sessions"])


def fact_daily_metrics(daily: DataFrame) -> DataFrame:
    renamed = daily.withColumnRenamed("event_date", "metric_date")
    return load_grouped_table(renamed, WAREHOUSE["fact_daily_metrics"])


def agg_product_daily(ev: DataFrame) -> DataFrame:
    """Per product and day: views, clicks, cart additions, purchases, revenue, users."""
    by_user = (
        ev.filter(F.col("product_id").isNotNull())
        .groupBy("product_id", "event_date", "user_id")
        .agg(
            count_type("page_view").alias("views"),
            count_type("product_click").alias("clicks"),
            count_type("add_to_cart").alias("adds"),
            count_type("purchase").alias("purchases"),
            money_sum_or_zero(purchase_amount()).alias("spent"),
        )
    )
    return by_user.groupBy("product_id", F.col("event_date").alias("metric_date")).agg(
        F.sum("views").alias("num_views"),
        F.sum("clicks").alias("num_clicks"),
        F.sum("adds").alias("num_add_to_cart"),
        F.sum("purchases").alias("num_purchases"),
        money_sum_or_zero("spent").alias("revenue"),
        F.count("user_id").alias("unique_users"),
    )


def agg_user_weekly(ev: DataFrame) -> DataFrame:
    """Per user and week (starting Monday): sessions, events, purchases, amount spent."""
    by_session = ev.groupBy("user_id", week_start("event_date").alias("week_start_date"), "session_id").agg(
        F.count("*").alias("events"),
        count_type("purchase").alias("purchases"),
        money_sum_or_zero(purchase_amount()).alias("spent"),
    )
    return by_session.groupBy("user_id", "week_start_date").agg(
        F.count("session_id").alias("num_sessions"),
        F.sum("events").alias("num_events"),
        F.sum("purchases").alias("num_purchases"),
        money_sum_or_zero("spent").alias("total_spent"),
    )


def agg_category_metrics(ev: DataFrame, products: DataFrame) -> DataFrame:
    """Per catalog category: interactions of its products and purchases per click.

    Events are counted per product before the catalog join, so the join sees one
    row per product.
    """
    per_product = (
        ev.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            count_type("page_view").alias("views"),
            count_type("product_click").alias("clicks"),
            count_type("add_to_cart").alias("adds"),
            count_type("purchase").alias("purchases"),
            money_sum_or_zero(purchase_amount()).alias("revenue"),
        )
    )
    zero = F.lit(0).cast("long")
    totals = products.join(per_product, "product_id", "left").groupBy("category").agg(
        F.count("product_id").alias("total_products"),
        F.coalesce(F.sum("views"), zero).alias("total_views"),
        F.coalesce(F.sum("clicks"), zero).alias("total_clicks"),
        F.coalesce(F.sum("adds"), zero).alias("total_add_to_cart"),
        F.coalesce(F.sum("purchases"), zero).alias("total_purchases"),
        money_sum_or_zero("revenue").alias("total_revenue"),
        rounded_ratio(money_sum_or_zero("price"), F.count("price"), 2).alias("avg_price"),
    )
    return totals.withColumn("conversion_rate", percent("total_purchases", "total_clicks"))


def ml_conversion_table(predictions: DataFrame) -> DataFrame:
    return load_warehouse_table(
        predictions.withColumn("prediction_timestamp", F.current_timestamp()),
        WAREHOUSE["ml_conversion_predictions"],
    )


def ml_churn_table(predictions: DataFrame) -> DataFrame:
    return load_warehouse_table(
        predictions.withColumnRenamed("retention_priority", "retention_priority_score").withColumn(
            "prediction_timestamp", F.current_timestamp()
        ),
        WAREHOUSE["ml_churn_predictions"],
    )


def ml_ltv_table(predictions: DataFrame) -> DataFrame:
    return load_warehouse_table(
        predictions.withColumn("prediction_timestamp", F.current_timestamp()),
        WAREHOUSE["ml_ltv_predictions"],
    )


def check_primary_key(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """One row: how many key values occur more than once."""
    return repeated_keys({table: (df, keys)})


def repeated_keys(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per table (rows, key columns), how many key values occur more than once.

    The keys of all tables are counted together by a hash of 64 bits, which is all that
    is shuffled. Only keys whose hash repeats are then counted themselves, table by table,
    and only of tables that have such.
    """
    names = list(tables)
    spark = tables[names[0]][0].sparkSession
    hashes = [df.select(F.lit(i).alias("table"), F.xxhash64(*keys).alias("hash")) for i, (df, keys) in enumerate(tables.values())]
    counts = reduce(DataFrame.unionByName, hashes).groupBy("table", "hash").agg(F.count("*").alias("rows"))
    suspects = counts.filter("rows > 1").select("table", "hash")
    suspected = {row["table"] for row in suspects.groupBy("table").count().collect()}  # one row per table at most
    if suspected:
        suspects = stage(suspects, "suspect_keys")

    def named(i: int, repeated: Column) -> list[Column]:
        key_columns = F.lit(",".join(tables[names[i]][1])).alias("key_columns")
        return [F.lit(names[i]).alias("table_name"), key_columns, repeated.cast("long").alias("duplicate_keys")]

    def counted(i: int) -> DataFrame:
        df, keys = tables[names[i]]
        held = df.select(*keys, F.xxhash64(*keys).alias("hash")).join(suspects.filter(F.col("table") == i), "hash", "left_semi")
        return held.groupBy(*keys).count().filter("count > 1").agg(F.count("*").alias("n")).select(*named(i, F.col("n")))

    none = [F.struct(*named(i, F.lit(0))) for i in range(len(names)) if i not in suspected]
    lines = [spark.range(1).select(F.inline(F.array(*none)))] if none else []
    return reduce(DataFrame.unionByName, [*lines, *map(counted, sorted(suspected))])


def check_foreign_key(child: DataFrame, parent: DataFrame, name: str, column: str, parent_key: str) -> DataFrame:
    """One row: how many child rows refer to a missing parent."""
    return orphan_rows({name: (child, column, parent, parent_key)})


def orphan_rows(relations: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Per relation (child, its column, parent, its key), how many child rows refer to a missing parent.

    The keys of all relations meet in one aggregation. Child rows are counted before it,
    so a frequent key is shuffled once per task.
    """
    names = list(relations)
    # every table is read once, for all relations it is part of
    roles: dict[int, tuple[DataFrame, list[Column]]] = {}
    for i, (child, column, parent, key) in enumerate(relations.values()):
        for df, c, is_child in ((child, column, 1), (parent, key, 0)):
            role = F.struct(F.lit(i).alias("relation"), F.col(c).cast("string").alias("key"), F.lit(is_child).alias("child"))
            roles.setdefault(id(df), (df, []))[1].append(role)
    sides = [df.select(F.inline(F.array(*held))).filter("key IS NOT NULL") for df, held in roles.values()]
    per_key = reduce(DataFrame.unionByName, sides).groupBy("relation", "key").agg(
        F.sum("child").alias("rows"), F.min("child").alias("without_parent")
    )
    found = per_key.groupBy("relation").agg(F.sum(F.when(F.col("without_parent") == 1, F.col("rows")).otherwise(0)).alias("rows"))
    every = F.array(*[F.struct(F.lit(i).alias("relation"), F.lit(name).alias("name")) for i, name in enumerate(names)])
    listed = found.sparkSession.range(1).select(F.inline(every))
    return listed.join(found, "relation", "left").select(
        F.col("name").alias("relation"), F.coalesce("rows", F.lit(0).cast("long")).alias("orphan_rows")
    )


def check_not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One row per column: number of NULLs, all counted in a single pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "null_rows").select(
        F.lit(table).alias("table_name"), "column_name", "null_rows"
    )


def check_primary_keys(tables: dict[str, DataFrame]) -> DataFrame:
    return repeated_keys({name: (df, list(WAREHOUSE[name].key)) for name, df in tables.items()})


def check_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    return orphan_rows(
        {
            f"{n}.{column}": (df, column, tables[parent], parent_key)
            for n, df in tables.items()
            for column, (parent, parent_key) in WAREHOUSE[n].foreign_keys.items()
            if parent in tables
        }
    )


def check_not_nulls(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            check_not_null(df, n, list(WAREHOUSE[n].not_null))
            for n, df in tables.items()
            if WAREHOUSE[n].not_null
        ],
    )
