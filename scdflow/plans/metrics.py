"""Revenue, ranking and category queries over the star schema, and the date dimension."""

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scdflow.functions import date_key

FIRST_DATE = datetime.date(2020, 1, 1)
LAST_DATE = datetime.date(2030, 12, 31)


def dim_date(
    spark: SparkSession, first: datetime.date = FIRST_DATE, last: datetime.date = LAST_DATE
) -> DataFrame:
    """One row per day of a range, both ends included."""
    return calendar(spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last")))


def calendar_of(rows: DataFrame, column: str) -> DataFrame:
    """A date dimension that covers every date in a column."""
    day = F.col(column).cast("date")
    return calendar(rows.agg(F.min(day).alias("first"), F.max(day).alias("last")))


def calendar(bounds: DataFrame) -> DataFrame:
    """The days from `first` to `last` of a one-row frame."""
    d = F.col("date")
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date")).select(
        date_key("date").alias("date_key"),
        "date",
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def extend_dates(existing: DataFrame, more: DataFrame) -> DataFrame:
    """Add days; those that exist already stay as they are."""
    return existing.unionByName(more.join(existing.select("date_key"), "date_key", "left_anti"))


def _total(column: str) -> Column:
    """Sum of money, exact while adding."""
    return F.coalesce(F.sum(F.col(column).cast("decimal(18,2)")), F.lit(0)).cast("double")


def _units() -> Column:
    return F.sum(F.col("quantity").cast("bigint"))


def daily_revenue(
    facts: DataFrame, dates: DataFrame, as_of: datetime.date, days: int = 30
) -> DataFrame:
    """Orders, items and revenue of each of the last `days` days, newest first.

    Facts are added up per day before they meet the dates, and the bound on the date
    is put on the key as well, so that it reaches the scan.
    """
    since = as_of - datetime.timedelta(days=days)
    recent = facts.filter(F.col("date_key") >= int(since.strftime("%Y%m%d")))
    return (
        _sales(recent, ["date_key"])
        .join(
            F.broadcast(dates.filter(F.col("date") >= since).select("date_key", "date", "day_of_week")),
            "date_key",
        )
        .select(
            "date",
            F.trim("day_of_week").alias("day_of_week"),
            "num_orders",
            "total_items",
            "revenue",
        )
        .orderBy(F.desc("date"))
    )


_DAY = ["date_key", "bucket"]


def day_partials(facts: DataFrame) -> DataFrame:
    """Facts as mergeable parts of days: sums, and the distinct orders as bit maps by bucket."""
    return facts.groupBy(
        "date_key", F.bitmap_bucket_number("order_id").alias("bucket")
    ).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("order_id")).alias("orders"),
        _units().alias("units"),
        F.sum(F.col("line_total").cast("decimal(18,2)")).alias("amount"),
    )


def merged_partials(partials: DataFrame) -> DataFrame:
    """Parts of the same days added up: what one batch and another make together."""
    return partials.groupBy(*_DAY).agg(
        F.bitmap_or_agg("orders").alias("orders"),
        F.sum("units").alias("units"),
        F.sum("amount").cast("decimal(18,2)").alias("amount"),
    )


def daily_revenue_of(
    partials: DataFrame, dates: DataFrame, as_of: datetime.date, days: int = 30
) -> DataFrame:
    """As `daily_revenue`, from merged parts; no fact is read."""
    since = as_of - datetime.timedelta(days=days)
    per_day = (
        partials.filter(F.col("date_key") >= int(since.strftime("%Y%m%d")))
        .groupBy("date_key")
        .agg(
            F.sum(F.bitmap_count("orders")).alias("num_orders"),
            F.sum("units").alias("total_items"),
            F.coalesce(F.sum("amount"), F.lit(0)).cast("double").alias("revenue"),
        )
    )
    known = dates.filter(F.col("date") >= since).select("date_key", "date", "day_of_week")
    return (
        per_day.join(F.broadcast(known), "date_key")
        .select("date", F.trim("day_of_week").alias("day_of_week"), "num_orders", "total_items", "revenue")
        .orderBy(F.desc("date"))
    )


def revenue_by_grain(facts: DataFrame, dates: DataFrame, grain: str = "month") -> DataFrame:
    """Revenue by day, week (from Monday) or month."""
    days = dates.select(
        "date_key", F.to_date(F.date_trunc(grain, F.col("date").cast("timestamp"))).alias("period")
    )
    return _sales(facts.join(F.broadcast(days), "date_key"), ["period"]).orderBy(F.desc("period"))


def _sales(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct orders and sums per group.

    Grouping by order first lets the count of orders be a plain count: both steps are
    pre-aggregated and a large group is spread over its orders.
    """
    per_order = facts.groupBy(*keys, "order_id").agg(
        _units().alias("items"), F.sum(F.col("line_total").cast("decimal(18,2)")).alias("amount")
    )
    return per_order.groupBy(*keys).agg(
        F.count("order_id").alias("num_orders"),
        F.sum("items").alias("total_items"),
        F.coalesce(F.sum("amount").cast("double"), F.lit(0.0)).alias("revenue"),
    )


def _per_version(facts: DataFrame, dimension: DataFrame, key: str, business_id: str, columns, current_only):
    """Facts with attributes of their dimension row.

    By default facts on superseded versions drop out. With `current_only=False` they
    count too, under the attributes of the current version of the same business id.
    """
    current = dimension.filter("is_current")
    if current_only:
        # The surrogate key is a hash; with the business id no two versions can be taken for one.
        return facts.join(current.select(key, business_id, *columns), [key, business_id])
    return facts.join(current.select(business_id, *columns), business_id)


def product_sales(facts: DataFrame, products: DataFrame, current_only: bool = True) -> DataFrame:
    """Units and revenue per product."""
    names = ["product_name", "category", "brand", "price"]
    keys = ["product_key", "product_id"] if current_only else ["product_id"]
    sold = facts.groupBy(*keys).agg(
        _units().alias("units_sold"), _total("line_total").alias("total_revenue")
    )
    return _per_version(sold, products, "product_key", "product_id", names, current_only).select(
        "product_id",
        *names[:3],
        F.coalesce(F.col("price").cast("double"), F.lit(0.0)).alias("current_price"),
        "units_sold",
        "total_revenue",
    )


def top_products(
    facts: DataFrame, products: DataFrame, limit: int = 10, current_only: bool = True
) -> DataFrame:
    return (
        product_sales(facts, products, current_only)
        .orderBy(F.desc("total_revenue"), "product_id")
        .limit(limit)
    )


def ranked(top: DataFrame, by: str, then: str) -> DataFrame:
    """Number the rows of a top-k result; its few rows fit one task."""
    return top.withColumn("position", F.row_number().over(Window.orderBy(F.desc(by), then)))


def customer_sales(facts: DataFrame, customers: DataFrame, current_only: bool = True) -> DataFrame:
    """Orders and revenue per customer."""
    names = ["first_name", "last_name", "email", "city", "country"]
    keys = ["customer_key", "customer_id"] if current_only else ["customer_id"]
    per_order = facts.groupBy(*keys, "order_id").agg(
        F.sum(F.col("line_total").cast("decimal(18,2)")).alias("amount")
    )
    bought = per_order.groupBy(*keys).agg(
        F.count("order_id").alias("total_orders"),
        F.coalesce(F.sum("amount").cast("double"), F.lit(0.0)).alias("lifetime_value"),
    )
    return _per_version(
        bought, customers, "customer_key", "customer_id", names, current_only
    ).select(
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        *names[2:],
        "total_orders",
        "lifetime_value",
    )


def top_customers(
    facts: DataFrame, customers: DataFrame, limit: int = 10, current_only: bool = True
) -> DataFrame:
    return (
        customer_sales(facts, customers, current_only)
        .orderBy(F.desc("lifetime_value"), "customer_id")
        .limit(limit)
    )


def sales_by_category(
    facts: DataFrame, products: DataFrame, current_only: bool = True
) -> DataFrame:
    """Orders, units, revenue and average unit price per category.

    Facts are added up once, per category and order: an order has a product once as a rule, so
    sums per product and order would only take a task's memory.
    """
    per_order = (
        _per_version(facts, products, "product_key", "product_id", ["category"], current_only)
        .groupBy("category", "order_id")
        .agg(
            _units().alias("units"),
            F.sum(F.col("line_total").cast("decimal(18,2)")).alias("amount"),
            F.sum(F.col("unit_price").cast("decimal(18,2)")).alias("prices"),
            F.count("unit_price").alias("lines"),
        )
    )
    return (
        per_order.groupBy("category")
        .agg(
            F.count("order_id").alias("num_orders"),
            F.sum("units").alias("units_sold"),
            F.coalesce(F.sum("amount").cast("double"), F.lit(0.0)).alias("revenue"),
            F.round(F.sum("prices").cast("double") / F.sum("lines"), 6).alias("avg_price"),
        )
        .orderBy(F.desc("revenue"), "category")
    )


def sales_kpis(by_category: DataFrame) -> DataFrame:
    """Totals over the categories. An order counts once in each category it touches."""
    orders = F.coalesce(F.sum("num_orders"), F.lit(0))
    revenue = F.coalesce(F.sum(F.col("revenue").cast("decimal(18,2)")).cast("double"), F.lit(0.0))
    return by_category.agg(
        revenue.alias("total_revenue"),
        orders.alias("total_orders"),
        F.coalesce(F.sum("units_sold"), F.lit(0)).alias("total_units"),
        F.when(orders > 0, F.round(revenue / orders, 6)).otherwise(0.0).alias("avg_order_value"),
    )
