"""Version history, current lists and recent changes of the dimensions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def customer_history(customers: DataFrame, customer_id: int | None = None) -> DataFrame:
    """All versions of one customer, or of all, oldest first."""
    return _history(
        customers,
        "customer_id",
        customer_id,
        ["first_name", "last_name", "email", "phone", "address", "city", "country"],
    )


def product_history(products: DataFrame, product_id: int | None = None) -> DataFrame:
    return _history(
        products,
        "product_id",
        product_id,
        ["product_name", "category", "brand", "price", "cost", "margin_percentage"],
    )


def _history(versions: DataFrame, key: str, only: int | None, columns: list[str]) -> DataFrame:
    """Versions start again at 1 after a delete, so the time of opening sorts first.

    Versions per key are pre-aggregated; a window would hold a whole key in one task.
    """
    chosen = versions if only is None else versions.filter(F.col(key) == only)
    counts = chosen.groupBy(key).agg(F.count("*").alias("n_versions"))
    surrogate = key.replace("_id", "_key")
    rows = chosen.select(
        surrogate,
        key,
        *columns,
        "valid_from",
        "valid_to",
        "is_current",
        "version",
        _opened(versions),
    )
    return (
        rows.join(F.broadcast(counts) if only is not None else counts, key, "left")
        .withColumn("is_open", F.col("is_current"))
        .orderBy(key, "valid_from", "opened")
    )


def _opened(versions: DataFrame) -> Column:
    if "open_seq" in versions.columns:
        return F.col("open_seq").alias("opened")
    return F.struct("open_partition", "open_offset").alias("opened")


def current_customers(customers: DataFrame) -> DataFrame:
    return (
        customers.filter("is_current")
        .select("customer_id", "first_name", "last_name", "email", "phone", "city", "country")
        .orderBy("customer_id")
    )


def current_products(products: DataFrame) -> DataFrame:
    return (
        products.filter("is_current")
        .select("product_id", "product_name", "category", "brand", F.col("price").cast("double").alias("price"))
        .orderBy("product_id")
    )


def recent_changes(customers: DataFrame, products: DataFrame, limit: int = 20) -> DataFrame:
    """The newest versions of either dimension: a top-k of each, then of both."""
    newest = [F.desc("change_time"), "entity_type", "entity_id", F.desc("version"), F.desc("opened")]
    change_type = (
        F.when(F.col("version") == 1, "create")
        .when(~F.col("is_current"), "update")
        .otherwise("current")
    )
    name = F.concat("first_name", F.lit(" "), "last_name")

    def top(versions, entity, key, entity_name, extra):
        return (
            versions.select(
                F.lit(entity).alias("entity_type"),
                F.col(key).alias("entity_id"),
                entity_name.alias("entity_name"),
                extra,
                F.col("valid_from").alias("change_time"),
                "version",
                "is_current",
                change_type.alias("change_type"),
                F.to_json(_opened(versions)).alias("opened"),
            )
            .orderBy(*newest)
            .limit(limit)
        )

    both = top(customers, "customer", "customer_id", name, F.col("email")).unionByName(
        top(products, "product", "product_id", F.col("product_name"), F.col("price").cast("double").alias("price")),
        allowMissingColumns=True,
    )
    return both.orderBy(*newest).limit(limit).drop("opened")
