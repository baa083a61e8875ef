"""Loading of the order fact table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdflow.functions import date_key, money, surrogate_key
from scdflow.operators.scd import as_of
from scdflow.schemas import ADDRESS, MONEY

LOOKUP_REASONS = ["order_not_found", "customer_not_found", "product_not_found"]


def latest_orders(changes: DataFrame) -> DataFrame:
    """Orders as they stand after the last change of each; deleted orders are gone."""
    columns = [
        c
        for c in changes.columns
        if c not in ("topic", "partition", "offset", "op", "ts", "value", "given", "seq")
    ]
    order = F.col("seq") if "seq" in changes.columns else F.struct("partition", "offset")
    last = changes.groupBy("order_id").agg(
        F.max_by(F.struct("op", *[c for c in columns if c != "order_id"]), order).alias("last")
    )
    return (
        last.filter(~F.col("last.op").eqNullSafe("d")).select("order_id", "last.*").drop("op")
    )


def one_per_address(records: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """A record delivered again is the same record: keep one per address, and none of the `known`.

    Records are shuffled once, by their address: what is known is taken out there, and of those
    that came twice the smallest one stays. Records without a full address are kept as they are.
    """
    rest = [c for c in records.columns if c not in ADDRESS]
    addressed = F.lit(True)
    for column in ADDRESS:
        addressed &= F.col(column).isNotNull()
    placed = records.filter(addressed).repartition(*ADDRESS)
    # Sorted by the offset first: it tells records apart, and most topics and partitions are equal.
    by = ADDRESS[::-1]
    if known is not None:
        placed = placed.join(known, by, "left_anti")
    chosen = placed.groupBy(*by).agg(F.min(F.struct(*rest)).alias("r")).select(*ADDRESS, "r.*")
    return chosen.unionByName(records.filter(~addressed).select(*chosen.columns))


def resolve(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    dates: DataFrame,
    lookup: str = "current",
    customer_columns: Sequence[str] = (),
    product_columns: Sequence[str] = (),
    found_only: bool = False,
    **sizes,
) -> DataFrame:
    """Inserted items with their dimension keys, and `reason` where one is missing.

    `lookup` is "current" for the versions current now, or "asof" for the versions
    valid at the order date.

    Customers and dates are found per order, so each is looked up once however many
    items the order has. More columns of the versions found can be asked for. With `found_only`,
    for callers that want no rejects, items are left out early that lack an order, its customer or
    its date; those that lack a product stay.
    """
    customer_found = ["customer_key", *customer_columns]
    product_found = ["product_key", *product_columns]
    dated = (
        _with_version(orders, customers, "customer_id", customer_found, lookup, sizes)
        .withColumn("date_key", date_key("order_date"))
        # One row per calendar day, so its size is fixed by the range of dates.
        .join(
            F.broadcast(dates.select("date_key", F.lit(True).alias("known_date"))),
            "date_key",
            "left",
        )
        .withColumn("order_found", F.lit(True))
    )
    if found_only:
        dated = dated.filter("customer_key IS NOT NULL AND known_date IS NOT NULL")
    how = "inner" if found_only else "left"
    inserts = items.filter(F.col("op") == "c").drop("op")
    if lookup == "current":
        keyed = _with_version(inserts, products, "product_id", product_found, lookup, sizes)
        found = keyed.join(dated, "order_id", how)
    else:
        found = _with_version(
            inserts.join(dated, "order_id", how),
            products,
            "product_id",
            product_found,
            lookup,
            # The join adds no rows, so the items alone tell which products are hot.
            sizes | {"counted": inserts},
        )
    return found.withColumn("reason", _reason())


def _with_version(rows, dimension, key, columns, lookup, sizes) -> DataFrame:
    if lookup == "asof":
        return as_of(rows, dimension, key, "order_date", columns, **sizes)
    current = dimension.filter("is_current").select(key, *columns)
    return rows.join(current, key, "left")


def _reason() -> Column:
    return (
        F.when(F.col("order_found").isNull(), "order_not_found")
        .when(F.col("customer_key").isNull(), "customer_not_found")
        .when(F.col("product_key").isNull(), "product_not_found")
        .when(F.col("known_date").isNull(), "date_out_of_range")
    )


def facts(resolved: DataFrame, *more: str) -> DataFrame:
    """Rows of the fact table. The business ids stay as plain columns.

    The conditions are those of `reason`, one column each: so the optimizer sees that
    no outer row is wanted and makes the lookups inner joins.
    """
    loaded = resolved
    for found in ("order_found", "customer_key", "product_key", "known_date"):
        loaded = loaded.filter(F.col(found).isNotNull())
    return loaded.select(
        surrogate_key("order_fact", "order_item_id", "order_id").alias("order_fact_key"),
        "order_id",
        "order_item_id",
        "customer_id",
        "product_id",
        "customer_key",
        "product_key",
        "date_key",
        F.col("quantity").cast("int").alias("quantity"),
        F.coalesce(money("unit_price"), F.lit(0).cast(MONEY)).alias("unit_price"),
        F.coalesce(money("line_total"), F.lit(0).cast(MONEY)).alias("line_total"),
        F.col("status").alias("order_status"),
        *more,
    )


def unresolved(resolved: DataFrame) -> DataFrame:
    """Items to be tried again with the next batch: a row they refer to is missing."""
    return resolved.filter(F.col("reason").isin(*LOOKUP_REASONS))


def out_of_range(resolved: DataFrame) -> DataFrame:
    """Items that can never load with this date dimension; they become failed messages."""
    return resolved.filter(F.col("reason") == "date_out_of_range")
