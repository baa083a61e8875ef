"""How far the warehouse is behind its source, and checks on source totals."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdflow.sources.shared import staged

#: Leaves of a hash tree, and children of a node.
LEAVES, FAN = 4096, 16


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one row each."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
            for name, df in tables.items()
        ],
    )


def _distinct(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.agg(F.count_distinct(key).alias("n")).select(F.lit(name).alias("table_name"), "n")


def cdc_stats(source: dict[str, DataFrame], customers: DataFrame, products: DataFrame, facts: DataFrame) -> DataFrame:
    """Source rows against distinct keys in the warehouse, with levels.

    Six one-row counts are stacked and turned into one row.
    """
    stacked = (
        counts({f"source_{name}": source[name] for name in ("customers", "products", "orders")})
        .unionByName(_distinct(customers.filter("is_current"), "customer_id", "warehouse_customers"))
        .unionByName(_distinct(products.filter("is_current"), "product_id", "warehouse_products"))
        .unionByName(_distinct(facts, "order_id", "warehouse_orders"))
    )
    names = [f"{side}_{t}" for side in ("source", "warehouse") for t in ("customers", "products", "orders")]
    row = stacked.agg(*[F.max(F.when(F.col("table_name") == n, F.col("n"))).alias(n) for n in names])

    def percent(table: str, empty: float) -> Column:
        have, want = F.col(f"warehouse_{table}"), F.col(f"source_{table}")
        return F.when(want > 0, have / want * 100).otherwise(F.lit(empty))

    def entity_percent(table: str) -> Column:
        same = F.col(f"warehouse_{table}") == F.col(f"source_{table}")
        return F.when(same, 100.0).otherwise(percent(table, 0.0))

    orders = percent("orders", 100.0)
    in_sync = (
        (F.col("source_customers") == F.col("warehouse_customers"))
        & (F.col("source_products") == F.col("warehouse_products"))
        & (orders >= 75)
    )
    return (
        row.withColumns(
            {
                "in_sync": in_sync,
                "customers_percent": F.round(entity_percent("customers"), 6),
                "products_percent": F.round(entity_percent("products"), 6),
                "orders_percent": F.round(orders, 2),
            }
        )
        .withColumns(
            {
                "customers_level": _entity_level("customers_percent"),
                "products_level": _entity_level("products_percent"),
                "orders_level": F.when(F.col("orders_percent") >= 95, "ok")
                .when(F.col("orders_percent") >= 80, "warn")
                .otherwise("bad"),
            }
        )
    )


def _entity_level(column: str) -> Column:
    return F.when(F.col(column) == 100, "ok").otherwise("warn")


def order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Order totals beside the sum of their lines, and lines that do not multiply out."""
    off = F.round(F.col("quantity") * F.col("unit_price"), 2) != F.col("line_total")
    lines = items.groupBy("order_id").agg(
        F.sum(F.col("line_total").cast("decimal(18,2)")).alias("lines_total"),
        F.count_if(off).alias("wrong_lines"),
    )
    total = F.col("total_amount").cast("decimal(18,2)")
    lines_total = F.coalesce(F.col("lines_total"), F.lit(0).cast("decimal(18,2)"))
    return orders.join(lines, "order_id", "left").select(
        "order_id",
        total.cast("double").alias("total_amount"),
        lines_total.cast("double").alias("lines_total"),
        (total - lines_total).cast("double").alias("difference"),
        F.coalesce("wrong_lines", F.lit(0)).alias("wrong_lines"),
    )


def _leaf(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(LEAVES)).cast("int")


def digests(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The leaves of a table's hash tree: checksums of their rows, whatever their order.

    A row a leaf, however large the table; one scan with a pre-aggregated grouping.
    """
    row = F.xxhash64(key, *columns)
    return rows.groupBy(_leaf(key).alias("node")).agg(
        F.count("*").alias("n"),
        F.bit_xor(row).alias("crossed"),
        F.sum(F.pmod(row, F.lit(1 << 32))).alias("added"),
    )


def _above(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy(F.floor(F.col("node") / FAN).cast("int").alias("node")).agg(
        F.sum("n").alias("n"), F.bit_xor("crossed").alias("crossed"), F.sum("added").alias("added")
    )


def differing_leaves(left: DataFrame, right: DataFrame) -> list[int]:
    """Leaves whose digests differ, found from the root down: below a node that agrees, none is
    looked at."""
    trees, width = [(left, right)], LEAVES
    while width > 1:
        trees.append(tuple(_above(x) for x in trees[-1]))
        width = -(-width // FAN)
    found: list[int] | None = None
    for a, b in reversed(trees):
        if found is not None:
            inside = F.floor(F.col("node") / FAN).cast("int").isin(found)
            a, b = a.filter(inside), b.filter(inside)
        sums = ["n", "crossed", "added"]
        both = a.select("node", F.struct(*sums).alias("of_a")).join(
            b.select("node", F.struct(*sums).alias("of_b")), "node", "full"
        )
        # At most as many numbers as there are leaves.
        rows = both.filter(~F.col("of_a").eqNullSafe(F.col("of_b"))).select("node").collect()
        found = [r["node"] for r in rows]
        if not found:
            break
    return found or []


def differences(source: DataFrame, copy: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys whose rows are `missing` in the copy, `extra` there, or `changed`.

    Only rows of leaves that differ are joined. A key that comes several times on a side is
    compared by the checksum of its rows.
    """
    left, right = (staged(digests(x, key, columns), "digests") for x in (source, copy))
    leaves = differing_leaves(left, right)

    def rows(side: DataFrame, name: str) -> DataFrame:
        chosen = side.filter(_leaf(key).isin(leaves)) if leaves else side.limit(0)
        return chosen.groupBy(key).agg(
            F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64(key, *columns)).alias("x")).alias(name)
        )

    both = rows(source, "have").join(rows(copy, "got"), key, "full")
    kind = (
        F.when(F.col("got").isNull(), "missing")
        .when(F.col("have").isNull(), "extra")
        .when(F.col("have") != F.col("got"), "changed")
    )
    return both.select(key, kind.alias("difference")).filter(F.col("difference").isNotNull())
