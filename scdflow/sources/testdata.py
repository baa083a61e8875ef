"""Change feeds derived from the TPC-H-like tables.

Each feed is a plan over whole tables. Its columns are given as SQL expressions that
mean the same in Spark and DuckDB, so a check can derive the same input independently
of the operators under test.
"""

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scdflow.functions import open_end, surrogate_key
from scdflow.plans.metrics import dim_date

FIRST_DATE = datetime.date(1995, 1, 1)
LAST_DATE = datetime.date(2001, 12, 31)


def position(day: str, number: str) -> str:
    """An offset that grows with the day and then with a number below 2^44."""
    days = f"((year({day}) - 1990) * 372 + month({day}) * 31 + day({day}))"
    return f"({days} * 17592186044416 + {number})"


# A few customers share the email of the one before.
_EMAIL = (
    "'c' || cast(o_custkey - case when o_custkey % 50 = 0 then 1 else 0 end as string)"
    " || '@example.com'"
)
_ADDRESS = "case when o_orderpriority = '5-LOW' then null else 'Street ' || o_orderpriority end"
_CITY = "'City ' || cast(o_custkey % 100 as string)"
_COUNTRY = "'Country ' || cast(o_custkey % 25 as string)"

# Now and then an event's time lies well before that of the change ahead of it.
_CHANGED_AT = "case when o_orderkey % 29 = 0 then o_orderdate - interval 400 days else o_orderdate end"

# orders -> customer changes
CUSTOMER_CHANGES = {
    "customer_id": "o_custkey",
    "partition": "cast(o_custkey % 4 as int)",
    "offset": position("o_orderdate", "o_orderkey"),
    "ts": _CHANGED_AT,
    "op": "case when o_orderkey % 37 = 0 then 'd' when o_orderkey % 41 = 0 then 'r' else 'u' end",
    "first_name": "'Customer'",
    "last_name": "o_orderstatus",
    "email": _EMAIL,
    "phone": "o_orderpriority",
    "address": _ADDRESS,
    "city": _CITY,
    "country": _COUNTRY,
}

# customer -> rows of an initial snapshot, older than any change
CUSTOMER_SNAPSHOT = {
    "customer_id": "c_custkey",
    "partition": "cast(c_custkey % 4 as int)",
    "offset": "cast(0 as bigint)",
    "ts": "cast('1994-12-31 00:00:00' as timestamp)",
    "op": "'r'",
    "first_name": "'Customer'",
    "last_name": "c_name",
    "email": "'c' || cast(c_custkey as string) || '@example.com'",
    "phone": "cast(null as string)",
    "address": "cast(null as string)",
    "city": "c_mktsegment",
    "country": "cast(c_nationkey as string)",
}

# part -> rows of an initial snapshot
PRODUCT_SNAPSHOT = {
    "product_id": "p_partkey",
    "partition": "cast(p_partkey % 4 as int)",
    "offset": "cast(0 as bigint)",
    "ts": "cast('1994-12-31 00:00:00' as timestamp)",
    "op": "'r'",
    "product_name": "p_name",
    "category": "p_type",
    "brand": "p_brand",
    "description": "cast(null as string)",
    "price": "cast(p_retailprice as decimal(10,2))",
    "cost": "cast(cast(p_retailprice as decimal(10,2)) * 0.6 as decimal(10,2))",
}

_PRICE = (
    "cast(cast(p_retailprice as decimal(10,2))"
    " * cast(10 + l_suppkey % 3 as decimal(3,0)) * 0.1 as decimal(10,2))"
)

PRODUCT_ORDER = [
    "l_shipdate",
    "l_orderkey",
    "l_linenumber",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
]

# lineitem joined to part -> product changes, put in order by PRODUCT_ORDER
PRODUCT_CHANGES = {
    "product_id": "l_partkey",
    "ts": "case when l_orderkey % 31 = 0 then l_shipdate - interval 60 days else l_shipdate end",
    "op": "case when l_returnflag = 'R' and l_linenumber = 7 and l_quantity = 50"
    " then 'd' else 'u' end",
    "product_name": "p_name",
    "category": "p_type",
    "brand": "p_brand",
    "description": "l_linestatus",
    "price": _PRICE,
    "cost": f"cast({_PRICE} * 0.6 as decimal(10,2))",
}

# orders -> order rows
ORDER_ROWS = {
    "order_id": "o_orderkey",
    "customer_id": "o_custkey",
    "order_date": "o_orderdate",
    "status": "o_orderstatus",
    "total_amount": "cast(o_totalprice as decimal(10,2))",
}

# orders -> rows of a copy of them, some of which were changed or have another key
ORDER_COPY = ORDER_ROWS | {
    "order_id": "case when o_orderkey % 1019 = 0 then -o_orderkey else o_orderkey end",
    "status": "case when o_orderkey % 1013 = 0 then o_orderstatus || '!' else o_orderstatus end",
}

_UNIT_CENTS = (
    "floor((2 * round(l_extendedprice * 100) + l_quantity) / (2 * l_quantity))"
)
_UNIT_PRICE = f"cast(cast({_UNIT_CENTS} as decimal(18,0)) * 0.01 as decimal(10,2))"

# lineitem -> order items
ITEM_ROWS = {
    "order_item_id": "l_orderkey * 8 + l_linenumber",
    "order_id": "l_orderkey",
    "product_id": "l_partkey",
    "quantity": "cast(l_quantity as int)",
    "unit_price": _UNIT_PRICE,
    "line_total": "cast(l_extendedprice as decimal(10,2))",
}

#: Days that an item may be younger than its order.
WAIT_DAYS = 200
# orders and their items as two streams by their own times
WAITING_ORDERS = {"order_id": "o_orderkey", "customer_id": "o_custkey", "ordered_at": "o_orderdate"}
WAITING_ITEMS = {
    "order_item_id": "l_orderkey * 8 + l_linenumber",
    "order_id": "l_orderkey",
    "item_at": "l_shipdate",
}

_CUSTOMER_IMAGE = (
    "'{\"customer_id\":' || case when o_orderkey % 127 = 0 then 'null'"
    " else cast(o_custkey as string) end"
    " || ',\"first_name\":\"Customer\",\"last_name\":\"' || o_orderstatus || '\"'"
    " || case when o_orderkey % 53 = 0 then ''"
    " when o_orderkey % 59 = 0 then ',\"email\":null'"
    " when o_orderkey % 107 = 0 then ',\"email\":5' when o_orderkey % 109 = 0 then ',\"email\":{\"error\":1}'"
    " when o_orderkey % 61 = 0 then ',\"email\":\"Error' || cast(o_custkey as string) || '\"'"
    f" else ',\"email\":\"' || {_EMAIL} || '\"' end"
    " || ',\"phone\":\"' || o_orderpriority"
    " || case when o_orderkey % 83 = 0 then ' extension 123456789' else '' end"
    f" || '\",\"address\":' || coalesce('\"' || {_ADDRESS} || '\"', 'null')"
    f" || ',\"city\":\"' || {_CITY} || '\",\"country\":\"' || {_COUNTRY} || '\"}}'"
)
_CUSTOMER_AFTER = (
    "case when o_orderkey % 37 = 0 then 'null' when o_orderkey % 101 = 0 then '{}'"
    f" when o_orderkey % 103 = 0 then '7' else {_CUSTOMER_IMAGE} end"
)

# orders -> customer records, with every kind of envelope
CUSTOMER_RECORDS = {
    "topic": "'ecommerce.public.customers'",
    "partition": "cast(o_custkey % 4 as int)",
    "offset": position("o_orderdate", "o_orderkey"),
    "timestamp": "o_orderdate",
    "key": "cast(o_custkey as string)",
    "value": "case when o_orderkey % 43 = 0 then null"
    " when o_orderkey % 47 = 0 then '{bad'"
    " when o_orderkey % 67 = 0 then '{\"payload\":null}'"
    " when o_orderkey % 71 = 0 then '[1]'"
    " when o_orderkey % 73 = 0 then '5'"
    " when o_orderkey % 79 = 0 then 'null'"
    " when o_orderkey % 3 = 0 then '{\"payload\":{'"
    " || case when o_orderkey % 89 = 0 then '' when o_orderkey % 97 = 0 then '\"op\":null,'"
    " when o_orderkey % 37 = 0 then '\"op\":\"d\",' when o_orderkey % 41 = 0 then '\"op\":\"r\",'"
    " else '\"op\":\"u\",' end"
    f" || '\"before\":' || {_CUSTOMER_IMAGE} || ',\"after\":' || {_CUSTOMER_AFTER} || '}}}}'"
    " else '{\"before\":' || case when o_orderkey % 5 = 0 then 'null'"
    f" else {_CUSTOMER_IMAGE} end || ',\"after\":' || {_CUSTOMER_AFTER} || ',\"op\":\"x\"}}' end",
}

_PRODUCT_IMAGE = (
    "'{\"product_id\":' || cast(l_partkey as string) || ',\"product_name\":\"' || p_name"
    " || '\",\"category\":\"' || p_type || '\",\"brand\":\"' || p_brand || '\",\"price\":'"
    " || case when l_quantity = 50 and l_linenumber = 6 then '\"n/a\"'"
    " when l_quantity = 49 then '1' when l_quantity = 48 then '0'"
    " when l_quantity = 47 and l_linenumber = 2 then '123456789012.5'"
    f" else cast({_PRICE} as string) end"
    " || case when l_linenumber = 7 then '' when l_returnflag = 'R' and l_linenumber = 6"
    " then ',\"cost\":null' when l_quantity = 49 then ',\"cost\":20'"
    f" else ',\"cost\":' || cast(cast({_PRICE} * 0.6 as decimal(10,2)) as string) end || '}}'"
)

# lineitem joined to part -> product records
PRODUCT_RECORDS = {
    "topic": "'ecommerce.public.products'",
    "partition": "cast(l_partkey % 4 as int)",
    "offset": position("l_shipdate", "l_orderkey * 8 + l_linenumber"),
    "timestamp": "l_shipdate",
    "key": "cast(l_partkey as string)",
    "value": "'{\"before\":' || case when l_linenumber = 1 then 'null'"
    f" else {_PRODUCT_IMAGE} end || ',\"after\":'"
    " || case when l_linenumber = 7 and l_quantity = 1 then 'null'"
    f" else {_PRODUCT_IMAGE} end || '}}'",
}

# orders -> order records; small orders are cancelled
ORDER_RECORDS = {
    "topic": "'ecommerce.public.orders'",
    "partition": "cast(o_orderkey % 4 as int)",
    "offset": position("o_orderdate", "o_orderkey"),
    "timestamp": "o_orderdate",
    "key": "cast(o_orderkey as string)",
    "value": "'{\"payload\":{\"op\":\"' || case when o_totalprice < 20000 then 'd' else 'c' end"
    " || '\",\"before\":null,\"after\":{\"order_id\":' || cast(o_orderkey as string)"
    " || ',\"customer_id\":' || cast(o_custkey as string)"
    " || ',\"order_date\":\"' || cast(cast(o_orderdate as date) as string)"
    " || 'T00:00:00Z\",\"status\":\"' || o_orderstatus"
    " || case when o_orderkey % 113 = 0 then repeat('x', 60) else '' end || '\",\"total_amount\":'"
    " || cast(cast(o_totalprice as decimal(10,2)) as string) || '}}}'",
}

# lineitem -> order item records; an address that comes twice is a redelivery
ITEM_RECORDS = {
    "topic": "'ecommerce.public.order_items'",
    "partition": "cast(l_orderkey % 4 as int)",
    "offset": "l_orderkey * 8 + l_linenumber",
    "timestamp": "l_shipdate",
    "key": "cast(l_orderkey as string)",
    "value": "'{\"before\":' || case when l_returnflag = 'R' and l_linenumber = 1"
    " then '{\"quantity\":0}' else 'null' end"
    " || ',\"after\":{\"order_item_id\":' || cast(l_orderkey * 8 + l_linenumber as string)"
    " || ',\"order_id\":' || cast(l_orderkey as string)"
    " || ',\"product_id\":' || cast(l_partkey as string)"
    " || ',\"quantity\":' || cast(cast(l_quantity as int) as string)"
    f" || ',\"unit_price\":' || cast({_UNIT_PRICE} as string)"
    " || case when l_linenumber = 5 then '' else ',\"line_total\":'"
    " || cast(cast(l_extendedprice as decimal(10,2)) as string) end || '}}'",
}

_GROUP = "cast(floor(event_id / 8) as bigint)"

# events of type 'error' -> failed attempts; up to eight events share an address
FAILED_ATTEMPTS = {
    "topic": f"case {_GROUP} % 4 when 0 then 'ecommerce.public.customers'"
    " when 1 then 'ecommerce.public.products' when 2 then 'ecommerce.public.orders'"
    " else 'ecommerce.public.order_items' end",
    "partition": f"cast({_GROUP} % 3 as int)",
    "message_offset": _GROUP,
    "message_timestamp": "ts",
    "message_key": "cast(user_id as string)",
    "message_value": "props",
    "error_type": "case when user_id % 3 = 0 then 'ValueError' else 'DataError' end",
    "error_message": "'bad value ' || cast(cast(value as decimal(18,2)) as string)",
    "error_stacktrace": "cast(null as string)",
    "failed_at": "ts",
}


def columns(feed: dict[str, str]) -> list[str]:
    return [f"{expression} as `{name}`" for name, expression in feed.items()]


class Tables:
    """The tables of one folder and the feeds derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def feed(self, table: DataFrame | str, feed: dict[str, str]) -> DataFrame:
        rows = self.read(table) if isinstance(table, str) else table
        shaped = rows.selectExpr(*columns(feed))
        zoned = [f.name for f in shaped.schema if f.dataType.typeName() == "timestamp"]
        return shaped.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})

    def lines_with_part(self) -> DataFrame:
        part = self.read("part").withColumnRenamed("p_partkey", "l_partkey")
        return self.read("lineitem").join(part, "l_partkey", "left")

    def customer_changes(self) -> DataFrame:
        return self.feed("orders", CUSTOMER_CHANGES)

    def product_changes(self) -> DataFrame:
        lines = self.lines_with_part().withColumn("seq", F.struct(*PRODUCT_ORDER))
        return self.feed(lines, PRODUCT_CHANGES | {"seq": "seq"})

    def customer_records(self) -> DataFrame:
        """The image is worked out once a row; the value mentions it four times."""
        value = CUSTOMER_RECORDS["value"].replace(_CUSTOMER_IMAGE, "image")
        orders = self.read("orders").withColumn("image", F.expr(_CUSTOMER_IMAGE))
        return self.feed(orders, CUSTOMER_RECORDS | {"value": value})

    def product_records(self) -> DataFrame:
        """The image is worked out once a row, and its price once; the value mentions it twice."""
        value = PRODUCT_RECORDS["value"].replace(_PRODUCT_IMAGE, "image")
        lines = self.lines_with_part().withColumn("price", F.expr(_PRICE))
        lines = lines.withColumn("image", F.expr(_PRODUCT_IMAGE.replace(_PRICE, "price")))
        return self.feed(lines, PRODUCT_RECORDS | {"value": value})

    def order_records(self) -> DataFrame:
        return self.feed("orders", ORDER_RECORDS)

    def item_records(self) -> DataFrame:
        return self.feed("lineitem", ITEM_RECORDS)

    def records(self) -> DataFrame:
        return (
            self.customer_records()
            .unionByName(self.product_records())
            .unionByName(self.order_records())
            .unionByName(self.item_records())
        )

    def orders(self) -> DataFrame:
        return self.feed("orders", ORDER_ROWS)

    def items(self) -> DataFrame:
        return self.feed("lineitem", ITEM_ROWS).withColumn("op", F.lit("c"))

    def failed_attempts(self) -> DataFrame:
        return self.feed(self.read("events").filter("event_type = 'error'"), FAILED_ATTEMPTS)

    def dates(self) -> DataFrame:
        return dim_date(self.spark, FIRST_DATE, LAST_DATE)

    def chunk_reads(self) -> DataFrame:
        """Customers as eight chunks of a first copy read them, each key at a moment of its own
        between the chunk's marks: the image of its last change by then."""
        changes = self.customer_changes().filter("op <> 'r'")
        chunk = (F.col("customer_id") % 8).cast("long")
        first = ((1996 - 1990) * 372 + 31 + 1) + chunk * 40
        low, high = first * (1 << 44), (first + 60) * (1 << 44)
        read_at = low + ((F.col("customer_id") * 7919) % 60 + 1) * (1 << 44) - 1
        row = [c for c in changes.columns if c not in ("customer_id", "partition", "offset", "op")]
        seen = changes.filter(F.col("offset") <= read_at).groupBy("customer_id")
        last = seen.agg(F.max_by(F.struct("op", *row), "offset").alias("last"))
        alive = last.select("customer_id", "last.*").filter("op <> 'd'").drop("op")
        return alive.withColumns({"low": low, "high": high})

    def snapshot_customers(self) -> DataFrame:
        return _first_versions(self.feed("customer", CUSTOMER_SNAPSHOT), "customer")

    def snapshot_products(self) -> DataFrame:
        return _first_versions(self.feed("part", PRODUCT_SNAPSHOT), "product")


def _first_versions(snapshot: DataFrame, entity: str) -> DataFrame:
    """A snapshot has each key once, so its rows are the first versions as they are."""
    return snapshot.select(
        surrogate_key(entity, f"{entity}_id", "partition", "offset").alias(f"{entity}_key"),
        *[c for c in snapshot.columns if c not in ("partition", "offset", "ts", "op")],
        F.col("ts").alias("valid_from"),
        open_end().alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version"),
        F.col("partition").alias("open_partition"),
        F.col("offset").alias("open_offset"),
    )
