"""Change records into the warehouse, one batch at a time.

A batch goes through envelope, checks, dimensions, orders, facts and failed messages,
and is committed once at the end. The same function serves a stream and a batch.
"""

import datetime
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdflow.functions import event_time, naive
from scdflow.operators import dlq, envelope, facts, ranges, scd, validate
from scdflow.plans import metrics
from scdflow.schemas import (
    ADDRESS,
    CUSTOMERS,
    ORDER_ITEMS,
    ORDERS,
    PRODUCTS,
    RECORD,
    TOPIC_PREFIX,
)
from scdflow.sources.warehouse import Batch, Warehouse

DIMENSIONS = {
    "dim_customer": ("customer_id", scd.customer_dimension),
    "dim_product": ("product_id", scd.product_dimension),
}
_ITEM = ["order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total"]


def start(
    records: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    dates: DataFrame | None = None,
    available_now: bool = True,
):
    """Run a stream of records into the warehouse.

    The checkpoint tracks offsets; its id and the batch's make a batch that is run again harmless.
    """

    def apply(rows: DataFrame, batch_id: int) -> None:
        # The stream's id lies in its checkpoint: batch numbers of another one start anew.
        source = rows.sparkSession.read.text(f"{checkpoint}/metadata").first()[0]
        ingest(warehouse, rows, json.loads(source)["id"], batch_id, dates=dates)

    writer = (
        records.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .queryName("scdflow")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ingest(
    warehouse: Warehouse,
    records: DataFrame,
    source: str,
    source_batch: int,
    now: datetime.datetime | None = None,
    dates: DataFrame | None = None,
) -> None:
    """Apply one batch of records, unless this batch of this source was committed before.

    Numbers of a source may come in any order; each is applied once. Each record is applied, or
    filed as a failed message, or was applied already; the commit has how many came (`received`)
    and how many were new (`applied`), by topic.
    """
    batch = warehouse.begin()
    if warehouse.has_applied(source, source_batch):
        return
    now = now or datetime.datetime.now()
    received = batch.keep("records", records.select(*_names(RECORD)), "topic")
    known = warehouse.appended("applied")
    new = _unseen(batch, received, known)
    normalized = batch.keep("normalized", envelope.normalize(new), "topic")
    batch.overwrite("applied", ranges.merged(known.unionByName(ranges.singles(normalized))))
    changes, applied = _census(normalized)
    rejected = _load(batch, normalized, changes, dates, now) + [_unread(normalized)]
    _file_failures(batch, rejected, now)
    came = {r["topic"]: r["count"] for r in received.groupBy("topic").count().collect()}
    batch.commit(source, source_batch, {"received": came, "applied": applied})


_FAILURE = [*ADDRESS, "timestamp", "value", "error_type", "error_message", "error_stacktrace"]


def _unread(normalized: DataFrame) -> DataFrame:
    failed = normalized.filter(F.col("outcome") == "failed")
    return failed.withColumn("error_stacktrace", _as_trace()).select(*_FAILURE)


def _as_trace() -> Column:
    return F.concat("error_type", F.lit(": "), "error_message")


def _unseen(batch: Batch, records: DataFrame, known: DataFrame) -> DataFrame:
    """Records that were not applied before, one of each address.

    Those beyond the last offset of their topic partition were not; a row for each is known.
    Only what lies below, late or delivered again, is held against the ranges applied, and only
    by address: records as a whole are shuffled once.
    """
    tops = batch.keep("tops", known.groupBy("topic", "partition").agg(F.max("last").alias("top")))
    marked = records.join(F.broadcast(tops), ["topic", "partition"], "left")
    beyond = F.col("top").isNull() | (F.col("offset") > F.col("top"))
    late = batch.keep("late", marked.filter(~beyond).select(*ADDRESS))
    first, last = late.agg(F.min("offset"), F.max("offset")).first()
    if first is None:
        return facts.one_per_address(marked.filter(beyond).select(*records.columns))
    near = known.filter((F.col("last") >= first) & (F.col("first") <= last))
    again = batch.keep("again", ranges.covered(late, near))
    return facts.one_per_address(marked.filter(beyond.isNotNull()).select(*records.columns), again)


def _census(normalized: DataFrame) -> tuple[dict[str, int], dict[str, int]]:
    """Changes and records per topic."""
    rows = (
        normalized.groupBy("topic")
        .agg(F.count_if(F.col("outcome") == "change").alias("changes"), F.count("*").alias("records"))
        .collect()
    )
    return {r["topic"]: r["changes"] for r in rows}, {r["topic"]: r["records"] for r in rows}


def _load(
    batch: Batch,
    normalized: DataFrame,
    changes: dict[str, int],
    dates: DataFrame | None,
    now: datetime.datetime,
    revalidate: bool = True,
) -> list[DataFrame]:
    """Apply the changes of all topics; returns what was rejected on the way."""
    rejected = []
    for name, topic in (("dim_customer", CUSTOMERS), ("dim_product", PRODUCTS)):
        if changes.get(topic):
            checked = _checked(batch, normalized, topic, revalidate)
            _apply_dimension(batch, name, validate.valid(checked))
            rejected.append(_failures(validate.rejected(checked)))
    if changes.get(ORDERS):
        checked = _checked(batch, normalized, ORDERS)
        _apply_orders(batch, validate.valid(checked))
        rejected.append(_failures(validate.rejected(checked)))
    if changes.get(ORDER_ITEMS):
        items = _checked(batch, normalized, ORDER_ITEMS)
        rejected.append(_load_facts(batch, validate.valid(items), dates, now))
        rejected.append(_failures(validate.rejected(items)))
    return rejected


def _checked(
    batch: Batch, normalized: DataFrame, topic: str, revalidate: bool = True
) -> DataFrame:
    changes = envelope.changes_of(normalized, topic)
    if topic == CUSTOMERS:
        checked = validate.check_customers(changes, emails=revalidate)
    elif topic == PRODUCTS:
        checked = validate.check_products(changes)
    elif topic == ORDERS:
        checked = validate.check_orders(changes)
    else:
        checked = validate.check_order_items(changes)
    if topic != ORDER_ITEMS:
        # Only what is rejected is filed with its value; an item may still miss what it refers to.
        checked = checked.withColumn("value", F.when(F.size("errors") > 0, F.col("value")))
    return batch.keep("checked_" + topic.removeprefix(TOPIC_PREFIX), checked.drop("given"))


def _failures(rejected: DataFrame) -> DataFrame:
    return rejected.withColumnRenamed("ts", "timestamp").select(*_FAILURE)


def _apply_dimension(batch: Batch, name: str, changes: DataFrame) -> None:
    """State keeps the last version of each key, current or ended; the others are closed."""
    key, dimension = DIMENSIONS[name]
    changes = changes.drop("value", "topic")
    touched = batch.buckets(changes, key)
    state = batch.state(name, touched)
    keys = changes.select(key).distinct()
    ended = state.filter(~F.col("is_current"))
    versions = scd.apply_changes(
        state.filter("is_current"),
        changes,
        key,
        dimension,
        ended.select(key, F.col("valid_to").alias("ended_at")),
    )
    known = batch.keep(name, versions.unionByName(ended.join(keys, key, "left_semi")))
    turn = F.struct("is_current", "valid_to", "valid_from", "version", "open_partition", "open_offset")
    last = known.groupBy(F.col(key).alias("of_key")).agg(F.max(turn).alias("last"))
    placed = known.join(last, F.col(key) == F.col("of_key"))
    is_last = turn == F.col("last")
    batch.append(f"{name}_closed", placed.filter(~is_last))
    batch.upsert(name, placed.filter(is_last))


def _apply_orders(batch: Batch, changes: DataFrame) -> None:
    """The latest image of each order, deleted ones marked."""
    touched = batch.buckets(changes, "order_id")
    columns = ["customer_id", "order_date", "status", "total_amount"]
    new = changes.withColumn("order_date", event_time("order_date")).select(
        "order_id",
        F.struct(F.lit(1).alias("turn"), "partition", "offset").alias("seq"),
        F.struct(
            *columns, F.col("op").eqNullSafe("d").alias("deleted"), "partition", "offset"
        ).alias("row"),
    )
    stored = batch.state("orders", touched).select(
        "order_id",
        F.struct(F.lit(0).alias("turn"), "partition", "offset").alias("seq"),
        F.struct(*columns, "deleted", "partition", "offset").alias("row"),
    )
    latest = (
        stored.join(changes.select("order_id").distinct(), "order_id", "left_semi")
        .unionByName(new)
        .groupBy("order_id")
        .agg(F.max_by("row", "seq").alias("row"))
        .select("order_id", "row.*")
    )
    batch.upsert("orders", latest)


def _load_facts(
    batch: Batch, items: DataFrame, dates: DataFrame | None, now: datetime.datetime
) -> DataFrame:
    """Load items; those that miss a row they refer to are returned, to be tried again.

    Only the buckets that hold a key in question are read from each state table.
    """
    spark = batch.warehouse.spark
    dates = metrics.dim_date(spark) if dates is None else dates
    columns = [*ADDRESS, "ts", "value", *_ITEM]
    waiting = items.select(*columns, F.lit("c").alias("op"))
    orders = (
        batch.state("orders", batch.buckets(waiting, "order_id"))
        .filter(~F.col("deleted"))
        .select("order_id", "customer_id", "order_date", "status")
        .join(waiting.select("order_id").distinct(), "order_id", "left_semi")
    )
    customers = batch.state("dim_customer", batch.buckets(orders, "customer_id"))
    products = batch.state("dim_product", batch.buckets(waiting, "product_id"))
    resolved = facts.resolve(waiting, orders, customers, products, dates)
    # What was found is not filed, so its value is not written again.
    unfound = F.when(F.col("reason").isNotNull(), F.col("value"))
    resolved = batch.keep("resolved", resolved.withColumn("value", unfound))
    batch.append("fact_orders", facts.facts(resolved).withColumn("created_at", naive(now)))
    failed = facts.out_of_range(resolved).unionByName(facts.unresolved(resolved))
    filed = failed.select(
        *ADDRESS,
        F.col("ts").alias("timestamp"),
        "value",
        F.when(F.col("reason") == "date_out_of_range", "IntegrityError")
        .otherwise("LookupError")
        .alias("error_type"),
        F.col("reason").alias("error_message"),
    )
    return filed.withColumn("error_stacktrace", _as_trace()).select(*_FAILURE)


def _file_failures(batch: Batch, rejected: list[DataFrame], now) -> None:
    attempts = dlq.attempts(_union(rejected), now).withColumn(
        "failed_message_id", dlq.message_id()
    )
    touched = batch.buckets(attempts, "failed_message_id")
    ids = attempts.select("failed_message_id").distinct()
    stored = batch.state("failed_messages", touched).join(ids, "failed_message_id", "left_semi")
    batch.upsert("failed_messages", dlq.upsert(attempts, stored))


def _names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(",")]


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def retry(
    warehouse: Warehouse,
    now: datetime.datetime,
    limit: int = 100,
    message: int | None = None,
    dates: DataFrame | None = None,
    revalidate: bool = True,
) -> dict[str, int]:
    """Replay failed messages: the next due ones, or a single one on request.

    A single retry never gives a message up. With `revalidate=False` the check on
    emails is left out, so what it rejected goes through.
    """
    batch = warehouse.begin()
    if message is None:
        ready = dlq.retry_batch(warehouse.due(now), now, limit)
    else:
        one = {warehouse.bucket_number(message)}
        ready = dlq.retry_one(batch.state("failed_messages", one), message)
    chosen = batch.keep("retried", ready)
    normalized = batch.keep("normalized", envelope.normalize(dlq.records(chosen)), "topic")
    changes, _ = _census(normalized)
    rejected = _load(batch, normalized, changes, dates, now, revalidate) + [_unread(normalized)]
    errors = _union(rejected).withColumnRenamed("offset", "message_offset")
    outcomes = batch.keep("outcomes", dlq.outcomes(chosen, errors))
    give_up = message is None
    totals = dlq.run_totals(chosen, outcomes, give_up).collect()[0].asDict()
    tried = chosen.select("failed_message_id")
    touched = batch.buckets(tried, "failed_message_id")
    stored = batch.state("failed_messages", touched).join(tried, "failed_message_id", "left_semi")
    batch.upsert("failed_messages", dlq.apply_outcomes(stored, outcomes, now, give_up))
    batch.commit()
    return totals
