"""Every operator as a query over the tables of one folder."""

import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scdflow.functions import date_key, margin, money, naive
from scdflow.operators import bootstrap, dlq, envelope, facts, ranges, scd, timetree, validate
from scdflow.plans import history, metrics, monitoring, sync
from scdflow.schemas import (
    ADDRESS,
    CUSTOMER_LENGTHS,
    CUSTOMER_TRACKED,
    CUSTOMER_TYPE1,
    CUSTOMERS,
    ORDER_ITEMS,
    ORDER_LENGTHS,
    ORDERS,
    PRODUCT_LENGTHS,
    PRODUCTS,
    RECORD,
)
from scdflow.sources.records import file_stream, with_epoch_time, write_files
from scdflow.sources.shared import new_folder, staged
from scdflow.sources.testdata import (
    CUSTOMER_CHANGES,
    CUSTOMER_SNAPSHOT,
    ORDER_COPY,
    WAIT_DAYS,
    WAITING_ITEMS,
    WAITING_ORDERS,
    Tables,
)
from scdflow.sources.warehouse import Warehouse
from scdflow.streaming import pipeline, stateful

AS_OF = datetime.datetime(2024, 1, 31)
REVENUE_DAY = datetime.date(2001, 8, 1)
#: Offset of the first change of 1998.
SPLIT = ((1998 - 1990) * 372 + 31 + 1) << 44
POINT_IN_TIME = datetime.datetime(1998, 6, 15)

_SPAN = ["version", "valid_from", "valid_to", "is_current"]
_CUSTOMER = [
    "customer_id",
    *_SPAN,
    "first_name",
    "last_name",
    "email",
    "phone",
    "address",
    "city",
    "country",
]
_PRODUCT = [
    "product_id",
    *_SPAN,
    "product_name",
    "category",
    "brand",
    "description",
    "price",
    "cost",
    "margin_percentage",
]


def _shown(rows: DataFrame, *columns) -> DataFrame:
    """Results as a client gets them: amounts as numbers, the open end as text."""
    chosen = rows.select(*columns)
    amounts = [f.name for f in chosen.schema if f.dataType.typeName() == "decimal"]
    shown = {c: F.col(c).cast("double") for c in amounts}
    if "valid_to" in chosen.columns:
        shown["valid_to"] = F.col("valid_to").cast("string")
    return chosen.withColumns(shown)




# Records and envelopes


def _by_partition(records: DataFrame) -> DataFrame:
    return records.groupBy("topic", "partition").agg(
        F.count("*").alias("records"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


def cdc_source(t: Tables) -> DataFrame:
    return _by_partition(t.records())


def cdc_stream(t: Tables) -> DataFrame:
    """All records through a stream of files, a few at a time, and counted as in `cdc_source`."""
    spark, folder = t.spark, new_folder(t.spark, "stream")
    write_files(t.records(), f"{folder}/in")
    query = (
        file_stream(spark, f"{folder}/in", max_files=4)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    query.awaitTermination()
    return _by_partition(spark.read.schema(RECORD).parquet(f"{folder}/out"))


def _streamed(stream: DataFrame, folder: str, name: str = "out") -> None:
    """One run of a stream over all there is, into `folder/out`; a later one goes on from there."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/check-{name}")
    writer.trigger(availableNow=True).start(f"{folder}/{name}").awaitTermination()


def _folder_stream(spark, like: DataFrame, folder: str) -> DataFrame:
    return spark.readStream.schema(like.schema).parquet(folder)


def cdc_stream_dedup(t: Tables) -> DataFrame:
    """Item records in waves of two years, each with a part of the wave before again."""
    folder, records = new_folder(t.spark, "dedup"), t.item_records()
    year = F.year("timestamp")
    for first in range(1992, 2003, 2):
        wave = records.filter((year >= first) & (year < first + 2))
        again = records.filter((year >= first - 2) & (year < first) & (F.col("offset") % 10 == 0))
        wave.unionByName(again).write.mode("append").parquet(f"{folder}/in")
        _streamed(stateful.once(_folder_stream(t.spark, records, f"{folder}/in"), "1500 days"), folder)
    return _by_partition(t.spark.read.schema(RECORD).parquet(f"{folder}/out"))


def applied_ranges(t: Tables) -> DataFrame:
    """Ranges of the offsets of item records, merged from three batches that come out of order."""
    records = t.item_records().select(*ADDRESS)
    held = t.spark.createDataFrame([], ranges.RANGE)
    for part in (2, 0, 1):
        batch = records.filter(F.col("offset") % 3 == part)
        new = ranges.islands(ranges.uncovered(batch, held))
        held = staged(ranges.merged(held.unionByName(new)), "applied")
    return held


def cdc_decode(t: Tables) -> DataFrame:
    return envelope.decode(t.customer_records()).select("partition", "offset", "timestamp", "kind")


def cdc_tombstones(t: Tables) -> DataFrame:
    return envelope.tombstones(t.records())


def cdc_normalize(t: Tables) -> DataFrame:
    rows = envelope.normalize(t.customer_records())
    return rows.select(
        "partition",
        "offset",
        "wrapped",
        "op",
        "outcome",
        "error_type",
        F.try_variant_get("image", "$.customer_id", "bigint").alias("customer_id"),
        F.try_variant_get("image", "$.phone", "string").alias("phone"),
    )


def cdc_route_counts(t: Tables) -> DataFrame:
    return envelope.route_counts(envelope.normalize(t.records()))


def cdc_op_counts(t: Tables) -> DataFrame:
    return envelope.op_counts(envelope.normalize(t.records()))


# Checks


def _checked_customers(t: Tables) -> DataFrame:
    normalized = envelope.normalize(t.customer_records())
    return validate.check_customers(envelope.changes_of(normalized, CUSTOMERS))


def _checked_products(t: Tables) -> DataFrame:
    normalized = envelope.normalize(t.product_records())
    return validate.check_products(envelope.changes_of(normalized, PRODUCTS))


def validate_customers(t: Tables) -> DataFrame:
    return _checked_customers(t).select(
        "partition",
        "offset",
        "op",
        "customer_id",
        F.size("errors").alias("n_errors"),
        F.get("errors", F.lit(0))["error_type"].alias("error_type"),
    )


def validate_products(t: Tables) -> DataFrame:
    return _checked_products(t).select(
        "partition",
        "offset",
        "op",
        "product_id",
        F.size("errors").alias("n_errors"),
        F.get("errors", F.lit(0))["error_type"].alias("error_type"),
    )


def _changes(t: Tables, records: DataFrame, topic: str) -> DataFrame:
    return envelope.changes_of(envelope.normalize(records), topic)


def _stacked(counts: dict[str, DataFrame]) -> DataFrame:
    return _stacked_by("table_name", counts)


def _stacked_by(column: str, counts: dict) -> DataFrame:
    named = [rows.select(F.lit(name).alias(column), "*") for name, rows in counts.items()]
    return reduce(DataFrame.unionByName, named)


def validate_not_null(t: Tables) -> DataFrame:
    """Nulls in the columns of the warehouse that must have none, facts as they are loaded."""
    loaded = facts.facts(_resolved(t))
    return _stacked(
        {
            "customers": validate.null_counts(
                _changes(t, t.customer_records(), CUSTOMERS), ["customer_id"]
            ),
            "products": validate.null_counts(
                _changes(t, t.product_records(), PRODUCTS), ["product_id"]
            ),
            "order_items": validate.null_counts(
                _changes(t, t.item_records(), ORDER_ITEMS),
                ["order_item_id", "order_id", "product_id", "quantity"],
            ),
            "fact_orders": validate.null_counts(
                loaded,
                ["customer_key", "product_key", "date_key", "quantity", "unit_price", "line_total"],
            ),
        }
    )


def validate_lengths(t: Tables) -> DataFrame:
    return _stacked(
        {
            "customers": validate.overlong_counts(
                _changes(t, t.customer_records(), CUSTOMERS), CUSTOMER_LENGTHS
            ),
            "products": validate.overlong_counts(
                _changes(t, t.product_records(), PRODUCTS), PRODUCT_LENGTHS
            ),
            "orders": validate.overlong_counts(_changes(t, t.order_records(), ORDERS), ORDER_LENGTHS),
        }
    )


def validate_orders(t: Tables) -> DataFrame:
    checked = validate.check_orders(_changes(t, t.order_records(), ORDERS))
    return checked.select(
        "partition",
        "offset",
        "op",
        "order_id",
        F.size("errors").alias("n_errors"),
        F.get("errors", F.lit(0))["error_type"].alias("error_type"),
    )


def keyless_changes(t: Tables) -> DataFrame:
    """Customer changes that no fold can take, for they name no customer."""
    return scd.keyless(_changes(t, t.customer_records(), CUSTOMERS), "customer_id")


def dup_keys(t: Tables) -> DataFrame:
    return validate.duplicates(t.item_records(), ADDRESS)


def dup_emails(t: Tables) -> DataFrame:
    """Emails that more than one current customer has."""
    return validate.duplicates(_customers(t).filter("is_current"), ["email"])


def orphan_rows(t: Tables) -> DataFrame:
    customers = _customers(t).filter("is_current")
    orders, items = t.orders(), t.items()
    placed = _orders_from_records(t)
    dates = metrics.dim_date(t.spark).select("date_key")
    dated = orders.select("order_id", date_key("order_date").alias("date_key"))
    found = {
        "order_customer": (orders, customers, "customer_id", "order_id"),
        "item_order": (items, placed, "order_id", "order_item_id"),
        "item_product": (items, t.snapshot_products(), "product_id", "order_item_id"),
        "order_date": (dated, dates, "date_key", "order_id"),
    }
    counted = [
        validate.orphans(rows, parents, key).agg(
            F.lit(name).alias("relation"),
            F.count("*").alias("orphans"),
            F.min(row_id).alias("first_id"),
            F.max(row_id).alias("last_id"),
        )
        for name, (rows, parents, key, row_id) in found.items()
    ]
    result = counted[0]
    for more in counted[1:]:
        result = result.unionByName(more)
    return result


# Dimensions


def _customers(t: Tables) -> DataFrame:
    return scd.customer_dimension(t.customer_changes())


def _products(t: Tables) -> DataFrame:
    return scd.product_dimension(t.product_changes())


def dim_customer_scd2(t: Tables) -> DataFrame:
    return _shown(_customers(t), *_CUSTOMER, F.col("open_seq.offset").alias("open_offset"))


def dim_product_scd2(t: Tables) -> DataFrame:
    return _shown(_products(t), *_PRODUCT, F.col("open_seq.l_orderkey").alias("open_orderkey"))


#: Small enough for many keys of the test tables to be hot, and to be cut into many slices.
_SLICED = {"hot_rows": 20, "slice_rows": 500}


def dim_product_scd2_sliced(t: Tables) -> DataFrame:
    """As `dim_product_scd2`, by the way that hot keys take."""
    versions = scd.product_dimension(t.product_changes(), **_SLICED)
    return _shown(versions, *_PRODUCT, F.col("open_seq.l_orderkey").alias("open_orderkey"))


def scd2_integrity_sliced(t: Tables) -> DataFrame:
    versions = scd.customer_dimension(t.customer_changes(), hot_rows=5, slice_rows=100)
    return scd.integrity(versions, "customer_id", hot_rows=3, slice_rows=50)


def bootstrap_dims(t: Tables) -> DataFrame:
    snapshot = t.feed("customer", CUSTOMER_SNAPSHOT)
    changes = snapshot.unionByName(t.customer_changes())
    versions = scd.customer_dimension(changes)
    return _shown(versions, *_CUSTOMER, F.col("open_seq.offset").alias("open_offset"))


#: First position that the capture of changes sees.
CAPTURED = ((1996 - 1990) * 372 + 31 + 1) << 44


def bootstrap_interleaved(t: Tables) -> DataFrame:
    """Customers from chunks read while the table changed, and the changes captured since."""
    captured = t.customer_changes().filter("op <> 'r'").filter(F.col("offset") > CAPTURED)
    log = bootstrap.interleaved(t.chunk_reads(), captured, "customer_id")
    return history.current_customers(scd.customer_dimension(log))


def dim_customer_from_cdc(t: Tables) -> DataFrame:
    """Records to versions: envelope and checks, written once, and the fold."""
    changes = staged(validate.valid(_checked_customers(t)).drop("value", "given"), "changes")
    versions = scd.customer_dimension(changes)
    return _shown(versions, *_CUSTOMER, F.col("open_seq.offset").alias("open_offset"))


def scd2_change_flags(t: Tables) -> DataFrame:
    changes = t.customer_changes().withColumn("seq", scd.by_address())
    flags = scd.change_flags(changes, "customer_id", CUSTOMER_TRACKED)
    return flags.select("customer_id", F.col("seq.offset").alias("offset"), "op", "opens")


def dim_customer_scd1_latest(t: Tables) -> DataFrame:
    return scd.latest_type1(_customers(t), "customer_id", CUSTOMER_TYPE1)


def dim_deleted_keys(t: Tables) -> DataFrame:
    return scd.deleted_keys(_customers(t), "customer_id")


def product_margin(t: Tables) -> DataFrame:
    lines = t.feed(
        "lineitem",
        {
            "order_item_id": "l_orderkey * 8 + l_linenumber",
            "price": "cast(l_extendedprice as decimal(10,2))",
            "cost": "cast(l_quantity * 1000 as decimal(10,2))",
        },
    )
    return lines.select(
        "order_item_id",
        money("price").cast("double").alias("price"),
        money("cost").cast("double").alias("cost"),
        margin("price", "cost").cast("double").alias("margin_percentage"),
    )


def scd2_two_batches(t: Tables) -> DataFrame:
    changes = t.customer_changes()
    first = changes.filter(F.col("offset") < SPLIT)
    second = changes.filter(F.col("offset") >= SPLIT)
    stored = scd.as_stored(scd.customer_dimension(first))
    versions = scd.apply_to(stored, second, "customer_id", scd.customer_dimension)
    return _shown(versions, *_CUSTOMER, "open_offset")


def scd2_integrity(t: Tables) -> DataFrame:
    return scd.integrity(_customers(t), "customer_id")


def dim_as_of(t: Tables) -> DataFrame:
    return _shown(scd.valid_at(_customers(t), naive(POINT_IN_TIME)), *_CUSTOMER)


def dim_as_of_pruned(t: Tables) -> DataFrame:
    """As `dim_as_of`: closed versions from the folders around the instant, open ones as they are."""
    folder, versions = new_folder(t.spark, "timetree"), staged(_customers(t), "customers")
    closed = versions.filter(~F.col("is_current"))
    timetree.file(closed, folder)
    now = versions.filter("is_current")
    found = timetree.at(closed, folder, POINT_IN_TIME)
    return _shown(found.unionByName(scd.valid_at(now, naive(POINT_IN_TIME))), *_CUSTOMER)


# Facts


def _orders_from_records(t: Tables) -> DataFrame:
    rows = envelope.changes_of(envelope.normalize(t.order_records()), ORDERS)
    return facts.latest_orders(rows)


def latest_orders(t: Tables) -> DataFrame:
    return _orders_from_records(t).select(
        "order_id", "customer_id", "order_date", "status", "total_amount"
    )


def date_keys(t: Tables) -> DataFrame:
    return t.orders().select("order_id", date_key("order_date").alias("date_key"))


def _resolved(t: Tables, lookup: str = "current", dates: DataFrame | None = None) -> DataFrame:
    return facts.resolve(
        t.items(),
        t.orders(),
        _customers(t),
        _products(t),
        t.dates() if dates is None else dates,
        lookup,
    )


def _snapshot_facts(t: Tables, since: datetime.date | None = None) -> DataFrame:
    """Facts of all orders, or of those from a day on; the bound reaches the scan of orders."""
    orders = t.orders()
    if since is not None:
        orders = orders.filter(F.col("order_date") >= naive(datetime.datetime.combine(since, datetime.time())))
    resolved = facts.resolve(
        t.items(),
        orders,
        t.snapshot_customers(),
        t.snapshot_products(),
        t.dates(),
    )
    return facts.facts(resolved)


_FACT = [
    "order_id",
    "order_item_id",
    "customer_id",
    "product_id",
    "date_key",
    "quantity",
    "unit_price",
    "line_total",
    "order_status",
]


def fact_orders_load(t: Tables) -> DataFrame:
    return _shown(facts.facts(_resolved(t)), *_FACT)


def fact_rejects(t: Tables) -> DataFrame:
    return facts.unresolved(_resolved(t)).select("order_item_id", "order_id", "product_id", "reason")


def fact_date_rejects(t: Tables) -> DataFrame:
    resolved = facts.resolve(
        t.items(),
        t.orders(),
        t.snapshot_customers(),
        t.snapshot_products(),
        metrics.dim_date(t.spark),
    )
    return facts.out_of_range(resolved).select("order_item_id", "date_key", "reason")


def _kept(versions: DataFrame, entity: str) -> DataFrame:
    """What a lookup needs of the versions, folded once."""
    return staged(
        versions.select(
            f"{entity}_id",
            f"{entity}_key",
            F.col("version").alias(f"{entity}_version"),
            "valid_from",
            "valid_to",
            "is_current",
            "open_seq",
        ),
        f"{entity}_versions",
    )


def _facts_as_of(t: Tables, **sizes) -> DataFrame:
    resolved = facts.resolve(
        t.items(),
        t.orders(),
        _kept(_customers(t), "customer"),
        _kept(_products(t), "product"),
        t.dates(),
        "asof",
        customer_columns=["customer_version"],
        product_columns=["product_version"],
        found_only=True,
        **sizes,
    )
    versions = ["customer_version", "product_version"]
    return _shown(facts.facts(resolved, *versions), *_FACT, *versions)


def fact_orders_asof(t: Tables) -> DataFrame:
    """Facts by the versions valid at the order date, named by version number."""
    return _facts_as_of(t)


def fact_orders_asof_sliced(t: Tables) -> DataFrame:
    """As `fact_orders_asof`, by the way that hot keys take."""
    return _facts_as_of(t, **_SLICED)


def fact_dedup(t: Tables) -> DataFrame:
    """Item records to facts, with records delivered twice loaded once."""
    once = facts.one_per_address(t.item_records())
    changes = envelope.changes_of(envelope.normalize(once), ORDER_ITEMS)
    items = validate.valid(validate.check_order_items(changes)).select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total", "op"
    )
    resolved = facts.resolve(
        items,
        t.orders(),
        t.snapshot_customers(),
        t.snapshot_products(),
        t.dates(),
    )
    return _shown(facts.facts(resolved), *_FACT)


# Failed messages


def _failed(t: Tables) -> DataFrame:
    return dlq.upsert(t.failed_attempts())


def _outcomes(failed: DataFrame) -> DataFrame:
    return _tried(dlq.ready_for_retry(failed, AS_OF))


def _tried(chosen: DataFrame) -> DataFrame:
    return chosen.select(
        *dlq.MESSAGE,
        (F.col("message_offset") % 3 == 0).alias("succeeded"),
        F.lit("still failing").alias("error_message"),
    )


_MESSAGE = [
    "topic",
    "partition",
    "message_offset",
    "error_type",
    "error_message",
    "retry_count",
    "max_retries",
    "last_retry_at",
    "next_retry_at",
    "status",
    "failed_at",
    "resolved_at",
]


def failed_capture(t: Tables) -> DataFrame:
    # Written once: both kinds of failure come from it, and parsing is the work.
    normalized = staged(envelope.normalize(t.customer_records()), "normalized")
    unread = normalized.filter(F.col("outcome") == "failed")
    invalid = validate.rejected(
        validate.check_customers(envelope.changes_of(normalized, CUSTOMERS))
    )
    captured = dlq.upsert(
        dlq.attempts(unread, AS_OF).unionByName(dlq.attempts(invalid, AS_OF))
    )
    return captured.select(
        "topic",
        "partition",
        "message_offset",
        "message_timestamp",
        "message_value",
        "error_type",
        F.size(F.split("error_stacktrace", "\n")).alias("n_errors"),
        "retry_count",
        "max_retries",
        "next_retry_at",
        "status",
        "failed_at",
    )


def failed_upsert(t: Tables) -> DataFrame:
    return _failed(t).select(*_MESSAGE, "message_value", "message_timestamp")


def failed_upsert_stored(t: Tables) -> DataFrame:
    """The same attempts in two batches, the first one stored."""
    tries = t.failed_attempts()
    split = naive(datetime.datetime(2024, 1, 10))
    stored = dlq.upsert(tries.filter(F.col("failed_at") < split))
    return dlq.upsert(tries.filter(F.col("failed_at") >= split), stored).select(
        *_MESSAGE, "message_value", "message_timestamp"
    )


def ready_for_retry(t: Tables) -> DataFrame:
    return dlq.ready_for_retry(_failed(t), AS_OF).drop("failed_message_id")


def retry_batch(t: Tables) -> DataFrame:
    return dlq.retry_batch(_failed(t), AS_OF).drop("failed_message_id")


def retry_outcome(t: Tables) -> DataFrame:
    failed = _failed(t)
    return dlq.apply_outcomes(failed, _outcomes(failed), AS_OF).select(*_MESSAGE)


def retry_run_totals(t: Tables) -> DataFrame:
    failed = _failed(t)
    return dlq.run_totals(dlq.ready_for_retry(failed, AS_OF), _outcomes(failed))


def retry_one_outcome(t: Tables) -> DataFrame:
    """Each pending message retried on request: due or not, and never given up."""
    failed = _failed(t)
    outcomes = _tried(failed.filter("status = 'pending'"))
    return dlq.apply_outcomes(failed, outcomes, AS_OF, dead_letter=False).select(*_MESSAGE)


def retry_all(t: Tables) -> DataFrame:
    """One run of the retry job: the next hundred messages, their outcomes, and where they stand."""
    failed = _failed(t)
    chosen = dlq.retry_batch(failed, AS_OF)
    touched = failed.join(chosen.select(*dlq.MESSAGE), dlq.MESSAGE, "left_semi")
    return dlq.apply_outcomes(touched, _tried(chosen), AS_OF).select(*_MESSAGE)


def _replayed(t: Tables) -> DataFrame:
    """Customer records that were filed, as records again."""
    normalized = envelope.normalize(t.customer_records())
    invalid = validate.rejected(
        validate.check_customers(envelope.changes_of(normalized, CUSTOMERS))
    )
    filed = dlq.upsert(dlq.attempts(invalid, AS_OF))
    return envelope.normalize(dlq.records(filed))


def retry_replay(t: Tables) -> DataFrame:
    """Customer versions that a replay of rejected records makes without the check on emails."""
    checked = validate.check_customers(envelope.changes_of(_replayed(t), CUSTOMERS), emails=False)
    versions = scd.customer_dimension(validate.valid(checked))
    return _shown(versions, *_CUSTOMER, F.col("open_seq.offset").alias("open_offset"))


def retry_replay_outcomes(t: Tables) -> DataFrame:
    """How a replay goes, with the check on emails and without it."""
    changes = staged(envelope.changes_of(_replayed(t), CUSTOMERS), "replayed")
    return _stacked_by(
        "revalidated",
        {
            again: validate.check_customers(changes, emails=again).agg(
                F.count_if(F.size("errors") == 0).alias("succeeded"),
                F.count_if(F.size("errors") > 0).alias("failed"),
            )
            for again in (True, False)
        },
    )


def record_time(t: Tables) -> DataFrame:
    """Record times as epoch milliseconds, every seventh one unknown."""
    sent = t.read("events").select(
        "event_id",
        F.when(
            F.col("event_id") % 7 != 0,
            F.unix_millis(F.col("ts").cast("timestamp_ntz").cast("timestamp")),
        ).alias("timestamp"),
    )
    return with_epoch_time(sent)


#: Records from this day on come first; all others come late.
LATE = datetime.datetime(1998, 1, 1)


def pipeline_batches(t: Tables) -> DataFrame:
    """All records in two batches, and what became of them.

    The first batch has the later part of all topics but the items; the second has the rest,
    at lower offsets, all items, and a tenth of the first batch again.
    """
    items = F.col("topic") == ORDER_ITEMS
    everything = t.records()
    first = everything.filter((F.col("timestamp") >= naive(LATE)) & ~items)
    rest = everything.filter((F.col("timestamp") < naive(LATE)) | items)
    house = Warehouse(t.spark, new_folder(t.spark, "house"), buckets=8)
    came: dict[str, int] = {}
    batches = (first, rest.unionByName(first.filter(F.col("offset") % 10 == 0)))
    for n, batch in enumerate(batches):
        pipeline.ingest(house, batch, "records", n, AS_OF, t.dates())
        for topic, count in house.record["counts"]["received"].items():
            came[topic] = came.get(topic, 0) + count
    received = t.spark.createDataFrame(sorted(came.items()), "topic string, received bigint")
    held = F.sum(F.col("last") - F.col("first") + 1)
    applied = house.appended("applied").groupBy("topic").agg(held.alias("applied"))
    filed = house.state("failed_messages").groupBy("topic").agg(F.count("*").alias("filed"))
    loaded = house.appended("fact_orders").agg(
        F.lit(ORDER_ITEMS).alias("topic"), F.count("*").alias("loaded")
    )
    joined = received.join(applied, "topic", "left").join(filed, "topic", "left")
    return joined.join(loaded, "topic", "left").fillna(0)


def retry_due_slots(t: Tables) -> DataFrame:
    """As `ready_for_retry`, over stored messages found by the hour of their next attempt.

    The messages are filed in two batches, so some have entries of attempts that are over.
    """
    tries, house = t.failed_attempts(), Warehouse(t.spark, new_folder(t.spark, "house"), buckets=8)
    split = naive(datetime.datetime(2024, 1, 10))
    for part in (F.col("failed_at") < split, F.col("failed_at") >= split):
        batch = house.begin()
        batch.upsert("failed_messages", dlq.upsert(tries.filter(part), house.state("failed_messages")))
        batch.commit()
    return dlq.ready_for_retry(house.due(AS_OF), AS_OF).drop("failed_message_id")


def failed_summary(t: Tables) -> DataFrame:
    return monitoring.summary(_failed(t)).withColumn(
        "avg_retry_count", F.round("avg_retry_count", 6)
    )


def failed_status_counts(t: Tables) -> DataFrame:
    return monitoring.status_counts(_failed(t))


def failed_page(t: Tables) -> DataFrame:
    return monitoring.page_rows(_failed(t), 2, 20).drop("failed_message_id")


def failed_page_after(t: Tables) -> DataFrame:
    """The second page, found from the last row of the first."""
    failed = _failed(t)
    last = monitoring.page_after(failed, None, 20).collect()[-1:]
    return monitoring.page_after(failed, last[0] if last else None, 20).drop("failed_message_id")


def failed_page_deep(t: Tables) -> DataFrame:
    """The thirtieth page of ten, with few bins, so that they are cut several times."""
    failed = staged(_failed(t), "failed")
    page = monitoring.page_deep(failed, 30, 10, bins=8, sorted_rows=40)
    return page.drop("failed_message_id")


def failed_page_pending(t: Tables) -> DataFrame:
    return monitoring.page_rows(_failed(t), 1, 20, "pending").drop("failed_message_id")


def failed_detail_one(t: Tables) -> DataFrame:
    """The message with the first address, by its id."""
    failed = _failed(t)
    first = failed.orderBy(*dlq.MESSAGE).select("failed_message_id").first()
    return monitoring.detail(failed, first[0] if first else 0).drop("failed_message_id")


def failed_page_counts(t: Tables) -> DataFrame:
    return monitoring.page_counts(_failed(t), 20)


def failed_detail(t: Tables) -> DataFrame:
    return monitoring.detail(_failed(t)).drop("failed_message_id")


def partition_backlog(t: Tables) -> DataFrame:
    return monitoring.partition_backlog(_failed(t))


def partition_backlog_or_healthy(t: Tables) -> DataFrame:
    return monitoring.partition_backlog_or_healthy(_failed(t))


def failed_list_short(t: Tables) -> DataFrame:
    return monitoring.short_list(_failed(t))


def total_lag(t: Tables) -> DataFrame:
    return monitoring.total_lag(_failed(t))


# Warehouse queries


def daily_revenue(t: Tables) -> DataFrame:
    since = REVENUE_DAY - datetime.timedelta(days=30)
    loaded = _snapshot_facts(t, since)
    return metrics.daily_revenue(loaded, t.dates(), REVENUE_DAY, 30)


def daily_revenue_incremental(t: Tables) -> DataFrame:
    """As `daily_revenue`, kept up to date over three batches; orders lie in several of them."""
    since = REVENUE_DAY - datetime.timedelta(days=30)
    loaded = staged(_snapshot_facts(t, since), "facts")
    held = None
    for part in range(3):
        new = metrics.day_partials(loaded.filter(F.col("order_item_id") % 3 == part))
        held = new if held is None else metrics.merged_partials(held.unionByName(new))
        held = staged(held, "days")
    return metrics.daily_revenue_of(held, t.dates(), REVENUE_DAY, 30)


def revenue_by_grain(t: Tables) -> DataFrame:
    return metrics.revenue_by_grain(_snapshot_facts(t), t.dates(), "month")


def revenue_by_week(t: Tables) -> DataFrame:
    return metrics.revenue_by_grain(_snapshot_facts(t), t.dates(), "week")


def top_products(t: Tables) -> DataFrame:
    return metrics.top_products(_snapshot_facts(t), t.snapshot_products())


def top_products_ranked(t: Tables) -> DataFrame:
    return metrics.ranked(top_products(t), "total_revenue", "product_id")


def top_customers(t: Tables) -> DataFrame:
    return metrics.top_customers(_snapshot_facts(t), t.snapshot_customers())


def sales_by_category(t: Tables) -> DataFrame:
    return metrics.sales_by_category(_snapshot_facts(t), t.snapshot_products())


def sales_kpis(t: Tables) -> DataFrame:
    return metrics.sales_kpis(sales_by_category(t))


def _product_sales(t: Tables, **given) -> DataFrame:
    """Both dimensions are folded once: the lookups, their counts and the last join read them."""
    products = staged(_products(t), "products")
    resolved = facts.resolve(
        t.items(),
        t.orders(),
        _kept(_customers(t), "customer"),
        products,
        t.dates(),
        "asof",
        found_only=True,
    )
    return metrics.product_sales(facts.facts(resolved), products, **given)


def product_sales_current_versions(t: Tables) -> DataFrame:
    """Sales per product of facts whose product version is still current."""
    return _product_sales(t)


def product_sales_all_versions(t: Tables) -> DataFrame:
    return _product_sales(t, current_only=False)


def customer_history(t: Tables) -> DataFrame:
    return _shown(history.customer_history(_customers(t)), *_CUSTOMER, "n_versions", "is_open")


def product_history(t: Tables) -> DataFrame:
    columns = [c for c in _PRODUCT if c != "description"]
    return _shown(history.product_history(_products(t)), *columns, "n_versions", "is_open")


def current_customers(t: Tables) -> DataFrame:
    return history.current_customers(_customers(t))


def current_products(t: Tables) -> DataFrame:
    return history.current_products(_products(t))


def current_customers_stream(t: Tables) -> DataFrame:
    """Current customers as a keyed state stream leaves them, restarted once on its way."""
    spark, folder = t.spark, new_folder(t.spark, "live")
    changes = t.feed("orders", CUSTOMER_CHANGES | {"arrived": "o_orderdate"})
    changes = changes.withColumns({c: F.col(c).cast("timestamp") for c in ("ts", "arrived")})
    with stateful.state_on_disk(spark):
        for wave in (F.col("offset") < SPLIT, F.col("offset") >= SPLIT):
            changes.filter(wave).write.mode("append").parquet(f"{folder}/in")
            stream = _folder_stream(spark, changes, f"{folder}/in")
            _streamed(stateful.current_customers(stream), folder)
    rows = stateful.latest(spark.read.schema(stateful.UPDATE).parquet(f"{folder}/out"))
    return rows.withColumn("valid_from", naive(F.col("valid_from")))


def fact_orders_stream_join(t: Tables) -> DataFrame:
    """Items that waited for their order in two streams, and those for which none came, by order.

    One order in 17 is not sent, and orders come a wave after items. The last rows of both
    streams move the watermark on, beyond all that waits.
    """
    spark, folder = t.spark, new_folder(t.spark, "waiting")
    items = t.feed("lineitem", WAITING_ITEMS)
    orders = t.feed("orders", WAITING_ORDERS).filter("order_id % 17 <> 0")
    items, orders = (x.withColumn(c, F.col(c).cast("timestamp")) for x, c in ((items, "item_at"), (orders, "ordered_at")))
    end = "cast('2100-01-01' as timestamp)"
    last_item = spark.range(1).selectExpr("cast(-1 as bigint) order_item_id", "cast(-1 as bigint) order_id", f"{end} item_at")
    last_order = spark.range(1).selectExpr("cast(-1 as bigint) order_id", "cast(null as bigint) customer_id", f"{end} ordered_at")
    for wave in ((items, None), (None, orders), (last_item, last_order)):
        for name, rows, like in (("items", wave[0], items), ("orders", wave[1], orders)):
            rows = like.limit(0) if rows is None else rows
            rows.select(like.columns).write.mode("append").parquet(f"{folder}/{name}")
        joined = stateful.with_order(
            _folder_stream(spark, items, f"{folder}/items"),
            _folder_stream(spark, orders, f"{folder}/orders"),
            WAIT_DAYS,
        )
        _streamed(joined, folder)
    like = stateful.with_order(items, orders, WAIT_DAYS)
    return (
        spark.read.schema(like.schema)
        .parquet(f"{folder}/out")
        .filter("order_id >= 0")
        .groupBy("order_id")
        .agg(F.count("of_order").alias("loaded"), F.count_if(F.col("of_order").isNull()).alias("rejected"))
    )


def recent_changes(t: Tables) -> DataFrame:
    return history.recent_changes(_customers(t), _products(t), 20)


def dim_date(t: Tables) -> DataFrame:
    return metrics.calendar_of(t.orders(), "order_date")


def dim_date_extend(t: Tables) -> DataFrame:
    shipped = metrics.calendar_of(t.read("lineitem"), "l_shipdate")
    return metrics.extend_dates(dim_date(t), shipped)


def cdc_stats(t: Tables) -> DataFrame:
    """Each dimension is folded once; what its counts and the facts need of it is kept."""
    source = {"customers": t.read("customer"), "products": t.read("part"), "orders": t.orders()}
    customers = _customers(t).filter("is_current").select("customer_id", "customer_key", "is_current")
    products = _products(t).filter("is_current").select("product_id", "product_key", "is_current")
    customers, products = staged(customers, "customers"), staged(products, "products")
    resolved = facts.resolve(t.items(), t.orders(), customers, products, t.dates())
    return sync.cdc_stats(source, customers, products, facts.facts(resolved))


def source_counts(t: Tables) -> DataFrame:
    return sync.counts(
        {
            "customers": t.read("customer"),
            "products": t.read("part"),
            "orders": t.read("orders"),
            "order_items": t.read("lineitem"),
        }
    )


def sync_differences(t: Tables) -> DataFrame:
    """Orders whose rows differ from those of a copy that lost some, changed some and has others."""
    orders = t.orders()
    copy = t.feed("orders", ORDER_COPY).filter("order_id % 1009 <> 0")
    return sync.differences(orders, copy, "order_id", ["customer_id", "order_date", "status", "total_amount"])


def order_totals(t: Tables) -> DataFrame:
    return sync.order_totals(t.orders(), t.items())


QUERIES = [
    cdc_source,
    cdc_stream,
    cdc_stream_dedup,
    applied_ranges,
    cdc_decode,
    cdc_tombstones,
    cdc_normalize,
    cdc_route_counts,
    cdc_op_counts,
    validate_customers,
    validate_products,
    validate_not_null,
    validate_lengths,
    dup_keys,
    orphan_rows,
    dup_emails,
    validate_orders,
    keyless_changes,
    dim_customer_scd2,
    dim_product_scd2,
    dim_product_scd2_sliced,
    bootstrap_dims,
    bootstrap_interleaved,
    dim_customer_from_cdc,
    scd2_change_flags,
    dim_customer_scd1_latest,
    dim_deleted_keys,
    product_margin,
    scd2_two_batches,
    scd2_integrity,
    scd2_integrity_sliced,
    dim_as_of,
    dim_as_of_pruned,
    latest_orders,
    date_keys,
    fact_orders_load,
    fact_rejects,
    fact_date_rejects,
    fact_orders_asof,
    fact_orders_asof_sliced,
    fact_dedup,
    fact_orders_stream_join,
    failed_capture,
    failed_upsert,
    failed_upsert_stored,
    ready_for_retry,
    retry_batch,
    retry_due_slots,
    retry_outcome,
    retry_run_totals,
    retry_one_outcome,
    retry_all,
    retry_replay,
    retry_replay_outcomes,
    record_time,
    pipeline_batches,
    failed_summary,
    failed_status_counts,
    failed_page,
    failed_page_after,
    failed_page_deep,
    failed_page_pending,
    failed_detail_one,
    failed_page_counts,
    failed_detail,
    partition_backlog,
    partition_backlog_or_healthy,
    failed_list_short,
    total_lag,
    daily_revenue,
    daily_revenue_incremental,
    revenue_by_grain,
    revenue_by_week,
    top_products,
    top_products_ranked,
    top_customers,
    sales_by_category,
    sales_kpis,
    product_sales_current_versions,
    product_sales_all_versions,
    customer_history,
    product_history,
    current_customers,
    current_customers_stream,
    current_products,
    recent_changes,
    dim_date,
    dim_date_extend,
    cdc_stats,
    source_counts,
    sync_differences,
    order_totals,
]
