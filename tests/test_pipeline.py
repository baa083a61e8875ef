"""The batch pipeline against one-shot operators; restart, replay and retry."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from scdflow.operators import envelope, facts, scd, validate
from scdflow.plans import metrics
from scdflow.schemas import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS, RECORD
from scdflow.sources import records as sources
from scdflow.sources.testdata import Tables
from scdflow.sources.warehouse import Warehouse
from scdflow.streaming import pipeline

pytestmark = pytest.mark.usefixtures("interpreted")

NOW = dt.datetime(2024, 5, 1)
DAY = dt.datetime(2024, 1, 1)


def customer(cid, **changes):
    row = {
        "customer_id": cid,
        "first_name": "A",
        "last_name": "B",
        "email": f"c{cid}@x.org",
        "phone": "1",
        "address": None,
        "city": "X",
        "country": "Y",
    }
    return row | changes


def product(pid, **changes):
    row = {"product_id": pid, "product_name": "p", "category": "c", "brand": "b", "description": None}
    return row | {"price": 10.0, "cost": 4.0} | changes


def order(oid, cid, date="2024-03-01T00:00:00Z"):
    return {"order_id": oid, "customer_id": cid, "order_date": date, "status": "shipped", "total_amount": 5.0}


def item(iid, oid, pid, **changes):
    row = {"order_item_id": iid, "order_id": oid, "product_id": pid, "quantity": 2}
    return row | {"unit_price": 2.5, "line_total": 5.0} | changes


def record(topic, offset, after=None, before=None, raw=None, partition=0):
    value = raw if raw is not None else json.dumps({"before": before, "after": after})
    return (topic, partition, offset, DAY + dt.timedelta(minutes=offset), None, value)


def frame(spark, rows):
    return spark.createDataFrame(rows, RECORD)


def keys(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


FIRST = [
    record(CUSTOMERS, 1, customer(1)),
    record(CUSTOMERS, 2, customer(2)),
    record(CUSTOMERS, 3, customer(3, email="Error@x.org")),
    record(CUSTOMERS, 4, raw="{bad"),
    record(PRODUCTS, 1, product(1)),
    record(ORDERS, 1, order(1, 1)),
    record(ORDERS, 2, order(2, 3)),
    record(ORDERS, 3, order(3, 1, "2050-01-01T00:00:00Z")),
    record(ORDER_ITEMS, 1, item(1, 1, 1)),
    record(ORDER_ITEMS, 2, item(2, 2, 1)),
    record(ORDER_ITEMS, 3, item(3, 9, 1)),
    record(ORDER_ITEMS, 4, item(4, 3, 1)),
    record(ORDER_ITEMS, 5, item(5, 1, 1), before=item(5, 1, 1)),
]
SECOND = [
    record(CUSTOMERS, 5, customer(1, phone="2"), customer(1)),
    record(CUSTOMERS, 6, customer(2, last_name="C"), customer(2)),
    record(CUSTOMERS, 7, None, customer(2, last_name="C")),
    record(PRODUCTS, 2, product(1, price=12.0), product(1)),
    record(ORDERS, 4, order(9, 1)),
    record(ORDER_ITEMS, 1, item(1, 1, 1)),
    record(ORDER_ITEMS, 6, item(6, 1, 1)),
]


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "house"), buckets=4)


def check_first(house):
    assert keys(house.dimension("dim_customer"), "customer_id", "version", "is_current") == [
        (1, 1, True),
        (2, 1, True),
    ]
    assert keys(house.appended("fact_orders"), "order_item_id") == [(1,)]
    columns = ["topic", "message_offset", "error_type", "error_message"]
    assert [r[:3] for r in keys(house.state("failed_messages"), *columns)] == [
        (CUSTOMERS, 3, "ValueError"),
        (CUSTOMERS, 4, "JSONDecodeError"),
        (ORDER_ITEMS, 2, "LookupError"),
        (ORDER_ITEMS, 3, "LookupError"),
        (ORDER_ITEMS, 4, "IntegrityError"),
    ]
    assert house.state("failed_messages").filter("error_stacktrace IS NULL").count() == 0


def check_second(house):
    got = keys(house.dimension("dim_customer"), "customer_id", "version", "is_current", "phone", "last_name")
    assert got == [
        (1, 1, False, "1", "B"),
        (1, 2, True, "2", "B"),
        (2, 1, False, "1", "C"),
    ]
    assert keys(house.dimension("dim_product"), "version", "is_current") == [(1, False), (2, True)]
    assert keys(house.appended("fact_orders"), "order_item_id") == [(1,), (6,)]
    assert house.record["counts"]["received"][ORDER_ITEMS] == 2
    assert house.record["counts"]["applied"][ORDER_ITEMS] == 1


def test_two_batches(spark, house):
    pipeline.ingest(house, frame(spark, FIRST), "batch", 0, NOW)
    check_first(house)
    pipeline.ingest(house, frame(spark, SECOND), "batch", 1, NOW)
    check_second(house)
    # Seen again by a new process, and a batch that is delivered again does nothing.
    again = Warehouse(spark, house.root)
    pipeline.ingest(again, frame(spark, SECOND), "batch", 1, NOW)
    check_second(again)


def test_batch_that_failed_before_its_commit(spark, house, monkeypatch):
    pipeline.ingest(house, frame(spark, FIRST), "batch", 0, NOW)

    def lost(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(pipeline, "_file_failures", lost)
        with pytest.raises(RuntimeError):
            pipeline.ingest(house, frame(spark, SECOND), "batch", 1, NOW)
    check_first(Warehouse(spark, house.root))
    pipeline.ingest(Warehouse(spark, house.root), frame(spark, SECOND), "batch", 1, NOW)
    check_second(Warehouse(spark, house.root))


def test_stream_restarts(spark, tmp_path):
    folder, root, checkpoint = (str(tmp_path / n) for n in ("in", "house", "checkpoint"))
    for rows in (FIRST, SECOND):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        stream = sources.file_stream(spark, folder, max_files=1)
        query = pipeline.start(stream, Warehouse(spark, root, buckets=4), checkpoint)
        query.awaitTermination()
    check_second(Warehouse(spark, root))


def test_retry(spark, house):
    pipeline.ingest(house, frame(spark, FIRST), "batch", 0, NOW)
    later = NOW + dt.timedelta(minutes=6)
    assert pipeline.retry(house, NOW) == {"succeeded": 0, "failed": 0, "dead_lettered": 0}
    assert pipeline.retry(house, later) == {"succeeded": 0, "failed": 5, "dead_lettered": 0}
    second = later + dt.timedelta(minutes=16)
    # Without the email check the rejected customer goes through, as the newest change, and
    # so does the item that waited for it.
    assert pipeline.retry(house, second, revalidate=False) == {
        "succeeded": 2,
        "failed": 3,
        "dead_lettered": 0,
    }
    assert (2,) in keys(house.appended("fact_orders"), "order_item_id")
    assert (3, 1) in keys(house.state("dim_customer"), "customer_id", "version")
    third = second + dt.timedelta(minutes=16)
    wider = metrics.dim_date(spark, dt.date(2020, 1, 1), dt.date(2060, 1, 1))
    # The order of item 3 comes before its last attempt.
    pipeline.ingest(house, frame(spark, SECOND), "batch", 1, NOW)
    assert pipeline.retry(house, third, dates=wider) == {
        "succeeded": 2,
        "failed": 0,
        "dead_lettered": 1,
    }
    assert keys(house.appended("fact_orders"), "order_item_id") == [(i,) for i in (1, 2, 3, 4, 6)]
    assert keys(house.state("failed_messages"), "message_offset", "topic", "status", "retry_count") == [
        (2, ORDER_ITEMS, "resolved", 1),
        (3, CUSTOMERS, "resolved", 1),
        (3, ORDER_ITEMS, "resolved", 2),
        (4, CUSTOMERS, "dead_letter", 2),
        (4, ORDER_ITEMS, "resolved", 2),
    ]
    by_month = house.facts(dt.date(2050, 1, 1))
    assert keys(by_month, "order_item_id") == [(4,)]
    assert "month" in plan_of(by_month) and "PartitionFilters: [" in plan_of(by_month)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_retry_of_one_message_never_gives_up(spark, house):
    pipeline.ingest(house, frame(spark, FIRST), "batch", 0, NOW)
    bad = house.state("failed_messages").filter("error_type = 'JSONDecodeError'").collect()[0]
    for n in range(1, 5):
        totals = pipeline.retry(house, NOW, message=bad["failed_message_id"])
        assert totals == {"succeeded": 0, "failed": 1, "dead_lettered": 0}
        got = house.state("failed_messages").filter("error_type = 'JSONDecodeError'").collect()[0]
        assert (got["status"], got["retry_count"]) == ("pending", n)


def test_replay_starts_no_earlier_than_the_current_version(spark, house):
    rows = [
        record(CUSTOMERS, 1, customer(1, email="error@x.org", phone="9")),
        record(CUSTOMERS, 2, customer(1)),
    ]
    pipeline.ingest(house, frame(spark, rows), "batch", 0, NOW)
    pipeline.retry(house, NOW + dt.timedelta(minutes=6), revalidate=False)
    versions = house.dimension("dim_customer").orderBy("version").collect()
    assert [(v["phone"], v["valid_from"], v["is_current"]) for v in versions] == [
        ("1", DAY + dt.timedelta(minutes=2), False),
        ("9", DAY + dt.timedelta(minutes=2), True),
    ]


def test_bootstrap_then_changes(spark, house, tmp_path):
    rows = spark.createDataFrame(
        [(1, "A", "B", "c1@x.org", "1", None, "X", "Y")],
        "customer_id bigint, first_name string, last_name string, email string, phone string, "
        "address string, city string, country string",
    )
    snapshot = sources.snapshot_records(rows, CUSTOMERS, "customer_id", DAY)
    # In two parts; the second one has the lower keys, and so the lower offsets.
    more = rows.withColumn("customer_id", F.lit(7).cast("bigint"))
    pipeline.ingest(
        house, sources.snapshot_records(more, CUSTOMERS, "customer_id", DAY), "snapshot", 0, NOW
    )
    pipeline.ingest(house, snapshot, "snapshot", 1, NOW)
    folder = str(tmp_path / "in")
    frame(spark, SECOND).coalesce(1).write.parquet(folder)
    stream = sources.file_stream(spark, folder)
    pipeline.start(stream, house, str(tmp_path / "checkpoint")).awaitTermination()
    again = Warehouse(spark, house.root)
    assert keys(again.dimension("dim_customer"), "customer_id", "version", "is_current") == [
        (1, 1, False),
        (1, 2, True),
        (2, 1, False),
        (7, 1, True),
    ]
    # A stream that begins anew brings all records again, and none is applied twice.
    pipeline.start(stream, again, str(tmp_path / "other")).awaitTermination()
    last = Warehouse(spark, house.root)
    assert sum(last.record["counts"]["received"].values()) == len(SECOND)
    assert sum(last.record["counts"]["applied"].values()) == 0
    assert last.dimension("dim_customer").count() == 4


def test_late_offsets_are_applied(spark, house):
    first = [record(CUSTOMERS, 10, customer(1, phone="new")), record(CUSTOMERS, 12, customer(3))]
    late = [record(CUSTOMERS, 9, customer(2)), record(CUSTOMERS, 10, customer(1)), record(CUSTOMERS, 11, raw="{")]
    pipeline.ingest(house, frame(spark, first), "batch", 0, NOW)
    pipeline.ingest(house, frame(spark, late), "batch", 1, NOW)
    assert house.record["counts"] == {"received": {CUSTOMERS: 3}, "applied": {CUSTOMERS: 2}}
    assert keys(house.dimension("dim_customer"), "customer_id", "phone") == [(1, "new"), (2, "1"), (3, "1")]
    assert keys(house.state("failed_messages"), "message_offset") == [(11,)]


def test_two_writers_in_turn(spark, house):
    other = Warehouse(spark, house.root, buckets=4)
    pipeline.ingest(house, frame(spark, [record(CUSTOMERS, 1, customer(1))]), "a", 0, NOW)
    pipeline.ingest(other, frame(spark, [record(CUSTOMERS, 2, customer(2))]), "b", 0, NOW)
    pipeline.ingest(house, frame(spark, [record(CUSTOMERS, 3, customer(3))]), "a", 1, NOW)
    assert keys(Warehouse(spark, house.root).dimension("dim_customer"), "customer_id") == [(1,), (2,), (3,)]


def test_a_writer_that_was_overtaken_fails(spark, house):
    other = Warehouse(spark, house.root, buckets=4)
    mine, theirs = house.begin(), other.begin()
    theirs.commit()
    with pytest.raises(Exception, match="(?i)already exists"):
        mine.commit()


def test_a_key_comes_back_no_earlier_than_it_went(spark, house):
    first = [record(CUSTOMERS, 5, customer(1)), record(CUSTOMERS, 8, None, customer(1))]
    back = [record(CUSTOMERS, 6, customer(1, phone="9"))]
    pipeline.ingest(house, frame(spark, first), "batch", 0, NOW)
    pipeline.ingest(house, frame(spark, back), "batch", 1, NOW)
    pipeline.ingest(house, frame(spark, [record(CUSTOMERS, 9, None, customer(1))]), "batch", 2, NOW)
    went = DAY + dt.timedelta(minutes=8)
    assert keys(house.dimension("dim_customer"), "version", "valid_from", "valid_to", "is_current") == [
        (1, went - dt.timedelta(minutes=3), went, False),
        (1, went, went + dt.timedelta(minutes=1), False),
    ]


def test_batches_give_what_one_shot_gives(spark, tmp_path):
    """Whole tables, cut in three by offset; and no record is lost on the way."""
    t = Tables(spark, "/root/testdata/sf0.001")
    everything = t.records()
    house = Warehouse(spark, str(tmp_path / "house"), buckets=4)
    day = F.to_date("timestamp")
    cuts = [dt.date(1900, 1, 1), dt.date(1997, 3, 1), dt.date(1999, 6, 1), dt.date(2100, 1, 1)]
    parts = [
        everything.filter((day >= a) & (day < b)).filter(F.col("topic") != ORDER_ITEMS)
        for a, b in zip(cuts, cuts[1:])
    ]
    parts[-1] = parts[-1].unionByName(t.item_records())
    for n, part in enumerate(parts):
        pipeline.ingest(house, part, "batch", n, NOW, dates=t.dates())

    once = envelope.normalize(facts.one_per_address(everything))
    customers = validate.check_customers(envelope.changes_of(once, CUSTOMERS))
    want = scd.as_stored(scd.customer_dimension(validate.valid(customers)))
    columns = ["customer_key", "customer_id", "version", "valid_from", "is_current", "phone", "last_name"]
    assert keys(house.dimension("dim_customer"), *columns) == keys(want, *columns)
    products = validate.check_products(envelope.changes_of(once, PRODUCTS))
    want = scd.as_stored(scd.product_dimension(validate.valid(products)))
    columns = ["product_key", "product_id", "version", "valid_from", "is_current", "price", "category"]
    assert keys(house.dimension("dim_product"), *columns) == keys(want, *columns)

    items = once.filter(F.col("topic") == ORDER_ITEMS)
    inserted = items.filter("outcome = 'change'").count()
    loaded = house.appended("fact_orders").count()
    failed = house.state("failed_messages").filter(F.col("topic") == ORDER_ITEMS).count()
    assert inserted == loaded + failed
    assert loaded > 0 and failed > 0
    received, applied = (
        sum(house.record["counts"][c].values()) for c in ("received", "applied")
    )
    assert received == parts[-1].count()
    assert applied == parts[-1].select("topic", "partition", "offset").distinct().count()


def test_numbers_in_any_order_lose_nothing(spark, house):
    """Numbers 5, 3, 3, 5 of one source and equal numbers of another: each is applied once."""
    batches = [("a", 5, 1), ("a", 3, 2), ("a", 3, 3), ("a", 5, 4), ("b", 5, 5), ("b", 3, 6), ("a", 4, 7)]
    for source, number, customer_id in batches:
        rows = frame(spark, [record(CUSTOMERS, customer_id, customer(customer_id))])
        pipeline.ingest(house, rows, source, number, NOW)
    assert keys(house.dimension("dim_customer"), "customer_id") == [(1,), (2,), (5,), (6,), (7,)]
    assert house.record["sources"] == {"a": [[3, 5]], "b": [[3, 3], [5, 5]]}
    got = keys(house.appended("applied"), "first", "last")
    assert got == [(1, 2), (5, 7)]
    with pytest.raises(TypeError):
        pipeline.ingest(house, frame(spark, []), 1)


def test_tables_come_one_after_the_other(spark, house):
    """A table's first rows may come long after the warehouse began."""
    pipeline.ingest(house, frame(spark, FIRST[:2]), "a", 0, NOW)
    pipeline.ingest(house, frame(spark, FIRST[4:7]), "a", 1, NOW)
    pipeline.ingest(house, frame(spark, FIRST[8:9]), "a", 2, NOW)
    assert keys(house.dimension("dim_product"), "product_id") == [(1,)]
    assert keys(house.facts(DAY.date()), "order_item_id") == [(1,)]


def test_state_after_compaction(spark, house):
    pipeline.ingest(house, frame(spark, FIRST), "batch", 0, NOW)
    house.compact()
    check_first(house)
    pipeline.ingest(house, frame(spark, SECOND), "batch", 1, NOW)
    counts = house.record["counts"]
    house.compact()
    house.record["counts"] = counts
    check_second(house)
    # Folders of before the compaction are not read.
    files = house.state("dim_customer")._jdf.queryExecution().executedPlan().toString()
    assert "batch#" in files and "PartitionFilters" in files
    assert house.record["begins"]["dim_customer"] == house.record["batch"]
