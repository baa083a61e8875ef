"""Interleaved snapshots, the tree of time, mergeable days, hash trees, due slots, deep pages, state streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from scdflow.operators import bootstrap, dlq, scd, timetree
from scdflow.plans import metrics, monitoring, sync
from scdflow.schemas import CUSTOMERS, DIM_CUSTOMER, FAILED_MESSAGE
from scdflow.sources.warehouse import Warehouse
from scdflow.streaming import stateful

pytestmark = pytest.mark.usefixtures("interpreted")

DAY = dt.datetime(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


CHANGE = (
    "customer_id bigint, partition int, offset bigint, ts timestamp_ntz, op string, first_name string, "
    "last_name string, email string, phone string, address string, city string, country string"
)


@pytest.mark.parametrize("seed", range(3))
def test_interleaved_chunks_equal_the_fold_of_all_changes(spark, seed):
    rng = random.Random(seed)
    log, images = [], {}
    history = {}
    for offset in range(1, 300):
        key = rng.randrange(20)
        op = rng.choice("uuud") if key in images else "c"
        image = tuple(f"{c}{rng.randrange(3)}" for c in "flepacy")
        log.append((key, 0, offset, day(offset), op, *image))
        images.pop(key, None)
        if op != "d":
            images[key] = image
        history.setdefault(key, []).append((offset, images.get(key)))
    begin, reads = 60, []
    for chunk in range(4):
        low = begin + rng.randrange(150)
        high = low + rng.randrange(60)
        for key in range(chunk, 20, 4):
            read_at = rng.randint(low, high)
            seen = [image for offset, image in history.get(key, []) if offset <= read_at]
            if seen and seen[-1]:
                reads.append((key, low, high, day(read_at), *seen[-1]))
    columns = "first_name string, last_name string, email string, phone string, address string, city string, country string"
    chunk_rows = spark.createDataFrame(reads, f"customer_id bigint, low bigint, high bigint, ts timestamp_ntz, {columns}")
    captured = spark.createDataFrame([r for r in log if r[2] > begin], CHANGE)
    names = ["customer_id", *(c.split()[0] for c in columns.split(", "))]
    log_of_both = bootstrap.interleaved(chunk_rows, captured, "customer_id")
    got = scd.customer_dimension(log_of_both).filter("is_current").select(*names).collect()
    assert sorted(map(tuple, got)) == sorted((k, *image) for k, image in images.items())


def interval(i, a, b):
    return (i, i, "A", "B", "e", "1", None, "X", "Y", day(a), day(b), False, 1, 0, i)


def test_canonical_nodes_cover_each_leaf_once(spark):
    spans = [(a, b) for a in range(0, 40, 3) for b in range(a + 1, 50, 4)] + [(0, 2048), (1, 2047), (2047, 2048)]
    rows = spark.createDataFrame(spans, "a int, b int").select("a", "b", timetree.nodes(F.col("a"), F.col("b")).alias("nodes"))
    for r in rows.collect():
        leaves = []
        for level, node in r["nodes"]:
            leaves += range(node << level, (node + 1) << level)
        assert sorted(leaves) == list(range(r["a"], r["b"]))
        assert len(r["nodes"]) <= 2 * timetree.LEVELS


def test_an_instant_reads_a_folder_a_level(spark, tmp_path):
    rng = random.Random(2)
    rows = [interval(i, a, a + rng.randrange(900)) for i, a in enumerate(rng.randrange(3000) for _ in range(200))]
    rows += [interval(900, 5, 5), interval(901, -90_000, 90_000)]
    versions = spark.createDataFrame(rows, DIM_CUSTOMER)
    timetree.file(versions, str(tmp_path / "tree"))
    for n in (0, 31, 32, 700, 2999, 5000):
        got = timetree.at(versions, str(tmp_path / "tree"), day(n))
        want = sorted(r[0] for r in rows if r[9] <= day(n) < r[10])
        assert sorted(r["customer_key"] for r in got.collect()) == want
        plan = plan_of(got)
        assert "PartitionFilters: [" in plan and "level#" in plan.split("PartitionFilters")[1]
        every = spark.read.parquet(str(tmp_path / "tree")).select("level", "node").distinct().count()
        path = {(level, (n + 18262) // timetree.LEAF_DAYS >> level) for level in range(timetree.LEVELS)}
        assert len(path) == timetree.LEVELS < every


def test_days_merge_like_facts(spark):
    rng = random.Random(3)
    rows = [(20200100 + rng.randrange(1, 5), rng.choice([1, 2, 40_000, 70_001, 1 << 40]), 1, 2.5) for _ in range(400)]
    facts = spark.createDataFrame(rows, "date_key int, order_id bigint, quantity int, line_total double")
    dates = metrics.dim_date(spark, dt.date(2020, 1, 1), dt.date(2020, 2, 1))
    parts = [metrics.day_partials(facts.filter(F.pmod(F.xxhash64("line_total", "order_id"), F.lit(3)) == i)) for i in range(3)]
    parts.append(metrics.day_partials(facts.limit(0)))
    held = parts[0]
    for p in parts[1:]:
        held = metrics.merged_partials(held.unionByName(p))
    as_of = dt.date(2020, 1, 20)
    got = metrics.daily_revenue_of(held, dates, as_of).collect()
    assert got == metrics.daily_revenue(facts, dates, as_of).collect()
    assert len(got) == 4


@pytest.mark.parametrize("planted", [0, 1, 25])
def test_differences(spark, planted):
    rng = random.Random(planted)
    rows = {i: (i, rng.choice("ab"), rng.randrange(9)) for i in range(500)}
    copy, want = dict(rows), {}
    for i in rng.sample(range(500), planted):
        kind = rng.choice(["missing", "extra", "changed"])
        if kind == "missing":
            del copy[i]
        elif kind == "extra":
            copy[1000 + i], i = (1000 + i, "x", 0), 1000 + i
        else:
            copy[i] = (i, "z", None)
        want[i] = kind
    frames = [spark.createDataFrame(list(x.values()), "id bigint, s string, n int") for x in (rows, copy)]
    got = sync.differences(*frames, "id", ["s", "n"])
    assert {r["id"]: r["difference"] for r in got.collect()} == want
    leaves = sync.differing_leaves(*(sync.digests(f, "id", ["s", "n"]) for f in frames))
    assert len(leaves) <= planted and (len(leaves) > 0) == (planted > 0)


def failed_rows(rng, n, minutes):
    rows = []
    for i in range(n):
        at = None if i % 50 == 49 else day(0) + dt.timedelta(minutes=rng.randrange(minutes))
        status = rng.choice(["pending", "resolved"])
        row = (i * 7, CUSTOMERS, i % 3, i, at, None, "{}", "ValueError", "bad", None, i % 4, 3, None)
        rows.append((*row, None if i % 11 == 0 else day(0) + dt.timedelta(minutes=rng.randrange(5000)), status, None, at, None))
    return rows


@pytest.mark.parametrize("minutes", [1, 40, 10**6])
def test_deep_pages(spark, minutes):
    failed = spark.createDataFrame(failed_rows(random.Random(minutes), 300, minutes), FAILED_MESSAGE)
    for page, size in ((1, 10), (7, 13), (30, 10), (31, 10), (2, 299)):
        want = monitoring.page_rows(failed, page, size).collect()
        assert monitoring.page_deep(failed, page, size, bins=4, sorted_rows=30).collect() == want
    assert monitoring.page_deep(failed, 3, 9, "pending", 5, 20).collect() == monitoring.page_rows(failed, 3, 9, "pending").collect()
    assert monitoring.page_deep(failed.limit(0), 1, 5).count() == 0


def test_due_messages_come_from_their_hours(spark, tmp_path):
    rows = failed_rows(random.Random(8), 200, 5000)
    house = Warehouse(spark, str(tmp_path / "house"), buckets=4)
    batch = house.begin()
    batch.upsert("failed_messages", spark.createDataFrame(rows, FAILED_MESSAGE))
    batch.commit()
    # Half of them were tried again: some are resolved, some wait for another time.
    later = [(*r[:10], r[10], 3, None, day(9), "pending" if r[0] % 4 else "resolved", *r[15:]) for r in rows[::2]]
    batch = house.begin()
    batch.upsert("failed_messages", spark.createDataFrame(later, FAILED_MESSAGE))
    batch.commit()
    for compacted in (False, True):
        if compacted:
            house.compact()
        for now in (day(0), day(1) + dt.timedelta(minutes=61), day(20)):
            want = dlq.ready_for_retry(house.state("failed_messages"), now).collect()
            assert dlq.ready_for_retry(house.due(now), now).collect() == want
    entries = house._rows("due", house.record["begins"], house.record["batch"], keep=True)
    assert "PartitionFilters: [" in plan_of(entries.filter("slot <= 5"))


def stream_of(spark, like, folder):
    return spark.readStream.schema(like).parquet(folder)


def run(stream, folder):
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/check")
    query = writer.trigger(availableNow=True).start(f"{folder}/out")
    query.awaitTermination()
    return query


def test_current_rows_as_a_state_stream(spark, tmp_path):
    """Two runs of one stream equal the fold, and the state of keys long gone expires."""
    rng = random.Random(6)
    columns = "first_name string, last_name string, email string, phone string, address string, city string, country string"
    rows = []
    for offset in range(400):
        image = [f"{c}{rng.randrange(2)}" if rng.random() < 0.9 else None for c in "flepacy"]
        ts = day(offset) - dt.timedelta(days=rng.choice([0, 0, 300]))
        rows.append((rng.randrange(12), 0, offset, ts, rng.choice(["c", "u", "u", "d", "r", None]), *image, day(offset)))
    # A customer that went long ago, and comes back when no state of it is left.
    rows[3] = (77, 0, 3, day(3), "c", *["z"] * 7, day(3))
    rows[4] = (77, 0, 4, day(4), "c", *["y"] * 7, day(4))
    rows[5] = (77, 0, 5, day(5), "d", *["y"] * 7, day(5))
    end = [(77, 0, 999, day(2000), "c", *["x"] * 7, day(2000)), (99, 0, 1000, day(2000), "c", *["z"] * 7, day(2000)), (98, 0, 1001, day(2001), "d", *["z"] * 7, day(2001))]
    schema = f"customer_id bigint, partition int, offset bigint, ts timestamp, op string, {columns}, arrived timestamp"
    folder = str(tmp_path)
    before = spark.conf.get(stateful.PROVIDER)
    spark.conf.set(stateful.PROVIDER, stateful.ROCKSDB)
    try:
        far = [(96, 0, 998, day(1000), "c", *["z"] * 7, day(1000))]
        for part in (rows[:150], rows[150:] + far, end):
            spark.createDataFrame(part, schema).write.mode("append").parquet(f"{folder}/in")
            query = run(stateful.current_customers(stream_of(spark, schema, f"{folder}/in")), folder)
    finally:
        spark.conf.set(stateful.PROVIDER, before)
    got = stateful.latest(spark.read.schema(stateful.UPDATE).parquet(f"{folder}/out"))
    names = ["customer_id", "version", "valid_from", "phone", "last_name", "city"]
    changes = spark.createDataFrame([r[:-1] for r in rows + far + end], CHANGE)
    want = scd.customer_dimension(changes).filter("is_current").select(*names)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    # Customers that are gone have no state any more.
    left = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert left[-1] == want.count() < len({r[0] for r in rows + far + end})


def test_redelivery_within_the_watermark(spark, tmp_path):
    schema = "topic string, partition int, offset bigint, timestamp timestamp_ntz, key string, value string"
    folder, rng = str(tmp_path), random.Random(4)
    for wave in range(7):
        new = [("t", 0, wave * 50 + i, day(wave * 10 + i % 10), None, str(wave)) for i in range(50)]
        again = [r[:5] + ("again",) for r in rng.sample(new, 9)]
        if wave:
            again += [("t", 0, (wave - 1) * 50 + i, day(wave * 10 - 10 + i % 10), None, "again") for i in range(0, 50, 7)]
        spark.createDataFrame(new + again, schema).write.mode("append").parquet(f"{folder}/in")
        query = run(stateful.once(stream_of(spark, schema, f"{folder}/in"), "20 days"), folder)
    out = spark.read.parquet(f"{folder}/out")
    assert sorted(r["offset"] for r in out.collect()) == list(range(350))
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 350


def test_items_wait_for_their_order(spark, tmp_path):
    folder = str(tmp_path)
    items = "order_item_id bigint, order_id bigint, item_at timestamp"
    orders = "order_id bigint, customer_id bigint, ordered_at timestamp"
    waves = [
        ([(1, 1, day(3)), (2, 2, day(4)), (3, 3, day(50))], []),
        ([], [(1, 7, day(1)), (3, 7, day(1))]),
        ([(4, 1, day(5)), (-1, -1, day(500))], [(-1, None, day(500))]),
    ]
    for of_items, of_orders in waves:
        spark.createDataFrame(of_items, items).write.mode("append").parquet(f"{folder}/items")
        spark.createDataFrame(of_orders, orders).write.mode("append").parquet(f"{folder}/orders")
        joined = stateful.with_order(
            stream_of(spark, items, f"{folder}/items"), stream_of(spark, orders, f"{folder}/orders"), 10
        )
        run(joined, folder)
    got = spark.read.parquet(f"{folder}/out").filter("order_id > 0").collect()
    # Order 2 never came, and item 3 is too young for its order.
    assert sorted((r["order_item_id"], r["customer_id"]) for r in got if r["of_order"]) == [(1, 7), (4, 7)]
    assert sorted(r["order_item_id"] for r in got if r["of_order"] is None) == [2, 3]
