"""Skewed lookups, the date dimension, and the shape of plans."""

import datetime as dt

from pyspark.sql import functions as F

from scdflow.functions import event_time
from scdflow.operators import facts, skew
from scdflow.plans import catalog, history, metrics, monitoring, sync
from scdflow.sources import records
from scdflow.sources.testdata import Tables

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spark_splits_the_hot_key_of_a_lookup(spark):
    rows = spark.range(300_000).select(
        F.col("id").alias("item"), F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).alias("order_id"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 2).alias("pad"),
    )
    orders = spark.range(300_000).select(F.col("id").alias("order_id"), F.lit(1).alias("found"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        joined = rows.join(orders, "order_id", "left")
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_many_hot_keys_stay_a_table(spark):
    rows = spark.range(6000).select((F.col("id") % 600).alias("k"), F.col("id").alias("o"))

    def build(part, sliced):
        return part.select("k", "o", F.lit(sliced).alias("hot"))

    got = skew.by_key(rows, "k", "o", build, hot_rows=9, slice_rows=100)
    assert got.count() == 6000 and got.filter("NOT hot").count() == 0


def test_daily_revenue_bounds_the_scan_of_orders(spark):
    plan = plan_of(catalog.daily_revenue(Tables(spark, FOLDER)))
    assert "GreaterThanOrEqual(o_orderdate," in plan


def test_statistics_fold_each_dimension_once(spark):
    plan = plan_of(catalog.cdc_stats(Tables(spark, FOLDER)))
    assert "Window" not in plan


def test_backlog_is_added_up_once(spark):
    plan = plan_of(catalog.partition_backlog_or_healthy(Tables(spark, FOLDER)))
    assert plan.count("Scan parquet") == 1


def test_healthy_default(spark):
    none = catalog._failed(Tables(spark, FOLDER)).limit(0)
    rows = monitoring.partition_backlog_or_healthy(none).collect()
    assert [(r["partition"], r["failed_count"], r["lag"]) for r in rows] == [(0, 0, 0)] * 4


def test_default_date_dimension(spark):
    days = metrics.dim_date(spark)
    assert days.count() == 4018
    row = days.filter("date_key = 20240229").collect()[0]
    assert tuple(row) == (20240229, dt.date(2024, 2, 29), "Thursday", 29, 2, "February", 1, 2024, False, False)
    weekend = days.filter("is_weekend and year = 2024").count()
    assert weekend == sum(
        (dt.date(2024, 1, 1) + dt.timedelta(d)).weekday() >= 5 for d in range(366)
    )
    more = metrics.dim_date(spark, dt.date(2030, 12, 30), dt.date(2031, 1, 2))
    assert metrics.extend_dates(days, more).count() == 4020


def test_event_time_encodings(spark):
    texts = ["2024-03-01T00:00:00Z", "2024-03-01 00:00:00", "1709251200", "soon", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(event_time("t", "seconds")).collect()]
    day = dt.datetime(2024, 3, 1)
    assert got == [day, day, day, None, None]
    micros = spark.createDataFrame([("1709251200000000",)], "t string")
    assert micros.select(event_time("t")).collect()[0][0] == day


def test_record_time_in_epoch_millis(spark):
    rows = spark.createDataFrame([(1709251200000,), (None,)], "timestamp bigint")
    got = [r[0] for r in records.with_epoch_time(rows).collect()]
    assert got == [dt.datetime(2024, 3, 1), None]


def test_empty_warehouse(spark):
    t = Tables(spark, FOLDER)
    none = {name: frame.limit(0) for name, frame in {
        "customers": t.read("customer"), "products": t.read("part"), "orders": t.orders()
    }.items()}
    empty = facts.facts(
        facts.resolve(t.items().limit(0), t.orders(), t.snapshot_customers(), t.snapshot_products(), t.dates())
    )
    stats = sync.cdc_stats(
        none, t.snapshot_customers().limit(0), t.snapshot_products().limit(0), empty
    ).collect()[0]
    assert stats["in_sync"] and stats["orders_percent"] == 100.0
    kpis = metrics.sales_kpis(metrics.sales_by_category(empty, t.snapshot_products()))
    assert tuple(kpis.collect()[0]) == (0.0, 0, 0, 0.0)


def test_history_of_one_key(spark):
    t = Tables(spark, FOLDER)
    versions = catalog._customers(t).cache()
    key = versions.groupBy("customer_id").count().orderBy(F.desc("count"), "customer_id").collect()[0]
    rows = history.customer_history(versions, key["customer_id"]).collect()
    assert len(rows) == key["count"]
    assert {r["n_versions"] for r in rows} == {key["count"]}
    assert [r["valid_from"] for r in rows] == sorted(r["valid_from"] for r in rows)


def test_scans_read_only_what_is_asked(spark):
    plan = plan_of(catalog.daily_revenue(Tables(spark, FOLDER)))
    assert "l_tax" not in plan and "l_discount" not in plan and "l_returnflag" not in plan
    assert "LeftOuter" not in plan


def test_filter_reaches_the_scan(spark, tmp_path):
    t = Tables(spark, FOLDER)
    path = str(tmp_path / "fact")
    catalog._snapshot_facts(t).write.parquet(path)
    plan = plan_of(metrics.daily_revenue(spark.read.parquet(path), t.dates(), catalog.REVENUE_DAY))
    assert "GreaterThanOrEqual(date_key,20010702)" in plan


def test_redelivered_records_load_once(spark):
    t = Tables(spark, FOLDER)
    rows = t.item_records()
    twice = rows.unionByName(rows)
    assert facts.one_per_address(twice).count() == rows.select("topic", "partition", "offset").distinct().count()
