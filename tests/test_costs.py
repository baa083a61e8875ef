"""What queries shuffle, hold and write, as their plans and folders tell."""

import contextlib
import datetime
import glob
import io
import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from scdflow.operators import envelope, facts, scd
from scdflow.plans import catalog, metrics
from scdflow.sources import records as sources
from scdflow.sources.testdata import Tables
from scdflow.sources.warehouse import Warehouse

RECORDS = "topic string, partition int, offset bigint, timestamp timestamp_ntz, key string, value string"
ORDERS = (
    "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
    "o_orderpriority string"
)


def plan(rows):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        rows.explain()
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def records(spark, rows):
    at = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(t, p, o, at, "k", v) for t, p, o, v in rows], RECORDS)


def test_an_image_is_taken_out_only_where_it_is_wanted(spark):
    rows = records(spark, [("ecommerce.public.orders", 0, 1, '{"after":{"order_id":1}}')])
    counted = plan(envelope.op_counts(envelope.normalize(rows)))
    # One look at ids each for wrapped and bare envelopes; images are not built for a count.
    assert "struct<payload:variant" not in counted and "row_image" not in counted


def test_the_price_of_a_product_record_is_worked_out_once(spark, tmp_path):
    part = spark.createDataFrame([(1, "n", "t", "b", 10.0)], "p_partkey long, p_name string, p_type string, p_brand string, p_retailprice double")
    line = spark.createDataFrame(
        [(1, 1, 2, 3, 4.0, 5.0, "N", "O", datetime.datetime(2000, 1, 1))],
        "l_orderkey long, l_partkey long, l_linenumber int, l_suppkey long, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    )
    part.write.parquet(f"{tmp_path}/part.parquet")
    line.write.parquet(f"{tmp_path}/lineitem.parquet")
    made = Tables(spark, str(tmp_path)).product_records()
    assert plan(made).count("p_retailprice#") and plan(made).count(" * 0.1)") == 1
    row = made.first()
    image = '{"product_id":1,"product_name":"n","category":"t","brand":"b","price":10.00,"cost":6.00}'
    assert row["value"] == '{"before":' + image + ',"after":' + image + "}"


def test_the_image_of_a_customer_record_is_worked_out_once(spark, tmp_path):
    orders = spark.createDataFrame([(3, 7, "O", 1.0, datetime.datetime(2000, 1, 1), "2-HIGH")], ORDERS)
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    made = Tables(spark, str(tmp_path)).customer_records()
    assert plan(made).count('"customer_id":') == 1
    image = (
        '{"customer_id":7,"first_name":"Customer","last_name":"O","email":"c7@example.com","phone":"2-HIGH",'
        '"address":"Street 2-HIGH","city":"City 7","country":"Country 7"}'
    )
    assert made.first()["value"] == '{"payload":{"op":"u","before":' + image + ',"after":' + image + "}}"


def test_a_few_files_of_a_stream_are_work_for_many_tasks(spark, tmp_path, monkeypatch):
    """A task reads whole row groups, so a batch of four files must not be four row groups."""
    monkeypatch.setattr(sources, "GROUP_BYTES", 1 << 18, raising=False)
    lines = spark.range(0, 40_000, 1, 1).selectExpr(
        "id as l_orderkey", "id as l_partkey", "2 as l_linenumber", "id as l_suppkey", "3d as l_quantity",
        "id / 100 + 1 as l_extendedprice", "'N' as l_returnflag", "'O' as l_linestatus",
        "timestamp '2000-01-01' as l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    part = "p_partkey long, p_name string, p_type string, p_brand string, p_retailprice double"
    spark.createDataFrame([(1, "n", "t", "b", 10.0)], part).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([], ORDERS).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(catalog, "new_folder", lambda *_: f"{tmp_path}/stream")
    counted = catalog.cdc_stream(Tables(spark, str(tmp_path)))
    assert sum(r["records"] for r in counted.collect()) == 80_000
    files = glob.glob(f"{tmp_path}/stream/in/*.parquet")
    large = [f for f in files if os.path.getsize(f) > 1 << 19]
    assert large and all(pq.ParquetFile(f).num_row_groups > 1 for f in large)


def test_a_lookup_shuffles_only_what_is_asked_for(spark, no_broadcast):
    at, end = datetime.datetime(2024, 1, 1), datetime.datetime(9999, 1, 1)
    rows = spark.createDataFrame([(1, at, 5, "unwanted")], "id long, at timestamp_ntz, n int, note string")
    versions = spark.createDataFrame(
        [(1, 7, at, at, 1), (1, 8, at, end, 2)],
        "id long, v int, valid_from timestamp_ntz, valid_to timestamp_ntz, open_seq int",
    )
    found = scd.as_of(rows, versions, "id", "at", ["v"]).select("n", "v")
    found.collect()
    windowed = [x for x in plan(found).split("\n") if "Project [id#" in x or "Union" in x]
    assert windowed and not any("note" in x for x in windowed)
    assert [tuple(r) for r in found.collect()] == [(5, 8)]


def test_sales_by_category_add_up_once_before_the_category(spark, no_broadcast):
    sold = spark.createDataFrame(
        [(1, 1, 10, 2, 5.0, 2.5), (1, 1, 10, 1, 2.5, 2.5), (2, 2, 10, 1, 4.0, 4.0)],
        "product_key long, product_id long, order_id long, quantity int, line_total double, unit_price double",
    )
    products = spark.createDataFrame(
        [(1, 1, "a", True), (2, 2, "a", True)], "product_key long, product_id long, category string, is_current boolean"
    )
    found = metrics.sales_by_category(sold, products)
    assert [tuple(r) for r in found.collect()] == [("a", 1, 4, 11.5, 3.0)]
    assert len(re.findall("keys=.product_key", plan(found))) == 0


def test_records_are_shuffled_once_to_keep_one_per_address(spark, no_broadcast):
    rows = records(spark, [("t", 0, 1, "b"), ("t", 0, 1, "a"), ("t", 0, 2, "c"), ("t", 0, None, "d"), ("t", 0, None, "d")])
    known = spark.createDataFrame([("t", 0, 2)], "topic string, partition int, offset bigint")
    once = facts.one_per_address(rows, known)
    got = sorted((r["offset"] or 0, r["value"]) for r in once.collect())
    assert got == [(0, "d"), (0, "d"), (1, "a")]
    shuffles = [x for x in plan(facts.one_per_address(rows)).split("\n") if "Exchange hashpartitioning" in x]
    assert len(shuffles) == 1


def test_an_envelope_is_looked_into_once(spark):
    """A path that leads nowhere, `$.payload` of a bare envelope, costs more than the look itself."""
    rows = records(spark, [("ecommerce.public.orders", 0, 1, '{"after":{"order_id":1}}')])
    looked = plan(envelope.normalize(rows))
    assert not re.search(r"\$\.payload\W", looked.replace("$.payload.", ""))


def test_what_a_batch_keeps_has_whole_variants(spark, tmp_path):
    rows = records(spark, [("t", 0, i, '{"after":{"order_id":%d}}' % i) for i in range(50)]).coalesce(1)
    kept = Warehouse(spark, str(tmp_path)).begin().keep("normalized", envelope.normalize(rows))
    assert kept.filter("image IS NOT NULL").count() == 50
    (file,) = [f for f in glob.glob(f"{tmp_path}/staging/*/normalized/*.parquet") if pq.read_metadata(f).num_rows > 40] or [None]
    assert file and not any("typed_value" in c for c in pq.ParquetFile(file).schema.to_arrow_schema().field("image").type.__str__().split())
