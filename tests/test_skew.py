"""Slices of hot keys."""

import pytest
from pyspark.sql import functions as F

from scdflow.operators import skew

pytestmark = pytest.mark.usefixtures("interpreted")


@pytest.mark.parametrize("slice_rows", [1, 7, 100])
def test_small_slices_share_ranges(spark, slice_rows):
    rows = spark.range(600).select((F.col("id") % 5).alias("key"), ((F.col("id") * 7919) % 600).alias("seq"))
    seen = []

    def build(part, sliced):
        if sliced:
            seen.append(part)
        return part.withColumn("slice", F.col("slice") if sliced else F.lit(None).cast("bigint"))

    got = skew.by_key(rows, "key", "seq", build, hot_rows=10, slice_rows=slice_rows).collect()
    in_order = sorted(got, key=lambda r: (r["key"], r["seq"]))
    assert [r["slice"] for r in in_order] == sorted(r["slice"] for r in got)
    per_slice = {}
    for r in got:
        per_slice[r["slice"]] = per_slice.get(r["slice"], 0) + 1
    assert len(got) == 600 and max(per_slice.values()) <= slice_rows
    # A task and a file for each slice of a row or so would cost more than the rows.
    assert len(seen[0].inputFiles()) <= max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def test_large_slices_are_a_range_each(spark):
    assert skew._ranges(spark, 100 * skew.SLICE_ROWS, skew.SLICE_ROWS) == 100
    assert skew._ranges(spark, 100 * skew.SLICE_ROWS, 1) == 100
    assert skew._ranges(spark, 10, 9) == 2


@pytest.mark.parametrize(("cold", "calls"), [(3, [True]), (700, [False, True])])
def test_rows_are_computed_twice_only_where_most_are_not_hot(spark, cold, calls):
    hot = spark.range(500).select((F.col("id") % 5).alias("key"), F.col("id").alias("seq"))
    few = spark.range(cold).select((F.col("id") + 5).alias("key"), F.col("id").alias("seq"))
    seen = []

    def build(part, sliced):
        seen.append(sliced)
        return part.select("key", "seq")

    got = skew.by_key(hot.unionByName(few), "key", "seq", build, hot_rows=10, slice_rows=40)
    assert got.count() == 500 + cold and got.distinct().count() == 500 + cold
    assert seen == calls
