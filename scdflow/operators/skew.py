"""Work on ordered keys when a single key may hold much of the data.

A window over one key runs in one task, so a key with a third of all rows would
stop the job. Keys above `hot_rows` are found by a pre-aggregated count and cut into
slices: runs of consecutive rows of about `slice_rows` each. What a slice needs from
the slices before it is summed up in one row per slice, and those rows are few
enough for one task per key. All other keys take the plain path, with one shuffle.

Only windows need this. A join on an equal key is left to Spark, which splits a hot
key's rows by itself.
"""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scdflow.sources.shared import staged

HOT_ROWS = 4_000_000
SLICE_ROWS = 1_000_000


def by_key(
    df: DataFrame,
    key: str,
    order: str,
    build: Callable[[DataFrame, bool], DataFrame],
    hot_rows: int = HOT_ROWS,
    slice_rows: int = SLICE_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """`build(rows, sliced)` over all keys, where hot keys come with a `slice` column.

    However many keys are hot, they stay a table; only their number of rows is known here. Where
    they have most of the rows, all keys come in slices: else `df` would be computed once more for
    the few rows that are left.
    Keys are counted in `counted`, where that has the keys of `df` and costs less to read: `df`
    is then not computed for the count.
    Rows with a null key are not passed on; no ordered operator has a use for them.
    """
    df = df.filter(F.col(key).isNotNull())
    keys_of = df if counted is None else counted.filter(F.col(key).isNotNull())
    counts = keys_of.groupBy(key).agg(F.count("*").alias("n"))
    is_hot = F.col("n") > hot_rows
    rows, of_hot = counts.agg(F.sum("n"), F.sum(F.when(is_hot, F.col("n")))).first()
    if not of_hot:
        return build(df, False)
    if 2 * of_hot > rows:
        return build(_in_slices(df, key, order, rows, slice_rows), True)
    keys = staged(counts.filter(is_hot), "hot_keys").select(key)
    cold = build(df.join(keys, key, "left_anti"), False)
    hot = df.join(keys, key, "left_semi")
    return cold.unionByName(build(_in_slices(hot, key, order, of_hot, slice_rows), True))


def _in_slices(df: DataFrame, key: str, order: str, rows: int, slice_rows: int) -> DataFrame:
    ranges = _ranges(df.sparkSession, rows, slice_rows)
    ordered = df.repartitionByRange(ranges, key, order).sortWithinPartitions(key, order)
    return staged(ordered.withColumn("slice", _slice(slice_rows)), "slices", "zstd")


def _ranges(spark: SparkSession, rows: int, slice_rows: int) -> int:
    """Into how many ranges rows are dealt: one a slice, but of small slices several share one.

    A shuffle costs a task and a sample for each range, so their number must grow with the rows
    by `SLICE_ROWS` at least, however small the slices are.
    """
    slices = max(2, math.ceil(rows / slice_rows))
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(slices, max(2, usual, math.ceil(rows / SLICE_ROWS)))


def _slice(slice_rows: int) -> Column:
    """Numbers that rise along sorted ranges: the range, then runs of `slice_rows` rows in it."""
    at = F.monotonically_increasing_id()
    row = at.bitwiseAND(F.lit((1 << 33) - 1))
    return at - row + F.floor(row / slice_rows)


def previous(
    rows: DataFrame, key: str, order: str, value: Column, name: str, sliced: bool
) -> DataFrame:
    """`lag(value)` per key; `value` must not be null."""
    if not sliced:
        return rows.withColumn(name, F.lag(value).over(Window.partitionBy(key).orderBy(order)))
    local = Window.partitionBy(key, "slice").orderBy(order)
    per_slice = rows.groupBy(key, "slice").agg(F.max_by(value, order).alias("last_value"))
    before = per_slice.select(
        key,
        "slice",
        F.lag("last_value").over(Window.partitionBy(key).orderBy("slice")).alias("value_before"),
    )
    return (
        rows.withColumn(name, F.lag(value).over(local))
        .join(before, [key, "slice"])
        .withColumn(name, F.coalesce(name, "value_before"))
        .drop("value_before")
    )


def last_seen(
    rows: DataFrame, key: str, order: str, value: Column, name: str, sliced: bool
) -> DataFrame:
    """The last non-null `value` of the key up to and including the row."""
    so_far = (Window.unboundedPreceding, Window.currentRow)
    parts = [key, "slice"] if sliced else [key]
    local = Window.partitionBy(*parts).orderBy(order).rowsBetween(*so_far)
    seen = rows.withColumn(name, F.last(value, ignorenulls=True).over(local))
    if not sliced:
        return seen
    before = Window.partitionBy(key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = rows.groupBy(key, "slice").agg(
        F.max_by(value, F.when(value.isNotNull(), F.col(order))).alias("last_value")
    )
    carried = per_slice.select(
        key, "slice", F.last("last_value", ignorenulls=True).over(before).alias("value_before")
    )
    return (
        seen.join(carried, [key, "slice"])
        .withColumn(name, F.coalesce(name, "value_before"))
        .drop("value_before")
    )


def largest_before(
    rows: DataFrame, key: str, order: str, value: Column, name: str, sliced: bool
) -> DataFrame:
    """The largest `value` of the rows ahead of the row."""
    ahead = (Window.unboundedPreceding, -1)
    parts = [key, "slice"] if sliced else [key]
    local = Window.partitionBy(*parts).orderBy(order).rowsBetween(*ahead)
    found = rows.withColumn(name, F.max(value).over(local))
    if not sliced:
        return found
    before = Window.partitionBy(key).orderBy("slice").rowsBetween(*ahead)
    per_slice = rows.groupBy(key, "slice").agg(F.max(value).alias("largest"))
    carried = per_slice.select(key, "slice", F.max("largest").over(before).alias("value_before"))
    return (
        found.join(carried, [key, "slice"])
        .withColumn(name, F.greatest(name, "value_before"))
        .drop("value_before")
    )
