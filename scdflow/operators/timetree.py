"""Intervals of time in folders that an instant can be read from without the rest.

Time is cut into leaves of some days; nodes above have two of the level below each. A closed
interval is filed under its canonical nodes, the fewest that cover its leaves: two a level at
most. The intervals around an instant are those of the nodes from its leaf to the root, so a
reader opens one folder a level, whatever the history's length. Leaves that an interval
covers in part hold it as well; the exact bounds decide then.
"""

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdflow.functions import naive

#: Days of a leaf, levels, and the first day: 32 days, 2048 leaves, up to the year 2149.
LEAF_DAYS, LEVELS, FIRST = 32, 12, datetime.date(1970, 1, 1)


def _leaf(day: Column) -> Column:
    leaves = F.floor(F.datediff(day, F.lit(FIRST)) / LEAF_DAYS).cast("int")
    return F.least(F.greatest(leaves, F.lit(0)), F.lit((1 << (LEVELS - 1)) - 1))


def nodes(low: Column, high: Column) -> Column:
    """Canonical nodes `(level, node)` of the leaves from `low` up to and not with `high`."""

    def of_level(level: Column) -> Column:
        width = F.pow(F.lit(2), level)
        a, b = F.ceil(low / width).cast("int"), F.floor(high / width).cast("int")
        left = (a < b) & (a % 2 == 1)
        right = (b % 2 == 1) & (a + (a % 2) <= b - 1)
        # The root has no node beside it to be left for.
        last = level == LEVELS - 1
        return F.array(
            F.when(left | (last & (a < b)), F.struct(level.alias("level"), a.alias("node"))),
            F.when(right & ~last, F.struct(level.alias("level"), (b - 1).alias("node"))),
        )

    levels = F.sequence(F.lit(0), F.lit(LEVELS - 1))
    return F.array_compact(F.flatten(F.transform(levels, of_level)))


def file(versions: DataFrame, folder: str) -> None:
    """Write versions by `valid_from` and `valid_to`: a copy for each canonical node."""
    low, high = _leaf(F.to_date("valid_from")), _leaf(F.to_date("valid_to")) + 1
    placed = versions.filter(F.col("valid_from") < F.col("valid_to")).select(
        "*", F.inline(nodes(low, high))
    )
    dealt = placed.hint("rebalance", "level", "node")
    dealt.write.mode("overwrite").partitionBy("level", "node").parquet(folder)


def at(versions: DataFrame, folder: str, when: datetime.datetime) -> DataFrame:
    """Filed versions valid at an instant; `versions` gives their columns."""
    leaf = (when.date() - FIRST).days // LEAF_DAYS
    leaf = min(max(leaf, 0), (1 << (LEVELS - 1)) - 1)
    path = None
    for level in range(LEVELS):
        here = (F.col("level") == level) & (F.col("node") == leaf >> level)
        path = here if path is None else path | here
    schema = ", ".join([*(f"`{n}` {k}" for n, k in versions.dtypes), "level int", "node int"])
    rows = versions.sparkSession.read.schema(schema).parquet(folder)
    instant = naive(when)
    return rows.filter(path).filter(
        (F.col("valid_from") <= instant) & (instant < F.col("valid_to"))
    ).drop("level", "node")
