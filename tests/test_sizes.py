"""What large tables need: parents' sizes known, places dealt out, streams without a frame a key."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from scdflow.operators import ranges, validate
from scdflow.streaming import stateful

pytestmark = pytest.mark.usefixtures("interpreted")


def test_parents_of_orphans_are_read_back(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 9)], "id bigint, k bigint")
    images = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k bigint, s string")
    parents = images.groupBy("k").agg(F.max("s").alias("s")).unionByName(images)
    found = validate.orphans(rows, parents, "k")
    assert [r["id"] for r in found.collect()] == [4]
    # Spark sees the size of a table instead of guessing that of a plan.
    assert any("/parents-" in f for f in found.inputFiles())


def test_a_place_with_many_ranges_is_dealt_out(spark):
    n = 2 * ranges.PLACE_ROWS + 2
    rows = spark.range(n).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), (F.col("id") * 2).alias("first"), (F.col("id") * 2).alias("last")
    )
    found = ranges.merged(rows)
    assert any("/slices-" in f for f in found.inputFiles())
    assert found.agg(F.count("*"), F.min("first"), F.max("last"), F.count_if(F.col("first") == F.col("last"))).first() == (n, 0, 2 * n - 2, n)


class Handle:
    """A state of one key, in place of Spark's."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_a_customer_takes_plain_rows():
    """No data frame is built for each key; it cost more than the changes of the key."""
    columns = ["partition", "offset", "op", "at", *stateful._ATTRIBUTES]

    def change(offset, op, at, phone):
        return Row(*columns)(0, offset, op, at, phone, *[None] * (len(stateful._ATTRIBUTES) - 1))

    one = stateful.CurrentCustomer()
    one.init(handle := Handle())
    rows = [change(3, "u", 50, "b"), change(1, "c", 100, "a"), change(2, "r", 200, "z")]
    (left,) = one.handleInputRows((7,), iter(rows), None)
    assert (left["customer_id"], left["live"], left["version"], left["valid_from"], left["read_to"]) == (7, True, 2, 100, 3)
    assert left["phone"] == "b" and not handle.timers
    (left,) = one.handleInputRows((7,), iter([change(4, "d", 900_000, None)]), None)
    assert not left["live"] and handle.timers == {900 + stateful.RETENTION_DAYS * 86_400_000}
    (left,) = one.handleInputRows((7,), iter([change(5, "r", None, None)]), None)
    assert (left["version"], left["valid_from"], left["phone"]) == (1, 900_000, None) and not handle.timers
