"""Operators on record streams that keep state of their own, and let it expire."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from scdflow.schemas import ADDRESS, CUSTOMER_TRACKED, CUSTOMER_TYPE1

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ON_DISK = {
    PROVIDER: ROCKSDB,
    # A batch writes what it changed, not all state anew; all stores of an executor share memory.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}
#: How long a deleted key's last time is kept: a change may be dated back by less.
RETENTION_DAYS = 500

_ATTRIBUTES = [*CUSTOMER_TRACKED, *CUSTOMER_TYPE1]
_N_TRACKED = len(CUSTOMER_TRACKED)
_TEXTS = ", ".join(f"{c} string" for c in _ATTRIBUTES)
_STATE = f"live boolean, version int, clock bigint, expires bigint, {_TEXTS}"
UPDATE = f"customer_id bigint, live boolean, version int, valid_from timestamp, read_to bigint, {_TEXTS}"
_LEFT = UPDATE.replace("valid_from timestamp", "valid_from bigint")
_AS_LEFT = Row("customer_id", "live", "version", "valid_from", "read_to", *_ATTRIBUTES)
#: Times as microseconds: instants, whatever the time zone of a Python worker.
_MICROS_A_DAY = 86_400_000_000


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start in here keep their state in RocksDB, on executors' disks, not in their heap."""
    before = {name: spark.conf.get(name, None) for name in _ON_DISK}
    for name, value in _ON_DISK.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class CurrentCustomer(StatefulProcessor):
    """The current version of one customer, carried from batch to batch.

    Ops do what the table of `operators.scd` says. After a delete the key keeps the time at
    which it went, so that it comes back no earlier, until a timer finds it long gone.

    Most keys have few changes in a micro-batch, so rows come as they are: a data frame for
    each key would cost far more than its changes.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("current", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # What a micro-batch has of one key; its size is that of the micro-batch at most.
        changes = sorted(rows, key=_in_order)
        live, version, clock, expires, held = False, 0, None, 0, None
        known = self.state.get()
        if known is not None:
            live, version, clock, expires, *held = known
        for change in changes:
            op = change["op"] if change["op"] in ("c", "u", "d") else "r"
            if (op == "r" and live) or (op == "d" and not live):
                continue
            new = [change[c] for c in _ATTRIBUTES]
            if op == "d":
                live, clock = False, _later(clock, change["at"])
                continue
            if not live or new[:_N_TRACKED] != held[:_N_TRACKED]:
                version = version + 1 if live else 1
                clock = _later(clock, change["at"])
            live, held = True, new
        if clock is None:
            return
        expires = self._timer(live, clock, expires)
        self.state.update((live, version, clock, expires, *held))
        yield _AS_LEFT(key[0], live, version, clock, changes[-1]["offset"], *held)

    def _timer(self, live: bool, clock: int, expires: int) -> int:
        wanted = 0 if live else (clock + RETENTION_DAYS * _MICROS_A_DAY) // 1000
        if wanted != expires:
            if expires:
                self.handle.deleteTimer(expires)
            if wanted:
                self.handle.registerTimer(wanted)
        return wanted

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def _in_order(change: Row) -> tuple:
    """By address, an unknown part of it last."""
    partition, offset = change["partition"], change["offset"]
    return (partition is None, partition or 0, offset is None, offset or 0)


def _later(clock: int | None, at: int | None) -> int | None:
    return max((x for x in (clock, at) if x is not None), default=None)


def current_customers(changes: DataFrame, late: str = "1 day") -> DataFrame:
    """A stream of changes as a stream of rows: each customer as a micro-batch leaves it.

    Changes of a key must come in the order of their offsets, batch by batch; `arrived`, when the
    record came, moves the watermark. Needs the RocksDB provider (`PROVIDER`).
    """
    timed = changes.withWatermark("arrived", late).withColumn("at", F.unix_micros("ts")).drop("ts")
    left = timed.groupBy("customer_id").transformWithState(
        statefulProcessor=CurrentCustomer(),
        outputStructType=_LEFT,
        outputMode="Append",
        timeMode="EventTime",
    )
    return left.withColumn("valid_from", F.timestamp_micros("valid_from"))


def latest(updates: DataFrame) -> DataFrame:
    """What all updates leave: customers that are live. A key's changes are in one partition."""
    rest = [c for c in updates.columns if c not in ("customer_id", "read_to")]
    last = updates.groupBy("customer_id").agg(F.max_by(F.struct(*rest), "read_to").alias("last"))
    return last.select("customer_id", "last.*").filter("live").drop("live")


def once(records: DataFrame, within: str) -> DataFrame:
    """Records without those whose address came before, up to `within` ago by their times.

    The state has the addresses of that time and no more; a record that is later than this is
    dropped, so it must be as long as a redelivery may take.
    """
    # A watermark is an instant; the record's time has no zone.
    timed = records.withColumn("came_at", F.col("timestamp").cast("timestamp"))
    return timed.withWatermark("came_at", within).dropDuplicatesWithinWatermark(ADDRESS).drop("came_at")


def with_order(items: DataFrame, orders: DataFrame, wait_days: int) -> DataFrame:
    """Items with the order they belong to, whichever comes first.

    An item is at most `wait_days` younger than its order (`item_at`, `ordered_at`) and waits for
    it until the watermark has passed that bound; then it comes out without one, a reject. Orders
    are kept as long as items of theirs may come.
    """
    placed = orders.withWatermark("ordered_at", "0 seconds").withColumnRenamed("order_id", "of_order")
    bound = F.expr(
        f"order_id = of_order and item_at >= ordered_at and item_at <= ordered_at + interval {int(wait_days)} days"
    )
    return items.withWatermark("item_at", "0 seconds").join(placed, bound, "left")
