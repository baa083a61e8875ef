"""The warehouse as Parquet folders on storage all executors share: append, and resolve on read.

    <table>/batch=<n>/               rows that a batch appends
    <table>/batch=<n>/bucket=<b>/    state by key: the rows of the keys that a batch changed
    commit/batch=<n>/                JSON, written last: what makes the batch count
    staging/batch=<n>/<name>/        intermediate rows of the batch

A key's state is its row of the latest batch, so a batch writes what it changed and nothing else;
`compact` writes the state once more and lets readers begin there. Until its commit record is
there a batch has no effect, and running it again overwrites the same folders. A batch begins
from the last commit there is, whoever wrote it, and its own commit fails if another came
first; batches of two writers must not overlap in time.
"""

import datetime
import json
import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scdflow.operators.ranges import RANGE
from scdflow.schemas import DIM_CUSTOMER, DIM_PRODUCT, FAILED_MESSAGE
from scdflow.sources.shared import staged

STATE = {
    "dim_customer": ("customer_id", DIM_CUSTOMER),
    "dim_product": ("product_id", DIM_PRODUCT),
    "orders": (
        "order_id",
        "order_id bigint, customer_id bigint, order_date timestamp_ntz, status string, "
        "total_amount double, deleted boolean, partition int, offset bigint",
    ),
    "failed_messages": ("failed_message_id", FAILED_MESSAGE),
}
APPENDED = {
    "dim_customer_closed": DIM_CUSTOMER,
    "dim_product_closed": DIM_PRODUCT,
    "fact_orders": "order_fact_key bigint, order_id bigint, order_item_id bigint, customer_id bigint, "
    "product_id bigint, customer_key bigint, product_key bigint, date_key int, quantity int, "
    "unit_price decimal(10,2), line_total decimal(10,2), order_status string, "
    "created_at timestamp_ntz",
    "applied": RANGE,
    "due": "failed_message_id bigint",
}
#: Folders by which the parts of a table are found.
_FOLDERS = {name: ("bucket", "int") for name in STATE} | {
    "fact_orders": ("month", "int"),
    "due": ("slot", "int"),
}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root
        self.record = self._last_commit() or {
            "batch": 0,
            "sources": {},
            "buckets": buckets,
            "begins": {},
            "counts": {},
        }
        self.buckets = self.record["buckets"]

    def _last_commit(self) -> dict | None:
        schema = "value string, batch bigint"
        try:
            # The folders' names tell which one it is; only that one is opened.
            files = self.spark.read.schema(schema).text(f"{self.root}/commit").inputFiles()
        except AnalysisException:
            return None
        last = max((int(n) for f in files for n in re.findall(r"/batch=(\d+)/", f)), default=None)
        if last is None:
            return None
        commit = self.spark.read.schema("value string").text(f"{self.root}/commit/batch={last}")
        return json.loads(commit.first()["value"])

    def begin(self) -> "Batch":
        self.record = self._last_commit() or self.record
        return Batch(self)

    def has_applied(self, source: str, number: int) -> bool:
        """Has this batch of the source been committed, whichever came before and after it?"""
        return any(a <= number <= b for a, b in self.record["sources"].get(source, []))

    def appended(self, name: str) -> DataFrame:
        """All committed rows of an appended table."""
        return self._rows(name, self.record["begins"], self.record["batch"])

    def facts(self, since: datetime.date | None = None) -> DataFrame:
        """Order facts, all or from a day on; folders of earlier months are not read."""
        if since is None:
            return self.appended("fact_orders")
        rows = self._rows("fact_orders", self.record["begins"], self.record["batch"], keep=True)
        return rows.filter(
            (F.col("month") >= since.year * 100 + since.month)
            & (F.col("date_key") >= int(since.strftime("%Y%m%d")))
        ).drop("batch", "month")

    def state(self, name: str) -> DataFrame:
        """The committed state of each key."""
        return self._state(name, self.record["begins"], self.record["batch"])

    def due(self, now: datetime.datetime) -> DataFrame:
        """Failed messages whose next attempt may be due, by the folders of hours up to now.

        Messages are found by their entries there; their state decides, as an entry may be of an
        attempt that was made since.
        """
        record = self.record
        entries = self._rows("due", record["begins"], record["batch"], keep=True)
        ids = entries.filter(F.col("slot") <= slot_of(now)).select("failed_message_id").distinct()
        ids = staged(ids, "due")
        found = ids.select(self.bucket_of("failed_message_id").alias("b")).distinct().collect()
        buckets = {r["b"] for r in found}
        state = self._state("failed_messages", record["begins"], record["batch"], buckets)
        return state.join(ids, "failed_message_id", "left_semi")

    def dimension(self, name: str) -> DataFrame:
        """Current and closed versions."""
        return self.state(name).unionByName(self.appended(f"{name}_closed"))

    def compact(self) -> None:
        """Write the state of all keys once, from where readers then begin."""
        batch = self.begin()
        for name in STATE:
            batch.upsert(name, self.state(name))
            batch.begins[name] = batch.number
        # Entries of messages that still wait were written with their state.
        batch.begins["due"] = batch.number
        batch.commit()

    def bucket_of(self, key) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def bucket_number(self, key: int) -> int:
        one = self.spark.range(1).select(self.bucket_of(F.lit(key).cast("bigint")).alias("b"))
        return one.first()["b"]

    def _rows(self, name: str, begins: dict, last: int, keep: bool = False) -> DataFrame:
        """Rows of the batches that count; filters on folder names leave out all others."""
        ddl = STATE[name][1] if name in STATE else APPENDED[name]
        folders = [("batch", "bigint"), *([_FOLDERS[name]] if name in _FOLDERS else [])]
        schema = ", ".join([ddl, *(f"{column} {kind}" for column, kind in folders)])
        if last == 0:
            rows = self.spark.createDataFrame([], schema)
        else:
            rows = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
            rows = rows.filter(F.col("batch").between(begins.get(name, 0), last))
        return rows if keep else rows.drop(*(column for column, _ in folders))

    def _state(self, name: str, begins: dict, last: int, only: set[int] | None = None) -> DataFrame:
        key, ddl = STATE[name]
        rows = self._rows(name, begins, last, keep=True)
        if only is not None:
            rows = rows.filter(F.col("bucket").isin(*sorted(only)))
        latest = rows.groupBy(key).agg(F.max_by(F.struct(*_names(ddl)), "batch").alias("latest"))
        return latest.select("latest.*")


class Batch:
    """One batch of writes. Reads see what it has written so far."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse
        self.number = warehouse.record["batch"] + 1
        self.begins = dict(warehouse.record["begins"])
        self.written: set[str] = set()

    def keep(self, name: str, rows: DataFrame, *folders: str) -> DataFrame:
        """Rows that are used more than once, written and read back.

        They outlive a lost executor, and plans built on them start from a scan; `folders`
        are columns by which the scan finds its part. They stay until their batch number
        comes again; a finished batch's can be deleted.
        """
        path = f"{self.warehouse.root}/staging/batch={self.number}/{name}"
        writer = rows.write.mode("overwrite").option("compression", "zstd")
        with _variants_whole(self.warehouse.spark):
            writer.partitionBy(*folders).parquet(path)
        read = self.warehouse.spark.read.schema(rows.schema).parquet(path)
        return read.select(*rows.columns)

    def buckets(self, keys: DataFrame, key: str) -> set[int]:
        """The buckets some keys fall in: at most as many as there are buckets."""
        rows = keys.select(self.warehouse.bucket_of(key).alias("b")).distinct().collect()
        return {r["b"] for r in rows}

    def state(self, name: str, only: set[int] | None = None) -> DataFrame:
        last = self.number if name in self.written else self.number - 1
        return self.warehouse._state(name, self.begins, last, only)

    def upsert(self, name: str, rows: DataFrame) -> None:
        """The new state of some keys, a row each."""
        key, ddl = STATE[name]
        placed = rows.select(*_names(ddl)).withColumn("bucket", self.warehouse.bucket_of(key))
        self._write(name, placed.hint("rebalance", "bucket"), "bucket")
        if name == "failed_messages":
            # Filed anew under the hour of the next attempt; a message without one is due.
            new = self._own(name).filter("status = 'pending' and retry_count < max_retries")
            at = F.col("next_retry_at")
            hour = F.datediff(F.to_date(at), F.lit(datetime.date(1970, 1, 1))) * 24 + F.hour(at)
            slots = new.select("failed_message_id", F.coalesce(hour, F.lit(0)).alias("slot"))
            self._write("due", slots.hint("rebalance", "slot"), "slot")

    def _left(self, name: str) -> bool:
        path = f"{self.warehouse.root}/{name}/batch={self.number}"
        try:
            return bool(self.warehouse.spark.read.schema("x int").parquet(path).inputFiles())
        except AnalysisException:
            return False

    def _own(self, name: str) -> DataFrame:
        """What this batch has written to a state table."""
        return self.warehouse._rows(name, {name: self.number}, self.number)

    def append(self, name: str, rows: DataFrame) -> None:
        rows = rows.select(*_names(APPENDED[name]))
        if name == "fact_orders":
            month = F.floor(F.col("date_key") / 100).cast("int")
            rows = rows.withColumn("month", month).hint("rebalance", "month")
            self._write(name, rows, "month")
        else:
            self._write(name, rows)

    def overwrite(self, name: str, rows: DataFrame) -> None:
        """All rows of an appended table anew: readers begin with this batch."""
        self.append(name, rows)
        self.begins[name] = self.number

    def _write(self, name: str, rows: DataFrame, *folders: str) -> None:
        path = f"{self.warehouse.root}/{name}/batch={self.number}"
        rows.write.mode("overwrite").partitionBy(*folders).parquet(path)
        self.written.add(name)

    def commit(
        self, source: str | None = None, source_batch: int | None = None, counts: dict | None = None
    ) -> None:
        """Make the batch count. Where a failed run has left rows of a table that this one did not
        write to, they are replaced by none; so is a table that is not there yet."""
        spark, record = self.warehouse.spark, self.warehouse.record
        for name in [*STATE, *APPENDED]:
            if name not in self.written and (self.number == 1 or self._left(name)):
                ddl = STATE[name][1] if name in STATE else APPENDED[name]
                folders = [" ".join(_FOLDERS[name])] if name in _FOLDERS else []
                none = spark.createDataFrame([], ", ".join([ddl, *folders]))
                self._write(name, none, *(x.split()[0] for x in folders))
        sources = dict(record["sources"])
        if source is not None:
            sources[source] = _with_number(sources.get(source, []), source_batch)
        new = record | {
            "batch": self.number,
            "sources": sources,
            "begins": self.begins,
            "counts": counts or {},
        }
        # Fails if the number is taken: then another writer's batch came first.
        spark.createDataFrame([(json.dumps(new),)], "value string").coalesce(1).write.mode(
            "errorifexists"
        ).text(f"{self.warehouse.root}/commit/batch={self.number}")
        self.warehouse.record = new


@contextmanager
def _variants_whole(spark: SparkSession) -> Iterator[None]:
    """What is written in here has each VARIANT in one column.

    Else Spark finds common fields in the first rows of a file and cuts every value up into these;
    readers that want whole images then put each together again.
    """
    name = "spark.sql.variant.inferShreddingSchema"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def slot_of(now: datetime.datetime) -> int:
    """The hour a time without zone is in, from 1970 on."""
    return int((now - datetime.datetime(1970, 1, 1)).total_seconds() // 3600)


def _with_number(runs: list[list[int]], number: int) -> list[list[int]]:
    """Runs of applied batch numbers with one more; a stream's are one run."""
    found: list[list[int]] = []
    for a, b in sorted([*runs, [number, number]]):
        if found and a <= found[-1][1] + 1:
            found[-1][1] = max(found[-1][1], b)
        else:
            found.append([a, b])
    return found


def _names(ddl: str) -> list[str]:
    """Column names of a DDL string; a part without a space is the scale of a decimal."""
    return [field.split()[0] for field in ddl.split(",") if " " in field.strip()]
