"""Queries over failed messages."""

import math

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from scdflow.functions import naive
from scdflow.operators.dlq import MESSAGE
from scdflow.schemas import FAILED_MESSAGE, TOPIC_PREFIX, TOPICS, UNRESOLVED


_LAST = (1 << 62) - 1


def summary(failed: DataFrame) -> DataFrame:
    """Per topic, status and error type, the largest groups first."""
    return (
        failed.groupBy("topic", "status", "error_type")
        .agg(
            F.count("*").alias("message_count"),
            F.min("failed_at").alias("first_failure"),
            F.max("failed_at").alias("last_failure"),
            (F.sum("retry_count").cast("double") / F.count("retry_count")).alias("avg_retry_count"),
            F.count_if(F.col("retry_count") >= F.col("max_retries")).alias("dead_letter_count"),
        )
        .orderBy(F.desc("message_count"), "topic", "status", "error_type")
    )


def status_counts(failed: DataFrame) -> DataFrame:
    return failed.groupBy("status").agg(F.count("*").alias("n"))


def page(
    failed: DataFrame, page_number: int = 1, per_page: int = 20, status: str | None = None
) -> tuple[DataFrame, int, int]:
    """One page of the list, newest failure first, with total rows and page count."""
    chosen = failed if status is None else failed.filter(F.col("status") == status)
    total = chosen.count()
    rows = page_rows(chosen, page_number, per_page)
    return rows, total, math.ceil(total / per_page)


_LISTED = [
    "failed_message_id",
    *MESSAGE,
    "message_timestamp",
    "error_type",
    "error_message",
    "retry_count",
    "max_retries",
    "status",
    "failed_at",
    "last_retry_at",
    "next_retry_at",
]


def page_rows(
    failed: DataFrame, page_number: int, per_page: int, status: str | None = None
) -> DataFrame:
    """A page by its number. All pages before it are sorted too: see `page_after`."""
    chosen = failed if status is None else failed.filter(F.col("status") == status)
    listed = chosen.select(*_LISTED).orderBy(F.desc("failed_at"), *MESSAGE)
    return listed.offset((page_number - 1) * per_page).limit(per_page)


def page_deep(
    failed: DataFrame,
    page_number: int,
    per_page: int,
    status: str | None = None,
    bins: int = 1000,
    sorted_rows: int = 100_000,
) -> DataFrame:
    """A page by its number, at any depth, without sorting the pages before it.

    Rows are counted in bins of their time, the bins around the page are cut into bins again, and
    so on until few rows are left around it: at most `sorted_rows`, or those of one instant. Only
    these are sorted. Each step is a scan with a pre-aggregated grouping; null times come last.
    """
    chosen = failed if status is None else failed.filter(F.col("status") == status)
    # Newest first: the time turned around, in microseconds.
    turn = -F.expr("timestampdiff(microsecond, timestamp_ntz'1970-01-01', failed_at)")
    rank = F.coalesce(turn, F.lit(_LAST))
    listed = chosen.select(*_LISTED, rank.alias("rank"))
    skip = (page_number - 1) * per_page
    ends = listed.agg(F.min("rank").alias("low"), F.max("rank").alias("high"), F.count("*").alias("n")).first()
    low, high, left = ends["low"], ends["high"], ends["n"]
    while left > sorted_rows and low < high and skip < left:
        width = -(-(high - low + 1) // bins)
        numbered = F.expr(f"(`rank` - ({low}L)) div {width}L")
        inside = listed.filter(F.col("rank").between(low, high))
        counts = sorted(map(tuple, inside.groupBy(numbered.alias("bin")).count().collect()))
        first = last = None
        before = passed = 0
        for number, n in counts:
            if first is None and passed + n > skip:
                first, before = number, passed
            passed += n
            last = number
            if passed >= skip + per_page:
                break
        low, high, skip = low + first * width, min(high, low + (last + 1) * width - 1), skip - before
        shrunk = passed - before
        if shrunk == left:
            break
        left = shrunk
    near = listed.filter(F.col("rank").between(low, high)) if low is not None else listed
    ordered = near.orderBy("rank", *MESSAGE).offset(skip).limit(per_page)
    return ordered.drop("rank")


def page_after(failed: DataFrame, last: Row | None, per_page: int) -> DataFrame:
    """The page after the one that ends with row `last`; however deep, it keeps one page."""
    chosen = failed.select(*_LISTED)
    if last is not None:
        at = naive(last["failed_at"])
        address = F.struct(*[F.lit(last[c]).cast(failed.schema[c].dataType).alias(c) for c in MESSAGE])
        later = (F.col("failed_at") == at) & (F.struct(*MESSAGE) > address)
        chosen = chosen.filter((F.col("failed_at") < at) | later)
    return chosen.orderBy(F.desc("failed_at"), *MESSAGE).limit(per_page)


def page_counts(failed: DataFrame, per_page: int = 20) -> DataFrame:
    """Rows and pages of the list for each status filter."""
    return failed.groupBy("status").agg(
        F.count("*").alias("total"),
        F.ceil(F.count("*") / F.lit(per_page)).cast("bigint").alias("pages"),
    )


def detail(failed: DataFrame, message: int | None = None) -> DataFrame:
    """Every column of one message, or of all."""
    columns = [field.split()[0] for field in FAILED_MESSAGE.split(",")]
    chosen = failed if message is None else failed.filter(F.col("failed_message_id") == message)
    return chosen.select(*columns)


def partition_backlog(failed: DataFrame) -> DataFrame:
    """Unresolved messages per topic partition; their number stands for the lag."""
    return (
        failed.filter(F.col("status").isin(*UNRESOLVED))
        .groupBy("topic", "partition")
        .agg(
            F.count("*").alias("failed_count"),
            F.min("message_offset").alias("min_offset"),
            F.max("message_offset").alias("max_offset"),
        )
        .withColumn("lag", F.col("failed_count"))
        .orderBy("topic", "partition")
    )


def partition_backlog_or_healthy(failed: DataFrame) -> DataFrame:
    """The backlog, or a row of zeros per topic when there is none at all."""
    backlog = partition_backlog(failed)
    healthy = failed.sparkSession.createDataFrame(
        [(t, 0, 0, None, None, 0) for t in TOPICS], backlog.schema
    )
    # A row for each topic partition, so all of them fit one task.
    both = backlog.withColumn("real", F.lit(True)).unionByName(healthy.withColumn("real", F.lit(False)))
    some = F.bool_or("real").over(Window.partitionBy())
    return (
        both.withColumn("some", some)
        .filter(F.col("real") == F.col("some"))
        .drop("real", "some")
        .orderBy("topic", "partition")
    )


def total_lag(failed: DataFrame) -> DataFrame:
    return partition_backlog(failed).agg(F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"))


def short_list(failed: DataFrame) -> DataFrame:
    """Topic without its prefix and the start of the error message."""
    return failed.select(
        F.replace("topic", F.lit(TOPIC_PREFIX), F.lit("")).alias("topic"),
        "partition",
        "message_offset",
        F.concat(F.substring("error_message", 1, 80), F.lit("...")).alias("error_message"),
        "status",
        "failed_at",
    )
