"""Transitions of failed messages, one row each, and the queries over them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scdflow.operators import dlq
from scdflow.plans import monitoring
from scdflow.schemas import FAILED_MESSAGE, TOPICS

T0 = dt.datetime(2024, 1, 1)
NOW = dt.datetime(2024, 1, 2)
MINUTE = dt.timedelta(minutes=1)
ATTEMPT = (
    "topic string, partition int, message_offset bigint, message_timestamp timestamp_ntz, "
    "message_key string, message_value string, error_type string, error_message string, "
    "error_stacktrace string, failed_at timestamp_ntz"
)


def attempt(offset, n):
    return ("t", 0, offset, T0, None, f"v{n}", f"E{n}", f"m{n}", f"s{n}", T0 + n * MINUTE)


def tried(spark, *rows):
    return spark.createDataFrame(list(rows), ATTEMPT)


def message(status="pending", retry_count=0, offset=1, next_retry_at=T0, **changes):
    row = {
        "failed_message_id": offset,
        "topic": "t",
        "partition": 0,
        "message_offset": offset,
        "message_timestamp": T0,
        "message_key": None,
        "message_value": "v",
        "error_type": "E",
        "error_message": "m",
        "error_stacktrace": "s",
        "retry_count": retry_count,
        "max_retries": 3,
        "last_retry_at": None,
        "next_retry_at": next_retry_at,
        "status": status,
        "resolution_notes": None,
        "failed_at": T0,
        "resolved_at": None,
    }
    return tuple((row | changes).values())


def stored(spark, *rows):
    return spark.createDataFrame(list(rows), FAILED_MESSAGE)


@pytest.mark.parametrize(
    ("failures", "retry_count", "status"),
    [(1, 0, "pending"), (2, 1, "pending"), (3, 2, "pending"), (4, 3, "dead_letter")],
)
@pytest.mark.parametrize("split", [False, True])
def test_failures_of_one_address(spark, failures, retry_count, status, split):
    rows = [attempt(1, n) for n in range(failures)]
    if split and failures > 1:
        before = dlq.upsert(tried(spark, rows[0]))
        result = dlq.upsert(tried(spark, *rows[1:]), before)
    else:
        result = dlq.upsert(tried(spark, *rows))
    (row,) = result.collect()
    last = failures - 1
    assert (row["retry_count"], row["status"]) == (retry_count, status)
    # The first failure says what and when, the newest says why.
    assert (row["error_type"], row["message_value"], row["failed_at"]) == ("E0", "v0", T0)
    assert (row["error_message"], row["error_stacktrace"]) == (f"m{last}", f"s{last}")
    assert row["next_retry_at"] == T0 + (last + 5) * MINUTE
    assert row["last_retry_at"] == (T0 + last * MINUTE if last else None)


def test_stored_messages_without_an_attempt_stay(spark):
    before = stored(spark, message("resolved", 1, 1), message("dead_letter", 3, 2))
    after = dlq.upsert(tried(spark, attempt(3, 0)), before)
    kept = after.filter("message_offset < 3").drop("failed_message_id")
    assert sorted(kept.collect()) == sorted(before.drop("failed_message_id").collect())
    assert after.count() == 3


def test_resolved_message_comes_back(spark):
    for count, status in ((0, "pending"), (2, "dead_letter")):
        before = stored(spark, message("resolved", count))
        (row,) = dlq.upsert(tried(spark, attempt(1, 0)), before).collect()
        assert (row["retry_count"], row["status"]) == (count + 1, status)


def test_ready(spark):
    failed = stored(
        spark,
        message(offset=1),
        message(offset=2, next_retry_at=None, failed_at=T0 - MINUTE),
        message(offset=3, next_retry_at=NOW),
        message(offset=4, next_retry_at=NOW + MINUTE),
        message(offset=5, retry_count=3),
        message("resolved", offset=6),
        message("retrying", offset=7),
        message("dead_letter", offset=8),
    )
    ready = [r["message_offset"] for r in dlq.ready_for_retry(failed, NOW).collect()]
    assert ready == [2, 1, 3]
    assert [r["message_offset"] for r in dlq.retry_batch(failed, NOW, 2).collect()] == [2, 1]
    assert dlq.retry_one(failed, 4).count() == 1
    assert dlq.retry_one(failed, 6).count() == 0


@pytest.mark.parametrize(
    ("count", "succeeded", "give_up", "expected"),
    [
        (0, True, True, ("resolved", 0, None, T0, NOW, "m")),
        (0, False, True, ("pending", 1, NOW, NOW + 15 * MINUTE, None, "m")),
        (1, False, True, ("pending", 2, NOW, NOW + 15 * MINUTE, None, "m")),
        (2, False, True, ("dead_letter", 2, NOW, T0, None, "new")),
        (2, True, True, ("resolved", 2, None, T0, NOW, "m")),
        (2, False, False, ("pending", 3, NOW, NOW + 15 * MINUTE, None, "m")),
    ],
)
def test_outcomes(spark, count, succeeded, give_up, expected):
    failed = stored(spark, message(retry_count=count), message(offset=2))
    outcomes = spark.createDataFrame(
        [(succeeded, None if succeeded else "new")], "succeeded boolean, error_message string"
    )
    outcomes = failed.filter("message_offset = 1").select(*dlq.MESSAGE).join(outcomes)
    columns = ["status", "retry_count", "last_retry_at", "next_retry_at", "resolved_at", "error_message"]
    after = dlq.apply_outcomes(failed, outcomes, NOW, give_up)
    (row,) = after.filter("message_offset = 1").select(*columns).collect()
    assert tuple(row) == expected
    (other,) = after.filter("message_offset = 2").collect()
    assert tuple(other) == message(offset=2)
    totals = dlq.run_totals(failed, outcomes, give_up).collect()[0]
    dead = not succeeded and count == 2 and give_up
    assert tuple(totals) == (int(succeeded), int(not succeeded and not dead), int(dead))


def test_backlog_and_healthy_default(spark):
    failed = stored(
        spark,
        message(offset=1),
        message("retrying", offset=9),
        message("resolved", offset=20),
        message("dead_letter", offset=30),
    )
    backlog = monitoring.partition_backlog_or_healthy(failed).collect()
    assert [tuple(r) for r in backlog] == [("t", 0, 2, 1, 9, 2)]
    assert monitoring.total_lag(failed).collect()[0][0] == 2
    quiet = failed.filter("status = 'resolved'")
    healthy = monitoring.partition_backlog_or_healthy(quiet).collect()
    assert sorted((r["topic"], r["partition"], r["failed_count"], r["lag"]) for r in healthy) == sorted(
        (t, 0, 0, 0) for t in TOPICS
    )
    assert monitoring.total_lag(quiet).collect()[0][0] == 0


def test_pages(spark):
    failed = stored(spark, *[message(offset=n, failed_at=T0 + n * MINUTE) for n in range(45)])
    rows, total, pages = monitoring.page(failed, 3, 20)
    assert (total, pages) == (45, 3)
    assert [r["message_offset"] for r in rows.collect()] == [4, 3, 2, 1, 0]
    rows, total, pages = monitoring.page(failed, 1, 20, status="resolved")
    assert (rows.count(), total, pages) == (0, 0, 0)


def test_hot_address_is_added_up_before_the_shuffle(spark):
    rows = spark.range(2000).select(
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("message_offset"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("failed_at"),
        *[
            F.lit(None).cast(kind).alias(name)
            for name, kind in (f.split() for f in ATTEMPT.split(", "))
            if name not in ("topic", "partition", "message_offset", "failed_at")
        ],
    )
    result = dlq.upsert(rows)
    assert result.filter("message_offset = 0").collect()[0]["retry_count"] == 666
    assert "partial_max_by" in result._jdf.queryExecution().executedPlan().toString()
