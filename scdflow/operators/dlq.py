"""Failed messages: capture, retry and dead letter.

Status of a message:

    (new)      -> pending                 first failure
    any        -> pending, dead_letter    fails again on delivery
    pending    -> resolved                retry succeeds
    pending    -> pending                 retry fails, attempts left
    pending    -> dead_letter             retry fails, none left

`resolved` messages can come back when the same record is delivered and fails again.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdflow.functions import minutes_after, naive
from scdflow.schemas import (
    FAILED_MESSAGE,
    FIRST_DELAY_MINUTES,
    MAX_RETRIES,
    RETRY_DELAY_MINUTES,
)

MESSAGE = ["topic", "partition", "message_offset"]
# Text kept from the newest failure; what comes first stays for the rest.
_NEWEST = ["error_message", "error_stacktrace"]
_FIRST = ["message_timestamp", "message_key", "message_value", "error_type", "failed_at"]


def attempts(rejected: DataFrame, failed_at) -> DataFrame:
    """Failed attempts from rejected records: topic, partition, offset, value and error."""
    have = set(rejected.columns)
    return rejected.select(
        "topic",
        "partition",
        F.col("offset").alias("message_offset"),
        F.col("ts" if "ts" in have else "timestamp").alias("message_timestamp"),
        (F.col("key") if "key" in have else F.lit(None).cast("string")).alias("message_key"),
        F.col("value").alias("message_value"),
        "error_type",
        "error_message",
        (
            F.col("error_stacktrace")
            if "error_stacktrace" in have
            else F.concat("error_type", F.lit(": "), "error_message")
        ).alias("error_stacktrace"),
        naive(failed_at).alias("failed_at"),
    )


def records(messages: DataFrame) -> DataFrame:
    """Filed messages as the records they were."""
    return messages.select(
        "topic",
        "partition",
        F.col("message_offset").alias("offset"),
        F.col("message_timestamp").alias("timestamp"),
        F.col("message_value").alias("value"),
    )


def message_id() -> Column:
    return F.xxhash64(*MESSAGE)


def upsert(failed_attempts: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Failed messages after more attempts: one row per address.

    Stored messages enter the same grouping as the attempts, so there is one shuffle
    and it is pre-aggregated, however often one message fails. Attempts of an address
    are told apart by `failed_at`. Messages without a new attempt come back unchanged.
    """
    new = F.struct("failed_at", *_NEWEST)
    rows = failed_attempts.select(
        *MESSAGE,
        "failed_at",
        F.struct(*_FIRST).alias("first"),
        new.alias("attempt"),
        F.lit(None).cast(_struct_of(FAILED_MESSAGE)).alias("stored"),
    )
    if stored is not None:
        kept = stored.select(*[c for c in _names(FAILED_MESSAGE)])
        rows = rows.unionByName(
            kept.select(
                *MESSAGE,
                # Sorts before any attempt.
                naive("0001-01-01 00:00:00").alias("failed_at"),
                F.struct(*_FIRST).alias("first"),
                F.lit(None).cast(rows.schema["attempt"].dataType).alias("attempt"),
                F.struct(*kept.columns).alias("stored"),
            )
        )
    tried = F.col("attempt").isNotNull()
    folded = rows.groupBy(*MESSAGE).agg(
        F.count_if(tried).cast("int").alias("n"),
        F.min_by("first", F.struct("failed_at", "first")).alias("first"),
        F.max_by("attempt", F.when(tried, F.struct("failed_at", "attempt"))).alias("last"),
        F.first("stored", ignorenulls=True).alias("stored"),
    )
    known = F.col("stored").isNotNull()
    repeats = F.when(known, F.col("n")).otherwise(F.col("n") - 1)
    repeated = repeats > 0
    count = F.coalesce(F.col("stored.retry_count"), F.lit(0)) + repeats
    max_retries = F.coalesce(F.col("stored.max_retries"), F.lit(MAX_RETRIES))
    untouched = F.col("n") == 0
    return folded.select(
        message_id().alias("failed_message_id"),
        *MESSAGE,
        *[F.col(f"first.{c}").alias(c) for c in _FIRST if c != "failed_at"],
        *[
            F.when(untouched, F.col(f"stored.{c}")).otherwise(F.col(f"last.{c}")).alias(c)
            for c in _NEWEST
        ],
        count.cast("int").alias("retry_count"),
        max_retries.alias("max_retries"),
        F.when(repeated, F.col("last.failed_at"))
        .otherwise(F.col("stored.last_retry_at"))
        .alias("last_retry_at"),
        F.when(untouched, F.col("stored.next_retry_at"))
        .otherwise(minutes_after("last.failed_at", FIRST_DELAY_MINUTES))
        .alias("next_retry_at"),
        F.when(untouched, F.col("stored.status"))
        .when(repeated & (count >= max_retries), "dead_letter")
        .otherwise("pending")
        .alias("status"),
        F.col("stored.resolution_notes").alias("resolution_notes"),
        F.col("first.failed_at").alias("failed_at"),
        F.col("stored.resolved_at").alias("resolved_at"),
    ).select(*_names(FAILED_MESSAGE))


def _names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(",")]


def _struct_of(ddl: str) -> str:
    fields = [field.split() for field in ddl.split(",")]
    return "struct<" + ",".join(f"{name}:{kind}" for name, kind in fields) + ">"


def _ready(as_of) -> Column:
    due = F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= naive(as_of))
    return (
        (F.col("status") == "pending") & (F.col("retry_count") < F.col("max_retries")) & due
    )


def ready_for_retry(failed: DataFrame, as_of) -> DataFrame:
    """Messages whose next attempt is due, oldest failure first."""
    return (
        failed.filter(_ready(as_of))
        .select(
            "failed_message_id",
            *MESSAGE,
            "error_type",
            "retry_count",
            "max_retries",
            "failed_at",
            "last_retry_at",
        )
        .orderBy("failed_at", *MESSAGE)
    )


def retry_batch(failed: DataFrame, as_of, limit: int = 100) -> DataFrame:
    """The next messages to retry, with their payload."""
    return (
        failed.filter(_ready(as_of))
        .orderBy("failed_at", *MESSAGE)
        .limit(limit)
        .select(
            "failed_message_id",
            *MESSAGE,
            "message_timestamp",
            "message_value",
            "retry_count",
            "max_retries",
            "failed_at",
        )
    )


def retry_one(failed: DataFrame, message: int) -> DataFrame:
    """One message to retry on request: it must be pending, due or not."""
    return failed.filter((F.col("failed_message_id") == message) & (F.col("status") == "pending"))


def outcomes(chosen: DataFrame, errors: DataFrame) -> DataFrame:
    """How the retry of each chosen message went; `errors` has the address of those that failed."""
    failed = errors.groupBy(*MESSAGE).agg(F.min("error_message").alias("error_message"))
    return (
        chosen.select(*MESSAGE)
        .join(failed, MESSAGE, "left")
        .select(*MESSAGE, F.col("error_message").isNull().alias("succeeded"), "error_message")
    )


def apply_outcomes(
    failed: DataFrame, outcomes: DataFrame, as_of, dead_letter: bool = True
) -> DataFrame:
    """Failed messages after a retry run.

    `outcomes` has a message's address, succeeded and error_message, one row per message
    retried. With `dead_letter=False`, as for a single retry on request, a failure
    only backs off.
    """
    now = naive(as_of)
    results = outcomes.select(
        *MESSAGE, "succeeded", F.col("error_message").alias("new_error")
    )
    won = F.coalesce(F.col("succeeded"), F.lit(False))
    lost = F.coalesce(~F.col("succeeded"), F.lit(False))
    dead = lost & (F.col("retry_count") + 1 >= F.col("max_retries")) & F.lit(dead_letter)
    back_off = lost & ~dead
    return (
        failed.join(results, MESSAGE, "left")
        .select(
            *[
                c
                for c in failed.columns
                if c
                not in (
                    "status",
                    "resolved_at",
                    "retry_count",
                    "last_retry_at",
                    "next_retry_at",
                    "error_message",
                )
            ],
            F.when(won, "resolved").when(dead, "dead_letter").otherwise(F.col("status")).alias("status"),
            F.when(won, now).otherwise(F.col("resolved_at")).alias("resolved_at"),
            F.when(back_off, F.col("retry_count") + 1)
            .otherwise(F.col("retry_count"))
            .alias("retry_count"),
            F.when(lost, now).otherwise(F.col("last_retry_at")).alias("last_retry_at"),
            F.when(back_off, minutes_after(now, RETRY_DELAY_MINUTES))
            .otherwise(F.col("next_retry_at"))
            .alias("next_retry_at"),
            F.when(dead, F.col("new_error")).otherwise(F.col("error_message")).alias("error_message"),
        )
        .select(*failed.columns)
    )


def run_totals(batch: DataFrame, outcomes: DataFrame, dead_letter: bool = True) -> DataFrame:
    """How a retry run went: messages resolved, to be tried again, and given up."""
    last_try = (F.col("retry_count") + 1 >= F.col("max_retries")) & F.lit(dead_letter)
    return batch.join(outcomes.select(*MESSAGE, "succeeded"), MESSAGE).agg(
        F.count_if("succeeded").alias("succeeded"),
        F.count_if(~F.col("succeeded") & ~last_try).alias("failed"),
        F.count_if(~F.col("succeeded") & last_try).alias("dead_lettered"),
    )
