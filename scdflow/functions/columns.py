"""Column expressions shared by the operators. All stay inside code generation."""

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from scdflow.schemas import MONEY, PERCENT


def naive(value) -> Column:
    """A timestamp without zone, from a literal or a column.

    A Python time goes in as text: as an instant it would depend on the driver's time zone.
    """
    if isinstance(value, datetime.datetime):
        value = value.isoformat(sep=" ")
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast("timestamp_ntz")


def open_end() -> Column:
    """The `valid_to` of a version that is still open."""
    return naive("9999-12-31 00:00:00")


def money(column) -> Column:
    """DECIMAL(10,2), null where the amount does not fit."""
    return _column(column).try_cast(MONEY)


def margin(price, cost) -> Column:
    """Margin in percent of the price; 0 for free goods, null where it overflows."""
    p, c = _column(price).cast("double"), _column(cost).cast("double")
    return F.when(p > 0, (p - c) / p * 100).otherwise(F.lit(0.0)).try_cast(PERCENT)


def date_key(column) -> Column:
    """`yyyyMMdd` as an integer."""
    d = _column(column)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def event_time(text, unit: str = "micros") -> Column:
    """A point in time sent as ISO text (with or without `Z`) or as an epoch number.

    `unit` says what the epoch number counts: seconds, millis or micros.
    """
    text = _column(text)
    per_second = {"seconds": 1, "millis": 1_000, "micros": 1_000_000}[unit]
    epoch = F.timestamp_micros((text.try_cast("bigint") * (1_000_000 // per_second)))
    iso = F.regexp_replace(text, "Z$", "").try_cast("timestamp_ntz")
    return F.when(text.rlike("^-?[0-9]+$"), epoch.cast("timestamp_ntz")).otherwise(iso)


def minutes_after(column, minutes: int) -> Column:
    return _column(column) + F.expr(f"interval {int(minutes)} minutes")


def surrogate_key(entity: str, business_id, *opened_by) -> Column:
    """A key that stays the same when a batch is run again: no counter is kept.

    A version is named by the record that opened it, since version numbers start
    again at 1 after a delete.
    """
    return F.xxhash64(F.lit(entity), *[_column(c) for c in (business_id, *opened_by)])


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)
