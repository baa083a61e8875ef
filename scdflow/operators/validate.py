"""Checks on changes, as an array of errors per row.

Error types carry the names under which a failed message is filed. The first error
of a row is the one reported.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdflow.functions import margin, money
from scdflow.schemas import CUSTOMER_LENGTHS, ORDER_LENGTHS, PRODUCT_LENGTHS
from scdflow.sources.shared import staged


_ERROR = "struct<error_type:string,error_message:string>"


def _when(condition: Column, kind: str, message) -> Column:
    """A list with one error, or with none."""
    message = message if isinstance(message, Column) else F.lit(message)
    error = F.struct(F.lit(kind).alias("error_type"), message.alias("error_message"))
    return F.when(condition, F.array(error.cast(_ERROR))).otherwise(
        F.array().cast(f"array<{_ERROR}>")
    )


def with_errors(rows: DataFrame, checks: Sequence[Column]) -> DataFrame:
    return rows.withColumn("errors", F.concat(*checks))


def valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") == 0).drop("errors")


def rejected(checked: DataFrame) -> DataFrame:
    """Failing rows with their first error, ready to be filed as failed messages.

    There is no exception whose stack could be kept; all errors of the row are, a line each.
    """
    return (
        checked.filter(F.size("errors") > 0)
        .withColumns(
            {
                "error_type": F.col("errors")[0]["error_type"],
                "error_message": F.col("errors")[0]["error_message"],
                "error_stacktrace": F.array_join(
                    F.transform(
                        "errors", lambda e: F.concat(e["error_type"], F.lit(": "), e["error_message"])
                    ),
                    "\n",
                ),
            }
        )
        .drop("errors")
    )


def _written() -> Column:
    """Deletes write no attributes, so column limits do not apply to them."""
    return ~F.col("op").eqNullSafe("d")


def _null_value(name: str) -> Column:
    """The key is there and its value is null."""
    return F.coalesce(F.is_variant_null(F.col(f"given.{name}")), F.lit(False))


def _is_text(name: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.col(f"given.{name}")) == "STRING", F.lit(False))


def email_checks() -> list[Column]:
    return [
        _when(_null_value("email"), "AttributeError", "email is null"),
        _when(
            F.col("given.email").isNotNull() & ~_null_value("email") & ~_is_text("email"),
            "AttributeError",
            "email is not text",
        ),
        _when(
            _is_text("email") & F.contains(F.upper("email"), F.lit("ERROR")),
            "ValueError",
            F.concat(F.lit("email '"), "email", F.lit("' contains the forbidden word ERROR")),
        ),
    ]


def not_null_checks(columns: Sequence[str]) -> list[Column]:
    return [
        _when(F.col(c).isNull() & _written(), "IntegrityError", f"{c} must not be null")
        for c in columns
    ]


def length_checks(limits: Mapping[str, int]) -> list[Column]:
    return [
        _when(
            (F.length(c) > n) & _written(), "DataError", f"{c} is longer than {n} characters"
        )
        for c, n in limits.items()
    ]


def number_checks(columns: Sequence[str]) -> list[Column]:
    """Numbers may be absent (then they are 0) but not null, and text must be numeric."""
    checks = []
    for c in columns:
        given = F.col(f"given.{c}").isNotNull()
        checks += [
            _when(_null_value(c) & _written(), "TypeError", f"{c} is null"),
            _when(
                given & ~_null_value(c) & F.col(c).isNull() & _written(),
                "ValueError",
                F.concat(
                    F.lit(f"{c} is not a number: "),
                    F.coalesce(
                        F.try_variant_get(f"given.{c}", "$", "string"), F.lit("a nested value")
                    ),
                ),
            ),
        ]
    return checks


def overflow_checks(columns: Sequence[str]) -> list[Column]:
    return [
        _when(
            F.col(c).isNotNull() & money(c).isNull() & _written(),
            "DataError",
            f"{c} does not fit DECIMAL(10,2)",
        )
        for c in columns
    ]


def check_customers(changes: DataFrame, emails: bool = True) -> DataFrame:
    """`emails=False` leaves out the checks on email addresses."""
    return with_errors(
        changes,
        (email_checks() if emails else [])
        + not_null_checks(["customer_id"])
        + length_checks(CUSTOMER_LENGTHS),
    )


def check_products(changes: DataFrame) -> DataFrame:
    """Absent prices become 0 in the result."""
    price, cost = _amount("price"), _amount("cost")
    too_wide = price.isNotNull() & cost.isNotNull() & margin(price, cost).isNull()
    checked = with_errors(
        changes,
        number_checks(["price", "cost"])
        + not_null_checks(["product_id"])
        + length_checks(PRODUCT_LENGTHS)
        + overflow_checks(["price", "cost"])
        + [_when(too_wide & _written(), "DataError", "margin does not fit DECIMAL(5,2)")],
    )
    return checked.withColumns({"price": price, "cost": cost})


def check_orders(changes: DataFrame) -> DataFrame:
    """An order's status goes into its facts, so their limit holds for it."""
    return with_errors(changes, not_null_checks(["order_id"]) + length_checks(ORDER_LENGTHS))


def check_order_items(changes: DataFrame) -> DataFrame:
    """Checks that do not need a lookup. Absent amounts become 0 in the result."""
    amounts = ["unit_price", "line_total"]
    checked = with_errors(
        changes,
        number_checks(amounts)
        + not_null_checks(["order_id", "order_item_id", "quantity"])
        + overflow_checks(amounts),
    )
    return checked.withColumns({c: _amount(c) for c in amounts})


def _amount(name: str) -> Column:
    return F.when(F.col(f"given.{name}").isNull(), F.lit(0.0)).otherwise(F.col(name))


def duplicates(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def null_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column that must have none, in one pass."""
    return _one_row_each(
        rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), columns, "nulls"
    )


def overlong_counts(rows: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Values per column that exceed its length, in one pass."""
    counted = rows.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()])
    return _one_row_each(counted, list(limits), "overlong")


def _one_row_each(row: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    return row.unpivot([], list(columns), "column_name", name)


def orphans(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no parent. A null key refers to nothing and is no orphan.

    The keys of the parents are written first: of a plan of theirs Spark guesses the size, and
    it would collect millions of them to broadcast.
    """
    known = staged(parents.select(key).distinct(), "parents")
    return rows.filter(F.col(key).isNotNull()).join(known, key, "left_anti")
