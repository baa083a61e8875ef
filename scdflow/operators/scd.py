"""Slowly changing dimensions, folded from a feed of row changes.

A change row has the business key, `seq` (any orderable column that puts the
changes of one key in order), `op`, `ts` and the attributes. Tracked attributes open a
new version when they change; the others overwrite the current version.

What each op does depends on whether the key is live:

    op      key live                       key not live
    c, u    new version or overwrite       version 1
    d       ends the version               nothing
    other   nothing                        version 1
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scdflow.functions import margin, money, open_end, surrogate_key
from scdflow.operators.skew import HOT_ROWS, SLICE_ROWS, by_key, last_seen, previous
from scdflow.schemas import CUSTOMER_TRACKED, CUSTOMER_TYPE1, PRODUCT_TRACKED, PRODUCT_TYPE1

_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def fold(
    changes: DataFrame,
    key: str,
    tracked: Sequence[str],
    type1: Sequence[str],
    hot_rows: int = HOT_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """All versions of all keys: one row per (key, open_seq).

    A version starts at the time of its change, or later: never before the version or the
    delete ahead of it. So intervals follow each other even where times run backwards.

    Changes without a key are left out; `keyless` counts them. Rows may carry `start_version`, the number the version they open must get; it is
    how stored state enters the fold.
    """
    events = _events(changes, key, tracked, type1)
    versions = by_key(
        events,
        key,
        "seq",
        lambda rows, sliced: _versions(rows, key, sliced),
        hot_rows,
        slice_rows,
    )
    return versions.select(
        key,
        "open_seq",
        "version",
        "valid_from",
        "valid_to",
        "is_current",
        "tracked.*",
        "type1.*",
    )


def keyless(changes: DataFrame, key: str) -> DataFrame:
    """Changes without a key, which no fold can take, by op."""
    return changes.filter(F.col(key).isNull()).groupBy("op").agg(F.count("*").alias("keyless"))


def change_flags(
    changes: DataFrame,
    key: str,
    tracked: Sequence[str],
    hot_rows: int = HOT_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Each effective change with `opens`: does it open a version?"""
    return by_key(
        _events(changes, key, tracked, []),
        key,
        "seq",
        lambda rows, sliced: _flagged(rows, key, sliced).select(
            key, "seq", "op", "ts", (F.col("boundary") & (F.col("op") != "d")).alias("opens")
        ),
        hot_rows,
        slice_rows,
    )


def _events(changes, key, tracked, type1) -> DataFrame:
    start = (
        F.col("start_version") if "start_version" in changes.columns else F.lit(None).cast("int")
    )
    return changes.select(
        key,
        "seq",
        F.when(F.col("op").isin("c", "u", "d"), F.col("op")).otherwise("r").alias("op"),
        "ts",
        F.struct(*tracked).alias("tracked"),
        F.struct(*type1, start.alias("start_version")).alias("type1"),
    )


def _parts(key: str, sliced: bool) -> list[str]:
    return [key, "slice"] if sliced else [key]


def _no_effect() -> Column:
    """A snapshot read of a key that is live already."""
    return (F.col("op") == "r") & F.col("prev_op").isNotNull() & (F.col("prev_op") != "d")


def _flagged(events: DataFrame, key: str, sliced: bool) -> DataFrame:
    """Effective events with `boundary`: the event opens a version or is a delete.

    A `stray` delete finds nothing to end."""
    in_order = Window.partitionBy(*_parts(key, sliced)).orderBy("seq")
    state = F.struct("op", "tracked")
    rows = events.withColumn("prev_op", F.lag("op").over(in_order))
    if sliced:
        rows = rows.join(_state_before(rows, key, state), [key, "slice"]).withColumn(
            "prev_op", F.coalesce("prev_op", "op_before")
        )
    rows = rows.filter(~_no_effect()).withColumn("prev", F.lag(state).over(in_order))
    if sliced:
        rows = rows.withColumn("prev", F.coalesce("prev", "state_before")).drop(
            "op_before", "state_before"
        )
    same = (F.col("prev.op") != "d") & F.col("tracked").eqNullSafe(F.col("prev.tracked"))
    is_boundary = (F.col("op") == "d") | F.col("prev").isNull() | ~same
    stray = (F.col("op") == "d") & (F.col("prev").isNull() | (F.col("prev.op") == "d"))
    return rows.withColumns({"boundary": is_boundary, "stray": stray}).drop("prev", "prev_op")


def _state_before(rows: DataFrame, key: str, state: Column) -> DataFrame:
    """Per slice of a hot key: the last op and the last effective state before it.

    Within a slice only the first row can be in doubt: a snapshot read counts or not
    depending on the slice before.
    """
    later = F.col("prev_op").isNotNull() & ~_no_effect()
    slices = rows.groupBy(key, "slice").agg(
        F.min_by(state, "seq").alias("first_state"),
        F.max_by("op", "seq").alias("last_op"),
        F.max_by(state, F.when(later, F.col("seq"))).alias("later_state"),
    )
    in_order = Window.partitionBy(key).orderBy("slice")
    op_before = F.col("op_before")
    first_counts = ~(
        (F.col("first_state.op") == "r") & op_before.isNotNull() & (op_before != "d")
    )
    return (
        slices.withColumn("op_before", F.lag("last_op").over(in_order))
        .withColumn(
            "state_after", F.coalesce("later_state", F.when(first_counts, F.col("first_state")))
        )
        .select(
            key,
            "slice",
            "op_before",
            F.last("state_after", ignorenulls=True)
            .over(in_order.rowsBetween(*_BEFORE))
            .alias("state_before"),
        )
    )


def _versions(events: DataFrame, key: str, sliced: bool) -> DataFrame:
    """One row per version or delete, taken at its last change.

    All windows and filters keep the order of `seq`, so one sort serves them all.
    """
    parts = _parts(key, sliced)
    in_order = Window.partitionBy(*parts).orderBy("seq")
    head = F.struct(F.col("seq").alias("open_seq"), "op", "ts", "tracked", "type1.start_version")
    opened = F.last(F.when(F.col("boundary"), head), ignorenulls=True)
    spans = (
        _flagged(events, key, sliced)
        .filter(~F.col("stray"))
        .withColumns(
            {
                "head": opened.over(in_order.rowsBetween(*_SO_FAR)),
                "ends": F.coalesce(F.lead("boundary").over(in_order), F.lit(True)),
            }
        )
        .filter("ends")
        .select(*parts, "seq", "head", "type1")
    )
    if sliced:
        spans = _join_pieces(spans, key)
    return _intervals(spans.select(*parts, "seq", "head.*", "type1"), key, sliced)


def _join_pieces(spans: DataFrame, key: str) -> DataFrame:
    """A version that runs on into later slices has a piece without a head there.

    A slice has one such piece at most, of the version that an earlier slice opened last; what is
    opened by an equal `seq` belongs to it as well. So only these pieces are moved; versions stay in
    their slices.
    """
    before = Window.partitionBy(key).orderBy("slice").rowsBetween(*_BEFORE)
    slices = spans.groupBy(key, "slice").agg(F.max("head.open_seq").alias("last_open"))
    carried = slices.select(key, "slice", F.max("last_open").over(before).alias("open_before"))
    rows = (
        spans.join(carried, [key, "slice"])
        .withColumn("open_seq", F.coalesce("head.open_seq", "open_before"))
        .groupBy(key, "slice", "open_seq")
        .agg(
            F.max("seq").alias("seq"),
            F.min_by("head", "seq").alias("head"),
            F.max_by("type1", "seq").alias("type1"),
            F.first("open_before").alias("open_before"),
        )
    )
    runs_on = F.col("open_seq").eqNullSafe(F.col("open_before"))
    ends = (
        rows.filter(runs_on)
        .withColumnRenamed("open_seq", "last_open")
        .groupBy(key, "last_open")
        .agg(F.max_by(F.struct("seq", "type1"), "seq").alias("end"))
    )
    # The slice in which such a version was opened has one row here.
    opened = slices.groupBy(key, "last_open").agg(F.min("slice").alias("slice"))
    found = rows.filter(~runs_on).join(opened.join(ends, [key, "last_open"]), [key, "slice"], "left")
    ended = F.col("open_seq") == F.col("last_open")
    return found.select(
        key,
        "slice",
        F.when(ended, F.col("end.seq")).otherwise(F.col("seq")).alias("seq"),
        "head",
        F.when(ended, F.col("end.type1")).otherwise(F.col("type1")).alias("type1"),
    )


def _intervals(spans: DataFrame, key: str, sliced: bool) -> DataFrame:
    """Number the versions of each life and close each at the next boundary."""
    in_order = Window.partitionBy(*_parts(key, sliced)).orderBy("seq")
    so_far = in_order.rowsBetween(*_SO_FAR)
    deleted = F.col("op") == "d"
    rows = (
        spans.withColumn("ts", F.max("ts").over(so_far))
        .withColumn("opens", F.sum(F.when(deleted, 0).otherwise(1)).over(so_far))
        .withColumn("seeded", F.max("start_version").over(so_far))
        .withColumn("next_ts", F.lead("ts").over(in_order))
        .withColumn(
            "at_delete", F.last(F.when(deleted, F.col("opens")), ignorenulls=True).over(so_far)
        )
    )
    if sliced:
        rows = (
            rows.join(_counts_before(rows, key), [key, "slice"])
            .withColumn("opens", F.col("opens") + F.col("opens_before"))
            .withColumn(
                "at_delete",
                F.coalesce(F.col("at_delete") + F.col("opens_before"), F.col("delete_before")),
            )
            .withColumn("seeded", F.coalesce("seeded", "seeded_before"))
            .withColumn("ts", F.greatest("ts", "ts_before"))
            .withColumn("next_ts", _not_before(F.coalesce("next_ts", "ts_after")))
        )
    first_life = F.col("opens") + F.coalesce(F.col("seeded"), F.lit(1)) - 1
    version = F.when(F.col("at_delete").isNull(), first_life).otherwise(
        F.col("opens") - F.col("at_delete")
    )
    return rows.filter(~deleted).select(
        key,
        "open_seq",
        version.cast("int").alias("version"),
        F.col("ts").alias("valid_from"),
        F.coalesce("next_ts", open_end()).alias("valid_to"),
        F.col("next_ts").isNull().alias("is_current"),
        "tracked",
        F.col("type1").dropFields("start_version").alias("type1"),
    )


def _not_before(ts: Column) -> Column:
    return F.when(ts.isNotNull(), F.greatest(ts, "ts_before"))


def _counts_before(rows: DataFrame, key: str) -> DataFrame:
    in_order = Window.partitionBy(key).orderBy("slice")
    before = in_order.rowsBetween(*_BEFORE)
    return (
        rows.groupBy(key, "slice")
        .agg(
            F.max("opens").alias("opens"),
            F.max("at_delete").alias("at_delete"),
            F.max("seeded").alias("seeded"),
            F.min_by("ts", "seq").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
        .withColumn("ts_before", F.max("last_ts").over(before))
        .withColumn("opens_before", F.coalesce(F.sum("opens").over(before), F.lit(0)))
        .withColumn("deleted_total", F.col("opens_before") + F.col("at_delete"))
        .select(
            key,
            "slice",
            "opens_before",
            F.max("deleted_total").over(before).alias("delete_before"),
            F.max("seeded").over(before).alias("seeded_before"),
            "ts_before",
            # Not before any time of this slice; those of earlier ones are put in by the caller.
            F.when(
                F.lead("first_ts").over(in_order).isNotNull(),
                F.greatest(F.lead("first_ts").over(in_order), "last_ts"),
            ).alias("ts_after"),
        )
    )


def by_address() -> Column:
    """The order of records: a key stays in one partition of its topic."""
    return F.struct("partition", "offset")


def customer_dimension(changes: DataFrame, **sizes) -> DataFrame:
    """Customer versions. Changes need `seq`, or `partition` and `offset`."""
    versions = fold(
        _in_order(changes), "customer_id", CUSTOMER_TRACKED, CUSTOMER_TYPE1, **sizes
    )
    return versions.withColumn(
        "customer_key", surrogate_key("customer", "customer_id", *_opened_by(versions))
    )


def product_dimension(changes: DataFrame, **sizes) -> DataFrame:
    """Product versions. Prices are compared as they are stored, with two decimals."""
    stored = _in_order(changes).withColumns({c: money(c) for c in PRODUCT_TRACKED})
    versions = fold(stored, "product_id", PRODUCT_TRACKED, PRODUCT_TYPE1, **sizes)
    return versions.withColumns(
        {
            "margin_percentage": margin("price", "cost"),
            "product_key": surrogate_key("product", "product_id", *_opened_by(versions)),
        }
    )


def _in_order(changes: DataFrame) -> DataFrame:
    return changes if "seq" in changes.columns else changes.withColumn("seq", by_address())


def _opened_by(versions: DataFrame) -> list[str]:
    """Fields of `open_seq` that name the opening record; `turn` is per batch only."""
    names = versions.schema["open_seq"].dataType.fieldNames()
    return [f"open_seq.{n}" for n in names if n != "turn"]


def apply_changes(
    current: DataFrame,
    changes: DataFrame,
    key: str,
    dimension,
    ended: DataFrame | None = None,
    **sizes,
) -> DataFrame:
    """Fold a batch onto stored current rows: all versions of the keys it touches.

    Each current row of a touched key enters as the first change of its key, so changes that
    are older than the stored state take effect no earlier than the current version. Rows of
    the result that are not current are complete and can be appended to history; the others
    replace the current rows of their keys.

    `ended` has the `ended_at` of keys that were deleted: they come back no earlier.
    """
    attributes = [c for c in changes.columns if c not in ("topic", "partition", "offset")]
    incoming = changes.select(
        *attributes,
        F.struct(F.lit(1).alias("turn"), "partition", "offset").alias("seq"),
        F.lit(None).cast("int").alias("start_version"),
    )
    stored = current.join(changes.select(key).distinct(), key, "left_semi")
    if ended is not None:
        incoming = (
            incoming.join(ended.select(key, "ended_at"), key, "left")
            .withColumn("ts", F.greatest("ts", "ended_at"))
            .drop("ended_at")
        )
    seeds = stored.select(
        F.lit("c").alias("op"),
        F.col("valid_from").alias("ts"),
        *[c for c in attributes if c not in ("op", "ts")],
        F.struct(
            F.lit(0).alias("turn"),
            F.col("open_partition").alias("partition"),
            F.col("open_offset").alias("offset"),
        ).alias("seq"),
        F.col("version").alias("start_version"),
    )
    return as_stored(dimension(seeds.unionByName(incoming), **sizes))


def as_stored(versions: DataFrame) -> DataFrame:
    """Versions with the address of the opening record in plain columns."""
    return versions.select(
        *[c for c in versions.columns if c != "open_seq"],
        F.col("open_seq.partition").alias("open_partition"),
        F.col("open_seq.offset").alias("open_offset"),
    )


def apply_to(
    versions: DataFrame, changes: DataFrame, key: str, dimension, **sizes
) -> DataFrame:
    """A whole stored dimension after one more batch."""
    current, closed = versions.filter("is_current"), versions.filter(~F.col("is_current"))
    touched = changes.select(key).distinct()
    ended = closed.join(touched, key, "left_semi").groupBy(key).agg(
        F.max("valid_to").alias("ended_at")
    )
    return closed.unionByName(current.join(touched, key, "left_anti")).unionByName(
        apply_changes(current, changes, key, dimension, ended, **sizes)
    )


def latest_type1(versions: DataFrame, key: str, type1: Sequence[str]) -> DataFrame:
    return versions.filter("is_current").select(key, *type1, "version")


def deleted_keys(versions: DataFrame, key: str) -> DataFrame:
    """Keys without a current version, and when they went."""
    return (
        versions.groupBy(key)
        .agg(
            F.bool_or("is_current").alias("live"),
            F.max("valid_to").alias("deleted_at"),
            F.count("*").alias("n_versions"),
        )
        .filter(~F.col("live"))
        .drop("live")
    )


def integrity(versions: DataFrame, key: str, **sizes) -> DataFrame:
    """Counts that show whether the versions of a dimension fit together.

    `broken` counts versions that end before they start, or do not start where the one
    before ends, or, for the first of a later life, that start before it.
    """
    rows = versions.select(
        key, "open_seq", "version", "is_current", F.struct("version", "valid_from", "valid_to").alias("v")
    )
    checked = by_key(
        rows, key, "open_seq", lambda r, sliced: _checked(r, key, sliced), **sizes
    )
    per_key = checked.groupBy(key).agg(
        F.count("*").alias("n"),
        F.count_if("is_current").alias("n_current"),
        F.count_if("is_broken").alias("n_broken"),
    )
    return per_key.agg(
        F.count("*").alias("keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("versions"),
        F.coalesce(F.sum("n_current"), F.lit(0)).alias("current_versions"),
        F.count_if(F.col("n_current") > 1).alias("keys_with_two_current"),
        F.coalesce(F.sum("n_broken"), F.lit(0)).alias("broken"),
    )


def _checked(rows: DataFrame, key: str, sliced: bool) -> DataFrame:
    linked = previous(rows, key, "open_seq", F.col("v"), "prev", sliced)
    fits = (
        F.when(F.col("prev").isNull(), F.col("version") >= 1)
        .when(
            F.col("version") > 1,
            (F.col("version") == F.col("prev.version") + 1)
            & (F.col("v.valid_from") == F.col("prev.valid_to")),
        )
        .otherwise(F.col("v.valid_from") >= F.col("prev.valid_to"))
    )
    runs = F.col("v.valid_from") <= F.col("v.valid_to")
    return linked.select(key, "is_current", (~(fits & runs)).alias("is_broken"))


def valid_at(versions: DataFrame, at) -> DataFrame:
    """The dimension as it stood at a point in time."""
    return versions.filter((F.col("valid_from") <= at) & (F.lit(at) < F.col("valid_to")))


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    counted: DataFrame | None = None,
    **sizes,
) -> DataFrame:
    """`rows` with `columns` of the version of their key valid at time `at`, else null.

    Rows and versions are merged in time order and each row takes the last version
    seen: linear in both sides, where an equi join with a range condition would compare
    every row of a key with every version of it. `counted` has the keys of `rows` from where they
    are read at little cost; hot keys are found there.
    """
    wanted = F.struct("valid_to", *columns)
    found = versions.select(wanted.alias("v")).schema["v"].dataType
    open_seq = versions.schema["open_seq"].dataType
    # Rows stay columns, so that those no one asks for later are not shuffled.
    own = {c: f"row {c}" for c in rows.columns if c != key}

    def position(time, side, seq):
        return F.struct(time.alias("time"), F.lit(side).alias("side"), seq.alias("seq"))

    timeline = versions.select(
        key,
        position(F.col("valid_from"), 0, F.col("open_seq")).alias("pos"),
        wanted.alias("version"),
        *[F.lit(None).cast(rows.schema[c].dataType).alias(name) for c, name in own.items()],
    ).unionByName(
        rows.select(
            key,
            position(F.col(at), 1, F.lit(None).cast(open_seq)).alias("pos"),
            F.lit(None).cast(found).alias("version"),
            *[F.col(c).alias(name) for c, name in own.items()],
        )
    )

    def match(part, sliced):
        seen = last_seen(part, key, "pos", F.col("version"), "seen", sliced)
        return seen.filter("pos.side = 1").select(
            key, F.col("pos.time").alias("at"), "seen", *own.values()
        )

    valid = F.col("at") < F.col("seen.valid_to")
    keys = (rows if counted is None else counted).select(key).unionByName(versions.select(key))
    matched = by_key(timeline, key, "pos", match, counted=keys, **sizes).select(
        *[F.col(own.get(c, c)).alias(c) for c in rows.columns],
        *[F.when(valid, F.col(f"seen.{c}")).alias(c) for c in columns],
    )
    keyless = rows.filter(F.col(key).isNull())
    return matched.unionByName(keyless, allowMissingColumns=True)
