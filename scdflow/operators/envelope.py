"""Change envelopes: JSON text to operation and row image.

A value is parsed once, into a VARIANT, because an absent key and a null value mean
different things here and a typed parse would merge them.

    outcome   meaning
    change    has an operation and a row image
    tombstone no value
    skipped   nothing to do: empty image, or a change of a kind the topic ignores
    failed    the value is not an envelope; see error_type and error_message
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdflow.schemas import (
    CUSTOMER_IMAGE,
    CUSTOMERS,
    ORDER_IMAGE,
    ORDER_ITEM_IMAGE,
    ORDER_ITEMS,
    ORDERS,
    PRODUCT_IMAGE,
    PRODUCTS,
)

_IMAGES = {
    CUSTOMERS: CUSTOMER_IMAGE,
    PRODUCTS: PRODUCT_IMAGE,
    ORDERS: ORDER_IMAGE,
    ORDER_ITEMS: ORDER_ITEM_IMAGE,
}


_IDS = ["customer_id", "product_id", "order_item_id", "order_id"]
#: As much of an image as tells that it is an object, and a row.
_SEEN = "struct<" + ",".join(f"{name}:variant" for name in _IDS) + ">"
_GIVEN = {
    CUSTOMERS: "email",
    PRODUCTS: "price cost",
    ORDERS: "order_id",
    ORDER_ITEMS: "unit_price line_total",
}


def part(document, name: str) -> Column:
    """A field as VARIANT: null if the key is absent, a variant null if it is null."""
    return F.try_variant_get(document, f"$.{name}", "variant")


def parts(document, names: str) -> Column:
    """Several fields as VARIANT in one look; null if the document is not an object."""
    fields = ",".join(f"{name}:variant" for name in names.split())
    return F.try_variant_get(document, "$", f"struct<{fields}>")


def _nothing(variant: Column) -> Column:
    return variant.isNull() | F.is_variant_null(variant)


def _is_object(variant: Column) -> Column:
    return F.coalesce(F.schema_of_variant(variant).startswith("OBJECT"), F.lit(False))


def _is_empty(variant: Column) -> Column:
    """Absent, null, {}, [], "", 0 or false."""
    kind = F.schema_of_variant(variant)
    plain = F.try_variant_get(variant, "$", "string")
    return (
        _nothing(variant)
        | kind.isin("OBJECT<>", "ARRAY<VOID>")
        | (~kind.startswith("OBJECT") & ~kind.startswith("ARRAY") & plain.isin("", "0", "false"))
    )


def _computed(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed here, once.

    The columns below build on one another several levels deep. A filter or projection
    merged through them would copy the whole tree at every mention, parsing included;
    neither is merged through a generator.
    """
    return rows.select(
        "*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    )


def decode(records: DataFrame) -> DataFrame:
    """Parse each value once: adds `document` and what kind of value it is."""
    start = F.substring(F.ltrim("value", F.lit(" \t\r\n")), 1, 1)
    kind = (
        F.when(F.col("value").isNull(), "tombstone")
        .when(F.col("document").isNull(), "malformed")
        .when(F.is_variant_null("document"), "tombstone")
        .when(start == "{", "object")
        .when(start.isin("[", '"'), "sequence")
        .otherwise("scalar")
    )
    return _computed(records, document=F.try_parse_json("value")).withColumn("kind", kind)


def normalize(records: DataFrame) -> DataFrame:
    """Operation, row image and outcome of each record.

    A part of a VARIANT is a copy of it. Images are seen by their ids; one is only taken out where
    it has none, and at the end where it is wanted. Wrapped and bare envelopes are seen in one look:
    a path that leads nowhere costs far more than a field that is not there.
    """
    items = F.col("topic") == ORDER_ITEMS
    looks = f"op:variant,before:{_SEEN},after:{_SEEN}"
    look = F.try_variant_get("document", "$", f"struct<payload:struct<{looks}>,{looks}>")
    seen = _computed(decode(records), seen=look)
    payload = F.try_variant_get("document", "$", "struct<op:variant,payload:variant>")["payload"]
    there = F.when(F.col("seen.payload").isNotNull(), True).otherwise(payload.isNotNull())
    bare = F.when(F.col("seen").isNotNull(), F.struct("seen.op", "seen.before", "seen.after"))
    opened = _computed(
        _computed(seen, wrapped=there),
        body=F.when(F.col("wrapped"), F.col("seen.payload")).otherwise(bare),
    )

    def side(name: str) -> Column:
        return F.when(F.col("wrapped"), part("document", f"payload.{name}")).otherwise(
            part("document", name)
        )

    def missing(name: str) -> Column:
        return F.when(F.col(f"body.{name}").isNotNull(), False).otherwise(_nothing(side(name)))

    op = (
        F.when(F.col("wrapped") & F.col("body.op").isNull(), "c")
        .when(F.col("wrapped"), F.try_variant_get("body.op", "$", "string"))
        .when(missing("after"), "d")
        .when(missing("before"), "c")
        .otherwise("u")
    )
    read = _computed(opened, read_op=op)
    deleted = F.col("read_op").eqNullSafe("d") & ~items

    def has_id(name: str) -> Column:
        return F.coalesce(*[F.col(f"body.{name}.{i}") for i in _IDS]).isNotNull()

    # A row of a known table is seen by its id; any other image needs a closer look.
    chosen = _computed(
        read,
        deleted=deleted,
        is_row=F.when(deleted, has_id("before")).otherwise(has_id("after")),
        ignored=items & ~F.col("read_op").eqNullSafe("c"),
    )
    image = F.when(F.col("deleted"), side("before")).otherwise(side("after"))
    judged = _computed(
        _computed(chosen, other=F.when(~F.col("is_row"), image)),
        idle=F.col("ignored") | (~F.col("is_row") & _is_empty(F.col("other"))),
        is_object=F.col("is_row") | _is_object(F.col("other")),
    )
    error = (
        F.when(F.col("kind") == "malformed", _error("JSONDecodeError", "value is not JSON"))
        .when(F.col("kind") == "scalar", _error("TypeError", "envelope is a plain value"))
        .when(F.col("kind") == "sequence", _error("AttributeError", "envelope is not an object"))
        .when(
            (F.col("kind") == "object") & F.col("wrapped") & F.col("body").isNull(),
            _error("AttributeError", "payload is not an object"),
        )
        .when(
            (F.col("kind") == "object") & ~F.col("idle") & ~F.col("is_object"),
            _error("AttributeError", "row image is not an object"),
        )
    )
    outcome = (
        F.when(F.col("kind") == "tombstone", "tombstone")
        .when(error.isNotNull(), "failed")
        .when(F.col("idle"), "skipped")
        .otherwise("change")
    )
    decided = F.col("outcome").isin("change", "skipped")
    return _computed(judged, outcome=outcome).select(
        *records.columns,
        F.coalesce("wrapped", F.lit(False)).alias("wrapped"),
        F.when(decided, F.col("read_op")).alias("op"),
        F.when(F.col("outcome") == "change", image).alias("image"),
        "outcome",
        F.when(F.col("outcome") == "failed", error["error_type"]).alias("error_type"),
        F.when(F.col("outcome") == "failed", error["error_message"]).alias("error_message"),
    )


def _error(kind: str, message: str) -> Column:
    return F.struct(F.lit(kind).alias("error_type"), F.lit(message).alias("error_message"))


def changes_of(normalized: DataFrame, topic: str) -> DataFrame:
    """Effective changes of one topic with their image as typed columns.

    `given` holds the fields for which absent, null and wrongly typed differ, as VARIANT.
    """
    fields = [field.split() for field in _IMAGES[topic].split(",")]
    image = "struct<" + ",".join(f"{name}:{kind}" for name, kind in fields) + ">"
    rows = _computed(
        normalized.filter((F.col("topic") == topic) & (F.col("outcome") == "change")),
        row=F.try_variant_get("image", "$", image),
        given=parts("image", _GIVEN[topic]),
    )
    return rows.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("ts"),
        "value",
        "op",
        "given",
        "row.*",
    )


def tombstones(records: DataFrame) -> DataFrame:
    """Records without a value, per topic and partition, beside all records.

    A value that is the JSON `null` is none either, as in `decode`.
    """
    none = F.col("value").isNull() | (F.trim("value", F.lit(" \t\r\n")) == "null")
    return records.groupBy("topic", "partition").agg(
        F.count("*").alias("records"), F.count_if(none).alias("tombstones")
    )


def route_counts(normalized: DataFrame) -> DataFrame:
    """Records per topic and outcome; `handled` tells if the topic feeds the warehouse."""
    return (
        normalized.groupBy("topic", "outcome")
        .agg(F.count("*").alias("records"))
        .withColumn("handled", F.col("topic").isin(CUSTOMERS, PRODUCTS, ORDER_ITEMS))
    )


def op_counts(normalized: DataFrame) -> DataFrame:
    """Operations per topic, of records that are envelopes."""
    return (
        normalized.filter(F.col("outcome").isin("change", "skipped"))
        .groupBy("topic", "op")
        .agg(F.count("*").alias("records"))
    )
