"""Offsets as ranges: which records of a topic partition were applied.

A partition's offsets are kept as `(topic, partition, first, last)`, neighbours merged, so what is
kept grows with the gaps between them and not with the records. Ranges are cut at the ends of
blocks of offsets, and a block is put in order by itself: one shuffle, and no task holds a whole
partition. Only ranges that touch an end of their block are then merged over blocks; where even
these are very many, they are cut into slices like any hot key (`skew`).
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scdflow.operators.skew import by_key, largest_before, last_seen
from scdflow.sources.shared import staged

RANGE = "topic string, partition int, first bigint, last bigint"
#: Offsets that are put in order together at most.
BLOCK = 1 << 16
#: Blocks that a range is cut into at once.
_AT_ONCE = 1 << 10
#: Places are few, so one is dealt out long before it would be a hot key elsewhere.
PLACE_ROWS = 250_000
_SIZES = {"hot_rows": PLACE_ROWS, "slice_rows": PLACE_ROWS}


def _block(offset: str, size: int) -> Column:
    """The first offset of the block: whole numbers, as offsets may be too large for a double."""
    return F.col(offset) - F.pmod(F.col(offset), F.lit(size).cast("bigint"))


def _pieces(ranges: DataFrame, size: int) -> DataFrame:
    """Ranges cut at the ends of blocks of offsets, with the `block` each piece is in."""
    cut = ranges.select("topic", "partition", "first", "last")
    # A very long range is cut into few parts first, so no array of its blocks is long.
    for step in (size * _AT_ONCE, size):
        every = F.lit(step).cast("bigint")
        blocks = F.explode_outer(F.sequence(_block("first", step), _block("last", step), every))
        cut = cut.select("topic", "partition", "first", "last", blocks.alias("block")).select(
            "topic",
            "partition",
            F.greatest("first", "block").alias("first"),
            F.least("last", F.col("block") + every - 1).alias("last"),
            "block",
        )
    return cut


def singles(records: DataFrame) -> DataFrame:
    """Each record as a range of one offset."""
    return records.select("topic", "partition", F.col("offset").alias("first"), F.col("offset").alias("last"))


def islands(records: DataFrame, block: int = BLOCK, **sizes) -> DataFrame:
    """The ranges of the offsets of some records; an offset may come several times."""
    return merged(singles(records), block, **sizes)


def merged(ranges: DataFrame, block: int = BLOCK, **sizes) -> DataFrame:
    """Ranges that overlap or follow each other without a gap as one.

    Blocks are the slices of a place. What they leave is written, as the ranges that touch the ends
    of blocks are counted and dealt out by samples of them.
    """
    # The block goes first: rows are told apart by it, and rarely by their topic.
    own = Window.partitionBy("block", "partition", "topic").orderBy("first")
    reached = F.max("last").over(own.rowsBetween(Window.unboundedPreceding, -1))
    so_far = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = (
        _pieces(ranges, block)
        .withColumn("reached", reached)
        .withColumn("opened", F.max(_opens()).over(so_far))
        .groupBy("block", "partition", "topic", "opened")
        .agg(F.max("last").alias("last"))
    )
    touches = (F.col("opened") == F.col("block")) | (F.col("last") == F.col("block") + block - 1)
    kept = staged(
        runs.select(
            "topic",
            "partition",
            F.col("opened").alias("first"),
            "last",
            F.coalesce(touches, F.lit(False)).alias("touches"),
        ),
        "slices",
    )
    inside = kept.filter(~F.col("touches")).drop("touches")
    return inside.unionByName(_over_blocks(kept.filter("touches").drop("touches"), sizes))


def _opens() -> Column:
    """The offset at which a row begins a range that nothing ahead of it reaches."""
    return F.when(F.col("reached").isNull() | (F.col("first") > F.col("reached") + 1), F.col("first"))


def _over_blocks(ranges: DataFrame, sizes: dict) -> DataFrame:
    keyed = ranges.select(F.struct("topic", "partition").alias("place"), "first", "last")

    def join(rows: DataFrame, sliced: bool) -> DataFrame:
        reached = largest_before(rows, "place", "first", F.col("last"), "reached", sliced)
        opened = reached.withColumn("opens", _opens())
        return last_seen(opened, "place", "first", F.col("opens"), "opened", sliced).select(
            "place", "opened", "last"
        )

    return (
        by_key(keyed, "place", "first", join, **_SIZES | sizes)
        .groupBy("place", "opened")
        .agg(F.max("last").alias("last"))
        .select("place.*", F.col("opened").alias("first"), "last")
    )


def covered(records: DataFrame, ranges: DataFrame, **sizes) -> DataFrame:
    """Records whose offset is in one of the ranges, which must not overlap."""
    return uncovered(records, ranges, inside=True, **sizes)


def uncovered(
    records: DataFrame, ranges: DataFrame, inside: bool = False, block: int = BLOCK, **sizes
) -> DataFrame:
    """Records whose offset is in none of the ranges, or with `inside` in one of them; ranges must
    not overlap.

    Records and ranges are merged in order, block by block, and each record takes the last range
    that begins at or before it: linear in both, where a join on a range compares all pairs of a
    partition. A block with very many records, one delivered over and over, is cut into slices.
    """
    whole = records.select(F.struct(*records.columns).alias("row")).schema["row"].dataType

    def place(start: Column) -> Column:
        return F.struct(start.alias("block"), "partition", "topic").alias("place")

    def at(offset: str, side: int):
        return F.struct(F.col(offset).alias("offset"), F.lit(side).alias("side")).alias("at")

    line = (
        _pieces(ranges, block)
        .select(place(F.col("block")), at("first", 0), F.lit(None).cast(whole).alias("row"), "last")
        .unionByName(
            records.select(
                place(_block("offset", block)),
                at("offset", 1),
                F.struct(*records.columns).alias("row"),
                F.lit(None).cast("bigint").alias("last"),
            )
        )
    )

    def match(rows: DataFrame, sliced: bool) -> DataFrame:
        seen = last_seen(rows, "place", "at", F.col("last"), "until", sliced)
        return seen.filter(F.col("row").isNotNull()).select("row", "until")

    found = by_key(line, "place", "at", match, **_SIZES | sizes)
    beyond = F.col("until").isNull() | (F.col("until") < F.col("row.offset"))
    return found.filter(~beyond if inside else beyond).select("row.*")
