"""A first copy of a table that goes on changing, read in chunks while its changes are captured.

Each chunk is read between two marks in the change log, the last position before the read and
one after it. A row of the chunk that changed between the marks may be read in either state, so
it is left out; its change is in the log with a whole image. All others stood as read at the
chunk's high mark and enter the log there, as snapshot reads, which a fold takes for keys that
are not live. No lock and no pause of the source is needed.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interleaved(reads: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Changes and the chunk rows that hold, as one log.

    `reads` has `low` and `high` marks, a time `ts` and the row; `changes` have `partition`,
    `offset`, `op`, `ts` and the row. Marks and offsets are positions of one log. A key is in one
    chunk, so each change meets one row at most, however often a key changes.
    """
    moved = changes.select(F.col(key).alias("of_key"), F.col("offset").alias("moved_at"))
    within = (
        (F.col(key) == F.col("of_key"))
        & (F.col("moved_at") > F.col("low"))
        & (F.col("moved_at") <= F.col("high"))
    )
    row = [c for c in changes.columns if c not in ("partition", "offset", "op")]
    held = reads.join(moved, within, "left_anti").select(
        F.lit(-1).alias("partition"), F.col("high").alias("offset"), F.lit("r").alias("op"), *row
    )
    log = changes.select("partition", "offset", "op", *row).unionByName(held)
    # Positions are of the whole log, so a read comes behind the changes up to its mark.
    return log.withColumn("seq", F.struct("offset", F.col("op") == "r"))
