"""Bounded bit maps over hashes, built by all tasks and merged in streams.

A map has a fixed number of bits, so it may be broadcast at any size of the data; with more
hashes than it was made for, it only tells fewer of them apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scdflow.sources.shared import staged

#: Powers of two: bits of a map at least and at most (16 MB), and of the pieces that are merged.
LEAST, MOST, PIECE = 16, 27, 20
#: Tasks whose pieces are merged at once, before the results are.
FAN = 64


def width(values: int, spare: int = 8) -> int:
    """Power of two for a map of so many values, `spare` bits each, as far as the bound goes."""
    return min(MOST, max(LEAST, (spare * max(1, values) - 1).bit_length()))


def cells(hashes: np.ndarray, power: int) -> np.ndarray:
    """The bit of each hash, from its highest bits."""
    return (hashes >> np.uint64(64 - power)).astype(np.int64)


def holds(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0


class Counted:
    """Which cells were met, and which more than once: a count-min row that stops at two."""

    def __init__(self, power: int):
        self.once = np.zeros(1 << (power - 3), np.uint8)
        self.more = np.zeros_like(self.once)

    def add(self, at: np.ndarray) -> None:
        met, count = np.unique(at, return_counts=True)
        _put(self.more, met[(count > 1) | holds(self.once, met)])
        _put(self.once, met)

    def merge(self, low: int, once: np.ndarray, more: np.ndarray) -> None:
        own = slice(low, low + len(once))
        self.more[own] |= more | (once & self.once[own])
        self.once[own] |= once


def _put(packed: np.ndarray, at: np.ndarray) -> None:
    """Sets bits at sorted places, each once."""
    if len(at):
        first = np.flatnonzero(np.diff(at >> 3, prepend=-1))
        ones = np.left_shift(np.uint8(1), (at & 7).astype(np.uint8))
        packed[at[first] >> 3] |= np.bitwise_or.reduceat(ones, first)


def counted(df: DataFrame, columns: list[str], power: int) -> tuple[np.ndarray, np.ndarray]:
    """Maps of the cells met and of those met more than once, a row a column of 64-bit hashes.

    A null is not counted. The maps are sent in pieces, merged by streams that hold one piece.
    """
    rows = range(len(columns))
    size = min(power, PIECE)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [Counted(power) for _ in rows]
        for batch in batches:
            for name, own in zip(columns, maps, strict=True):
                values = batch[name].drop_null().to_numpy(zero_copy_only=False)
                own.add(cells(values.view(np.uint64), power))
        step = 1 << (size - 3)
        for row, own in enumerate(maps):
            for piece, low in enumerate(range(0, len(own.once), step)):
                once, more = own.once[low : low + step], own.more[low : low + step]
                if once.any():
                    yield _row(row, piece, once, more)

    schema = "row int, piece int, once binary, more binary"

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if (r["row"], r["piece"]) != key:
                    if held is not None:
                        yield _row(*key, held.once, held.more)
                    key, held = (r["row"], r["piece"]), Counted(size)
                held.merge(0, np.frombuffer(r["once"], np.uint8), np.frombuffer(r["more"], np.uint8))
        if held is not None:
            yield _row(*key, held.once, held.more)

    partial = df.select(*columns).mapInArrow(build, schema)
    partial = partial.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(FAN)))
    by = "row", "piece"
    near = partial.repartition(*by, "part").sortWithinPartitions(*by, "part").drop("part")
    merged = near.mapInArrow(merge, schema).repartition(*by).sortWithinPartitions(*by)
    found = staged(merged.mapInArrow(merge, schema), "bits")
    once, more = np.zeros((2, len(columns), 1 << (power - 3)), np.uint8)
    # At most two maps a column.
    for r in found.toArrow().to_pylist():
        low = r["piece"] << (size - 3)
        own = slice(low, low + (1 << (size - 3)))
        once[r["row"], own] = np.frombuffer(r["once"], np.uint8)
        more[r["row"], own] = np.frombuffer(r["more"], np.uint8)
    return once, more


def _row(row: int, piece: int, once: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([row], pa.int32()),
            pa.array([piece], pa.int32()),
            pa.array([once.tobytes()], pa.binary()),
            pa.array([more.tobytes()], pa.binary()),
        ],
        ["row", "piece", "once", "more"],
    )
