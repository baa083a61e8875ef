"""Ranges of offsets against sets."""

import random

import pytest

from scdflow.operators import ranges, skew

pytestmark = pytest.mark.usefixtures("interpreted")

SCHEMA = "topic string, partition int, offset bigint"
SIZES = {"hot_rows": 10, "slice_rows": 7}


def runs(offsets):
    found = []
    for at in sorted(set(offsets)):
        if found and at == found[-1][1] + 1:
            found[-1][1] = at
        else:
            found.append([at, at])
    return [tuple(r) for r in found]


def of(rows):
    return sorted((r["topic"], r["partition"], r["first"], r["last"]) for r in rows.collect())


def some(rng, n, most):
    return [(rng.choice("ab"), rng.randrange(2), rng.randrange(most)) for _ in range(n)]


@pytest.mark.parametrize("sizes", [{}, SIZES])
@pytest.mark.parametrize("block", [1, 5, 1 << 16])
def test_islands(spark, sizes, block):
    rows = some(random.Random(block), 150, 120)
    want = []
    for topic, partition in {r[:2] for r in rows}:
        own = runs(o for t, p, o in rows if (t, p) == (topic, partition))
        want += [(topic, partition, a, b) for a, b in own]
    got = ranges.islands(spark.createDataFrame(rows, SCHEMA), block, **sizes)
    assert of(got) == sorted(want)


@pytest.mark.parametrize("sizes", [{}, SIZES])
def test_merged_ranges_may_overlap(spark, sizes):
    rng = random.Random(4)
    rows = [("a", 0, a, a + rng.randrange(9)) for a in (rng.randrange(300) for _ in range(60))]
    want = runs(x for _, _, a, b in rows for x in range(a, b + 1))
    got = ranges.merged(spark.createDataFrame(rows, ranges.RANGE), **sizes)
    assert [(a, b) for _, _, a, b in of(got)] == want


@pytest.mark.parametrize("sizes", [{}, SIZES])
def test_uncovered(spark, sizes):
    rng = random.Random(5)
    known, asked = some(rng, 100, 90), some(rng, 200, 120)
    held = ranges.islands(spark.createDataFrame(known, SCHEMA), **sizes)
    got = ranges.uncovered(spark.createDataFrame(asked, SCHEMA), held, **sizes)
    assert sorted(map(tuple, got.collect())) == sorted(r for r in asked if r not in set(known))
    none = spark.createDataFrame([], ranges.RANGE)
    assert ranges.uncovered(spark.createDataFrame(asked, SCHEMA), none).count() == len(asked)


def test_neighbours_of_many_batches_are_one_range(spark):
    rows = spark.createDataFrame([("t", 0, i) for i in range(1000)], SCHEMA)
    held = spark.createDataFrame([], ranges.RANGE)
    for part in range(4):
        held = ranges.merged(held.unionByName(ranges.islands(rows.filter(f"offset % 4 = {part}"))))
    assert of(held) == [("t", 0, 0, 999)]


def test_only_ranges_at_the_ends_of_blocks_are_merged_over_blocks(spark, monkeypatch):
    """Offsets with gaps are as many ranges as records; those within a block need no second look."""
    taken = []

    def by_key(df, *given, **sizes):
        taken.append(df.count())
        return skew.by_key(df, *given, **sizes)

    monkeypatch.setattr(ranges, "by_key", by_key)
    offsets = [3 * i for i in range(200)] + [599, 601, 1199, 1201]
    rows = spark.createDataFrame([("t", 0, o) for o in offsets], SCHEMA)
    assert [(a, b) for _, _, a, b in of(ranges.islands(rows, 100))] == runs(offsets)
    # 0, 99, 300, 399, 599 and 1199.
    assert taken == [6]


def test_blocks_of_offsets_beyond_a_double(spark):
    base = 1 << 60
    offsets = [base - 2, base - 1, base, base + 65535, base + 65536, base + 131073]
    rows = spark.createDataFrame([("t", 0, o) for o in offsets], SCHEMA)
    assert [(a, b) for _, _, a, b in of(ranges.islands(rows))] == runs(offsets)
    long = spark.createDataFrame([("t", 0, base, base + 3_000_000)], ranges.RANGE)
    merged = ranges.merged(long.unionByName(ranges.islands(rows)), 64)
    assert [(a, b) for _, _, a, b in of(merged)] == [(base - 2, base + 3_000_000)]


def test_rows_without_an_offset_stay(spark):
    rows = spark.createDataFrame([("t", 0, None), ("t", 0, 4), (None, None, 4), ("t", 0, None)], SCHEMA)
    got = {tuple(r) for r in ranges.islands(rows).collect()}
    assert got == {("t", 0, None, None), ("t", 0, 4, 4), (None, None, 4, 4)}
    missing = ranges.uncovered(rows, ranges.islands(rows))
    assert [tuple(r) for r in missing.collect()] == [("t", 0, None)] * 2
