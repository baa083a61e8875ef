"""SimHash near-duplicates: 64-bit fingerprints linked within a few bits by vantage-point trees.

A fingerprint's bit is set if it is set in over half the XXH64 values (seed 42) of the text's
word shingles. Only distinct fingerprints are searched; equal ones are one node.

A vantage-point tree cuts the fingerprints by their distance to chosen ones. Its top, built from
a bounded sample, deals all fingerprints to shards; each task goes on with the tree in its own
shards. A fingerprint outside a ball but within `bits` of its boundary goes to both sides, for
by the triangle inequality no link can reach further: so each link lies in some leaf, whose
pairs are all compared. A shard returns a spanning forest, one link a fingerprint at most, never
the pairs of a dense group.

A null text has no shingles, like an empty one: fingerprint zero, linked like any other.
Repeated rows get the same fingerprint and component; a null doc_id is not a component's id
unless it has no other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scdflow.sources.shared import staged

from . import words
from .components import components

SHINGLE = 3
BITS = 2
#: Fingerprints from which the top of the tree is built, at least and at most: 16 MB.
LEAST_TOP, SAMPLE = 8192, 1 << 21
#: Fingerprints of a shard, as far as the sample tells.
SHARD = 50_000
#: Fingerprints that a task deals at once.
GATHERED = 1_000_000
#: Fingerprints of a leaf, all of whose pairs are compared.
LEAF = 512
#: Sample a leaf of the top keeps at least, and candidates for a vantage point.
LEAST_SAMPLE, CANDIDATES = 32, 12


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """`docs` with their 64-bit `fingerprint` (a long that holds the unsigned bits).

    Words as in `words.split`; a text of fewer words is one shingle, one of none has zero.
    A column `fingerprint` of the documents is replaced.
    """
    rest = [f for f in docs.schema.fields if f.name != "fingerprint"]
    schema = T.StructType([*rest, T.StructField("fingerprint", T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.sliced(batches, text):
            prints = [_fingerprint(t, shingle) for t in batch[text].to_pylist()]
            made = pa.array(np.array(prints, np.uint64).view(np.int64))
            names = [f.name for f in rest]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), made], [*names, "fingerprint"]
            )

    return docs.select([f.name for f in rest]).mapInArrow(add, schema)


def _fingerprint(text: str | None, shingle: int) -> int:
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[shingle - 1 :].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=False)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        some = np.array(hashes[at : at + 8192], ">u8")
        bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    over = np.packbits(2 * ones > len(hashes))
    return int(over.view(">u8")[0])


def groups(prints: DataFrame, bits: int = BITS, shard: int = SHARD) -> DataFrame:
    """`(fingerprint, root, component_id)`: the component's least fingerprint and its smallest
    doc_id, for each distinct fingerprint."""
    nodes = staged(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "fingerprints"
    )
    linked = components(links(nodes.select("fingerprint"), bits, shard))
    rooted = staged(
        nodes.join(
            linked.select(F.col("node").alias("fingerprint"), "root"), "fingerprint", "left"
        ).select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")),
        "roots",
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("fingerprint", "root", "component_id")


def representatives(
    docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE, shard: int = SHARD
) -> DataFrame:
    """One document of each component, the one with the smallest doc_id; all columns kept.

    Of rows with that doc_id in the component, any one stays.
    """
    key = [F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_hash")]
    rows = docs.select(*key, "doc_id", "text")
    prints = staged(fingerprints(rows, shingle).drop("text"), "prints")
    judged = prints.join(groups(prints, bits, shard), "fingerprint").filter(
        F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
    kept = staged(judged.select("own_id", "own_hash", "root"), "kept")
    one = kept.groupBy("root").agg(
        F.min(F.struct("own_id", "own_hash")).alias("own"), F.count("*").alias("n")
    )
    one = staged(one.select("root", "own.own_id", "own.own_hash", "n"), "one")
    names = docs.columns
    numbered = docs.toDF(*(f"c{i}" for i in range(len(names))))
    ids, texts = (F.col(f"c{names.index(c)}") for c in ("doc_id", "text"))
    found = ids.eqNullSafe(F.col("own_id")) & (F.xxhash64(texts) == F.col("own_hash"))
    # Rows that come more than once are few; only they are shuffled to drop the rest of them.
    again = numbered.join(one.filter("n > 1"), found).dropDuplicates(["root"])
    single = numbered.join(one.filter("n = 1"), found, "left_semi")
    rows = single.unionAll(again.select(single.columns))
    return rows.toDF(*names)


def links(prints: DataFrame, bits: int = BITS, shard: int = SHARD) -> DataFrame:
    """Links `(a, b)` that connect what differs in `bits` or fewer; `prints` are distinct."""
    context = prints.sparkSession.sparkContext
    count = prints.count()
    shards = max(1, math.ceil(count / shard))
    top = context.broadcast(_top(_sampled(prints, count, shards), shards, bits))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in _gathered(batches):
            leaves = list(_dealt(top.value, values, bits))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([n for n, _ in leaves], [len(p) for _, p in leaves])),
                    pa.array(np.concatenate([p for _, p in leaves]).view(np.int64)),
                ],
                ["shard", "fingerprint"],
            )

    def search(table: pa.Table) -> pa.Table:
        values = table["fingerprint"].to_numpy().view(np.uint64)
        child, parent = _forest(np.sort(values), bits)
        return pa.table({"a": child.view(np.int64), "b": parent.view(np.int64)})

    dealt = prints.mapInArrow(deal, "shard long, fingerprint long")
    return dealt.groupBy("shard").applyInArrow(search, "a long, b long")


def _sampled(prints: DataFrame, count: int, shards: int) -> np.ndarray:
    """Enough fingerprints for a tree of so many shards, `SAMPLE` at most or about."""
    if shards == 1:
        return np.empty(0, np.uint64)
    share = min(1.0, min(SAMPLE, max(LEAST_TOP, 2 * LEAST_SAMPLE * shards)) / count)
    # The hash is as good as random, and the same in every run.
    chosen = F.pmod(F.xxhash64("fingerprint"), F.lit(1 << 30)) < share * (1 << 30)
    rows = prints.select("fingerprint").filter(chosen).toArrow()
    return np.sort(rows["fingerprint"].to_numpy().view(np.uint64))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Fingerprints, many at once: dealing them costs a step for each shard."""
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(batch["fingerprint"].to_numpy(zero_copy_only=False).view(np.uint64))
        if sum(map(len, held)) >= GATHERED:
            yield np.concatenate(held)
            held = []
    if sum(map(len, held)):
        yield np.concatenate(held)


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def _cut(values: np.ndarray, sample: np.ndarray, bits: int) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that put the fewest on both sides; None if nothing is gained."""
    best = None
    for point in values[:: max(1, len(values) // CANDIDATES)][:CANDIDATES]:
        away = _distance(sample, point)
        for radius in np.unique(np.quantile(away, [0.3, 0.5, 0.7]).astype(int)):
            inside, outside = (away <= radius + bits).sum(), (away > radius).sum()
            worst = max(inside, outside)
            if worst <= 0.8 * len(sample) and (best is None or worst < best[0]):
                best = worst, point, int(radius)
    return best[1:] if best else None


def _top(sample: np.ndarray, shards: int, bits: int) -> tuple | int:
    """Nested (point, radius, inside, outside); a number is a shard."""
    numbers = iter(range(1 << 30))
    least = max(LEAST_SAMPLE, len(sample) // max(1, shards))

    def build(part: np.ndarray) -> tuple | int:
        cut = _cut(part, part, bits) if len(part) > least else None
        if cut is None:
            return next(numbers)
        away = _distance(part, cut[0])
        # Those dealt to both sides count once here, else the sample would grow with the depth.
        return (*cut, build(part[away <= cut[1]]), build(part[away > cut[1]]))

    return build(sample)


def _dealt(tree: tuple | int, values: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    if not len(values):
        return
    if isinstance(tree, int):
        yield tree, values
        return
    point, radius, inside, outside = tree
    away = _distance(values, point)
    yield from _dealt(inside, values[away <= radius + bits], bits)
    yield from _dealt(outside, values[away > radius], bits)


def _forest(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of sorted `values`, found leaf by leaf."""
    root = np.arange(len(values))
    todo = [np.arange(len(values))]
    while todo:
        at = todo.pop()
        cut = None
        if len(at) > LEAF:
            # A bounded look at the part is enough to choose a point; all of it is cut.
            cut = _cut(values[at], values[at[:: max(1, len(at) // 4096)]], bits)
        if cut is not None:
            away = _distance(values[at], cut[0])
            inside, outside = at[away <= cut[1] + bits], at[away > cut[1]]
            if max(len(inside), len(outside)) < 0.9 * len(at):
                todo += [inside, outside]
                continue
        _join_leaf(values, at, bits, root)
    ends = _roots(root, np.arange(len(root)))
    moved = np.flatnonzero(ends != np.arange(len(root)))
    return values[moved], values[ends[moved]]


def _join_leaf(values: np.ndarray, at: np.ndarray, bits: int, root: np.ndarray) -> None:
    """Compares all pairs of a leaf, in blocks of rows, and joins the trees of those linked."""
    low, step = 0, 16
    while low < len(at):
        rows = at[low : low + step]
        near = _distance(values[rows][:, None], values[at][None, :]) <= bits
        i, j = np.nonzero(near)
        a, b = _roots(root, rows[i]), _roots(root, at[j])
        # Once a few rows of a dense group are joined, the rest of its pairs are no news.
        pairs = np.stack([np.minimum(a, b), np.maximum(a, b)])[:, a != b]
        news = np.unique(pairs, axis=1)
        for x, y in news.T.tolist():
            x, y = _root(root, x), _root(root, y)
            root[max(x, y)] = min(x, y)
        low += step
        step = min(2 * step, max(1, 2_000_000 // len(at)))


def _root(root: np.ndarray, i: int) -> int:
    while root[i] != i:
        root[i] = root[root[i]]
        i = root[i]
    return i


def _roots(root: np.ndarray, at: np.ndarray) -> np.ndarray:
    up = root[at]
    while True:
        above = root[up]
        if np.array_equal(above, up):
            return up
        up = above
