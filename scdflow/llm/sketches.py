"""MinHash near-duplicates by fast similarity sketching (Dahlgaard, Knudsen and Thorup, 2017).

Sketch: in round i each shingle of a set is hashed anew, to a bin and a value that is larger in
later rounds; a bin keeps its smallest value. After `BINS` rounds of random bins, round `BINS + j`
puts all shingles into bin j, so no bin stays empty; a set is done as soon as all are filled,
which takes a large one few rounds. Two sets agree in a bin with the chance of their similarity,
and the share of bins has concentration bounds as with independent hashes.

Banding: sets that agree in all `ROWS` bins of a band share a bucket. Two that reach the
similarity of 0.8 share none of 32 with a chance below 1e-7. Equal sets are one node before.

Verification on full sets, without the pairs of a bucket: every member is held against the
bucket's hub, its smallest node, in tiles of bounded size that are dealt over all tasks, so a
large group is as many tiles as it needs. What was linked is one component. Buckets whose other
members are of several components are then searched exactly: members outside the largest
component against all of them, tile by tile. A tile returns links that connect what it found,
one for a text at most.

A null text, or one without words, has an empty set and is linked with nothing. Fewer words than
a shingle are one shingle. Repeated rows have the same component. A null doc_id is not a
component's id unless it has no other. An empty table gives no rows. Other columns are not read.
A long text is one row of a tile, so a task holds a few tens of times its size. Ties: of equal
sets, the smallest doc_id stands for all. Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scdflow.sources.shared import staged

from . import bits, words
from .components import components

SHINGLE = 4
#: Similarity, in percent, of linked sets.
NEAR = 80
#: Bins of a sketch, and bins of a band.
BINS, ROWS = 128, 4
#: Shingles of the members of a tile, and of those they are held against.
TILE, HELD = 200_000, 50_000
#: Shingles that a task verifies at once, in whole tiles.
GATHERED = 500_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: What a round adds before it mixes.
_ADDED = np.arange(1, 2 * 4096 + 1, dtype=np.uint64) * _STEP


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted in each, and where each text's begin."""
    split = words.split(texts)
    starts, sizes = split.starts, np.diff(split.starts)
    own = split.hashes()[split.codes] if len(split.codes) else np.empty(0, np.uint64)
    places = np.where(sizes >= shingle, sizes - shingle + 1, np.minimum(sizes, 1))
    firsts = np.cumsum(places) - places
    row = np.repeat(np.arange(len(sizes)), places)
    at = np.arange(places.sum()) - np.repeat(firsts - starts[:-1], places)
    length = np.minimum(sizes, shingle)[row]
    found = words.mixed(own[at]) if len(at) else np.empty(0, np.uint64)
    for k in range(1, shingle):
        longer = length > k
        found[longer] = words.chained(found[longer], own[at[longer] + k])
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    found, row = found[new], row[new]
    return found, np.searchsorted(row, np.arange(len(sizes) + 1))


def sketch(sets: np.ndarray, starts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """A row of `bins` values for each set; those of an empty set are all ones."""
    sizes = np.diff(starts)
    table = np.full((len(sizes), bins), ~np.uint64(0))
    flat = table.reshape(-1)
    row = np.repeat(np.arange(len(sizes)), sizes)
    open_sets = sizes > 0
    for i in range(2 * bins):
        if not len(row):
            break
        drawn = words.mixed(sets + _ADDED[i])
        if i < bins:
            to = (drawn >> np.uint64(32)) % np.uint64(bins)
        else:
            to = np.full(len(row), i - bins, np.uint64)
        value = (np.uint64(i) << np.uint64(32)) | (drawn & np.uint64(0xFFFFFFFF))
        np.minimum.at(flat, row * bins + to.astype(np.int64), value)
        open_sets &= (table == ~np.uint64(0)).any(axis=1)
        left = open_sets[row]
        sets, row = sets[left], row[left]
    return table


def banded(table: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A hash of each band of each sketch."""
    bands = table.shape[1] // rows
    found = np.broadcast_to(words.mixed(np.arange(1, bands + 1, dtype=np.uint64)), (len(table), bands))
    for k in range(rows):
        found = words.chained(found, table[:, k : bands * rows : rows])
    return found


def sketched(
    docs: DataFrame, shingle: int = SHINGLE, bins: int = BINS, rows: int = ROWS
) -> DataFrame:
    """`doc_id`, `text_hash`, `n_shingles`, `node` (of the set; null for an empty one), `bands`."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.sliced(batches):
            sets, starts = shingle_sets(batch["text"], shingle)
            sizes = np.diff(starts)
            so_far = np.concatenate([[np.uint64(0)], np.cumsum(words.mixed(sets ^ _STEP))])
            total = so_far[starts[1:]] - so_far[starts[:-1]]
            node = words.chained(total, sizes.astype(np.uint64)).view(np.int64)
            bands = banded(sketch(sets, starts, bins), rows)
            offsets = np.arange(len(sizes) + 1, dtype=np.int32) * bands.shape[1]
            listed = pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(bands.reshape(-1).view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_hash"],
                    pa.array(sizes.astype(np.int64)),
                    pa.array(node, mask=sizes == 0),
                    listed,
                ],
                ["doc_id", "text_hash", "n_shingles", "node", "bands"],
            )

    return _narrow(docs).mapInArrow(
        make, "doc_id long, text_hash long, n_shingles long, node long, bands array<long>"
    )


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    near: int = NEAR,
    bins: int = BINS,
    rows: int = ROWS,
    tile: int = TILE,
    held: int = HELD,
) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id`, `kept` of each document."""
    read = staged(sketched(docs, shingle, bins, rows), "sketches")
    full = read.filter(F.col("node").isNotNull())
    again = full.groupBy("node", "doc_id", "text_hash", "n_shingles").agg(F.count("*").alias("n_rows"))
    nodes = again.groupBy("node").agg(
        F.min(F.struct("doc_id", "text_hash", "n_rows", "n_shingles")).alias("one"),
        F.min("doc_id").alias("first_id"),
    )
    nodes = staged(nodes.select("node", "first_id", "one.*"), "nodes")
    buckets = staged(_buckets(full), "buckets")
    source = _narrow(docs)

    def verified(placed: DataFrame) -> DataFrame:
        return staged(_links(source, nodes, placed, shingle, near), "verified")

    links = verified(_stars(buckets, nodes, tile))
    linked = components(links)
    others = staged(_unsettled(buckets, linked), "unsettled")
    if not others.isEmpty():
        links = links.unionAll(verified(_tiles(others, nodes, tile, held)))
        linked = components(links)
    rooted = nodes.join(linked, "node", "left").select(
        "node", "first_id", F.coalesce("root", "node").alias("root")
    )
    rooted = staged(rooted, "roots")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(least, "root").select("node", "component_id")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        read.select("doc_id", "n_shingles", "node")
        .join(classes, "node", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
        )
    )


def _buckets(full: DataFrame) -> DataFrame:
    """`(band, node, hub)` of the bands that several nodes share; the hub is the smallest."""
    # Equal sets have equal bands; the first row of a node will do.
    once = full.groupBy("node").agg(F.first("bands").alias("bands"))
    bands = staged(once.select(F.explode("bands").alias("band"), "node"), "bands")
    shared = bands.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("top"))
    return bands.join(shared.filter("hub <> top").drop("top"), "band")


def _stars(buckets: DataFrame, nodes: DataFrame, tile: int) -> DataFrame:
    """Every member of a bucket with its hub: `(tile, held, node)`."""
    pairs = buckets.filter("node <> hub").select("hub", "node").distinct()
    sized = pairs.join(nodes.select("node", "n_shingles"), "node")
    hubs = sized.groupBy("hub").agg(_blocks("n_shingles", tile).alias("blocks"))
    members = pairs.join(hubs, "hub").select(
        F.xxhash64("hub", _block("node", F.col("blocks"))).alias("tile"),
        F.lit(False).alias("held"),
        "node",
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    centres = hubs.select("hub", every.alias("block")).select(
        F.xxhash64("hub", "block").alias("tile"), F.lit(True).alias("held"), F.col("hub").alias("node")
    )
    return members.unionAll(centres)


def _blocks(size: str, limit: int):
    return F.greatest(F.lit(1), F.ceil(F.sum(size) / limit)).cast("long")


def _block(node: str, blocks):
    return F.pmod(F.xxhash64(node, F.lit(1)), blocks)


def _unsettled(buckets: DataFrame, linked: DataFrame) -> DataFrame:
    """`(band, node, root)` of buckets whose members but the hub are of several components; of
    buckets with the same members, one."""
    rooted = (
        buckets.filter("node <> hub")
        .join(linked, "node", "left")
        .select("band", "node", F.coalesce("root", "node").alias("root"))
    )
    several = (
        rooted.groupBy("band")
        .agg(
            F.min("root").alias("low"),
            F.max("root").alias("high"),
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("node")).alias("sign"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("sign2"),
        )
        .filter("low <> high")
    )
    once = several.groupBy("n", "sign", "sign2").agg(F.min("band").alias("band"))
    return rooted.join(once.select("band"), "band", "left_semi")


def _tiles(others: DataFrame, nodes: DataFrame, tile: int, held: int) -> DataFrame:
    """Members outside a bucket's largest component with all its members."""
    sized = others.join(nodes.select("node", "n_shingles"), "node")
    by_root = sized.groupBy("band", "root").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")
    )
    plan = by_root.groupBy("band").agg(
        F.max_by("root", F.struct("n", "root")).alias("largest"),
        F.sum("shingles").alias("every"),
        F.max(F.struct("n", "root", "shingles")).alias("most"),
    )
    plan = plan.select(
        "band",
        "largest",
        F.greatest(F.lit(1), F.ceil(F.col("every") / tile)).cast("long").alias("across"),
        F.greatest(F.lit(1), F.ceil((F.col("every") - F.col("most.shingles")) / held))
        .cast("long")
        .alias("down"),
    )
    placed = others.join(plan, "band")
    zero = F.lit(0).cast("long")

    def to(down, across, side):
        return F.xxhash64("band", down, across).alias("tile"), F.lit(side).alias("held"), "node"

    rights = placed.withColumn("i", F.explode(F.sequence(zero, F.col("down") - 1)))
    rights = rights.select(*to("i", _block("node", F.col("across")), False))
    lefts = placed.filter("root <> largest")
    lefts = lefts.withColumn("j", F.explode(F.sequence(zero, F.col("across") - 1)))
    return rights.unionAll(lefts.select(*to(_block("node", F.col("down")), "j", True)))


def _links(
    source: DataFrame, nodes: DataFrame, placed: DataFrame, shingle: int, near: int
) -> DataFrame:
    """Verified links `(a, b)` of those held in a tile with its other nodes."""
    placed = staged(placed, "tiles")
    members = placed.select("node").distinct().join(
        nodes.select("node", "doc_id", "text_hash", "n_rows"), "node"
    )
    members = staged(members, "members")
    needed = _only(source, members)
    found = (F.col("doc_id").eqNullSafe(F.col("of_id"))) & (F.col("text_hash") == F.col("of_hash"))
    keys = members.withColumnsRenamed({"doc_id": "of_id", "text_hash": "of_hash"})
    own = needed.join(keys.filter("n_rows = 1"), found).select("node", "text")
    # Rows that come more than once are few; only they are shuffled to drop the rest of them.
    again = needed.join(keys.filter("n_rows > 1"), found).select("node", "text")
    texts = own.unionAll(again.dropDuplicates(["node"]))
    dealt = texts.join(placed, "node").repartition("tile").sortWithinPartitions("tile", "held")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tiles in _whole_tiles(batches):
            yield _verified(tiles, shingle, near)

    return dealt.select("tile", "held", "node", "text").mapInArrow(verify, "a long, b long")


def _only(source: DataFrame, members: DataFrame) -> DataFrame:
    """Rows whose key may be that of a member: a map of bounded size keeps others from a shuffle."""
    power = bits.width(members.count(), 32)
    key = F.xxhash64(F.coalesce("doc_id", F.lit(0)), "text_hash").alias("key")
    once, _ = bits.counted(members.select(key), ["key"], power)
    shared = source.sparkSession.sparkContext.broadcast(once)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = bits.cells(batch["key"].to_numpy().view(np.uint64), power)
            rows = batch.filter(pa.array(bits.holds(shared.value[0], at)))
            yield rows.select(["doc_id", "text_hash", "text"])

    kinds = "doc_id long, text_hash long, text string"
    return source.select("*", key).mapInArrow(keep, kinds)


def _whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, cut between tiles where enough have come."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        tiles = batch["tile"].to_numpy()
        ends = np.append(np.flatnonzero(np.diff(tiles)) + 1, len(tiles))
        lengths = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy().astype(np.int64)
        so_far = np.concatenate([[0], np.cumsum(lengths)])
        start = 0
        if held and len(tiles) and held[-1]["tile"][-1].as_py() != tiles[0] and size >= GATHERED * 6:
            yield _joined(held)
            held, size = [], 0
        for end in ends[:-1]:
            if size + so_far[end] - so_far[start] >= GATHERED * 6:
                held.append(batch.slice(start, end - start))
                yield _joined(held)
                held, size, start = [], 0, end
        if start < len(tiles):
            held.append(batch.slice(start))
            size += so_far[-1] - so_far[start]
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _verified(rows: pa.RecordBatch, shingle: int, near: int) -> pa.RecordBatch:
    """Links in each tile, none between what others have connected there."""
    sets, starts = shingle_sets(rows["text"], shingle)
    sizes = np.diff(starts)
    codes = np.unique(sets, return_inverse=True)[1].reshape(-1)
    tiles, held = rows["tile"].to_numpy(), rows["held"].to_numpy(zero_copy_only=False)
    nodes = rows["node"].to_numpy()
    mask = np.zeros(codes.max(initial=-1) + 1, bool)
    out: list[tuple[int, int]] = []
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(tiles)) + 1, [len(tiles)]])
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        cut = low + int((~held[low:high]).sum())
        if cut in (low, high):
            continue
        # Equal nodes are one component from the start.
        label = np.unique(nodes[low:high], return_inverse=True)[1].reshape(-1)
        rights = codes[starts[low] : starts[cut]]
        at = starts[low:cut] - starts[low]
        for i in range(cut, high):
            own = codes[starts[i] : starts[i + 1]]
            mask[own] = True
            shared = np.add.reduceat(mask[rights], at, dtype=np.int64)
            mask[own] = False
            union = sizes[low:cut] + sizes[i] - shared
            linked = np.flatnonzero(100 * shared >= near * union)
            new = linked[label[linked] != label[i - low]]
            if len(new):
                _, one = np.unique(label[new], return_index=True)
                out += [(int(nodes[i]), int(nodes[low + j])) for j in new[one]]
                label[np.isin(label, label[new])] = label[i - low]
    a, b = zip(*out, strict=True) if out else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
