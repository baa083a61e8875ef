"""Conversation prefix trie: what many conversations share from their first turn on.

A node is a distinct sequence of first turns (role and text), from the root without any; its
members are the conversations that begin with it. A prefix's digest is the exclusive or of 128
bits for each of its turns, hashed with their place, so a window or an aggregate finds it.

Count-min screening: all prefixes are counted in two rows of cells that stop at two, a map of
bounded size. An estimate of one proves that a prefix has a single member, and so has all below
it. Such tails are emitted where they are, never shuffled; only prefixes that may be shared, and
the first node of each tail, are grouped exactly. With more prefixes than the map was made for,
more are grouped; the result is the same.

No recursion over depths: a node is represented by its smallest member, whose other nodes from
there down it represents as well, so each conversation represents the end of its own path. Sums
over a subtree are then sums over the members of what they represent, less what the node's own
representative has above it.

A conversation of more than `HOT` turns is cut into slices of its order, and totals are carried
from slice to slice. Ends of a node that many conversations share are sorted over all tasks and
joined there; only the digest over the joined text, which has to read it in order, is one
stream a node, in bounded memory.

Rows without a `conv_id` belong to no conversation and are left out. A null turn comes first;
turns of the same number, repeated ones too, come in the order of their hashes. A null role or
text is an empty one. An empty table has no nodes. Other columns are not read. Prefixes are told
apart by 128 bits of hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scdflow.sources.shared import staged

from . import bits

#: Conversations with the same tens digit pair share the first turns of the first of them.
GROUP, LEADS = 20, 4
#: Rows of a key above which it is cut, and of a slice.
HOT, SLICE = 1_000_000, 250_000
#: Bytes of joined ends in a row.
CHUNK = 1 << 16
NOTHING = hashlib.sha256(b"").hexdigest()
_NODE = ["depth", "p1", "p2"]


def turns(conversations: DataFrame) -> DataFrame:
    """`(conv_id, turn, d1, d2, n_words)`, two hashes for role and text of each turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("d1"),
        F.xxhash64(F.lit(1), text, role).alias("d2"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"),
    )


def ranked(rows: DataFrame, hot: int = HOT, cut: int = SLICE) -> tuple[DataFrame, bool]:
    """`rows` of turns with their `depth` in the conversation, from 1, and a `slice`; and whether
    any conversation is cut."""
    order = ["turn", "d1", "d2"]
    sliced, several = _sliced(rows, order, hot, cut)
    one = F.lit(1).cast("long")
    return _running(sliced, order, {"depth": ("sum", one)}, several), several


def shared_leads(rows: DataFrame, group: int = GROUP, leads: int = LEADS) -> DataFrame:
    """Turns of conversations rebuilt: the first h turns of the first conversation of the group,
    then their own from the h-th on; h is the CRC-32 of the id, modulo `leads`.

    `conv_id`, `slice`, `depth`, `d1`, `d2`, `n_words`, `last` (the depth of the last turn); a
    conversation without turns is one row of depth 0.
    """
    rows = rows.select("conv_id", "slice", "depth", "d1", "d2", "n_words")
    first = F.col("conv_id") - F.col("conv_id") % group
    led = (
        rows.filter((F.col("conv_id") == first) & (F.col("depth") < leads))
        .groupBy(F.col("conv_id").alias("lead_id"))
        .agg(F.sort_array(F.collect_list(F.struct("depth", "d1", "d2", "n_words"))).alias("lead"))
    )
    h = F.crc32(F.col("conv_id").cast("string")) % leads
    plans = (
        rows.groupBy("conv_id")
        .agg(F.max("depth").alias("own"))
        .select("conv_id", "own", h.cast("int").alias("h"), first.alias("lead_id"))
        .join(led, "lead_id", "left")
        .withColumn("lead", F.coalesce("lead", F.array().cast(led.schema["lead"].dataType)))
        .withColumn("lead", F.slice("lead", 1, F.col("h")))
        .withColumn("moved", F.size("lead") - F.col("h"))
        .withColumn("last", F.size("lead") + F.greatest(F.lit(0), F.col("own") - F.col("h")))
    )
    plans = staged(plans.drop("own", "lead_id"), "plans")
    heads = plans.select("conv_id", F.lit(0).alias("slice"), F.inline("lead"), "last")
    own = rows.join(plans.select("conv_id", "h", "moved", "last"), "conv_id")
    own = own.filter(F.col("depth") > F.col("h")).withColumn("depth", F.col("depth") + F.col("moved"))
    empty = plans.filter("last = 0").select(
        "conv_id",
        F.lit(0).alias("slice"),
        *(F.lit(0).cast("long").alias(c) for c in ("depth", "d1", "d2", "n_words")),
        "last",
    )
    return heads.unionByName(own.select(*heads.columns)).unionByName(empty)


def prefixes(rebuilt: DataFrame, several: bool) -> DataFrame:
    """A row for each conversation and prefix of it, the empty one too: its digest `(p1, p2)`,
    that of its parent `(q1, q2)`, and whether the conversation ends there."""
    place = F.col("depth") > 0
    own = {
        "x1": F.when(place, F.xxhash64("depth", "d1", "d2")).otherwise(F.lit(0)),
        "x2": F.when(place, F.xxhash64("d2", "depth", "d1", F.lit(2))).otherwise(F.lit(0)),
    }
    found = _running(
        rebuilt.withColumns(own),
        ["depth"],
        {"p1": ("bit_xor", F.col("x1")), "p2": ("bit_xor", F.col("x2"))},
        several,
    )
    found = found.select(
        "conv_id",
        "depth",
        "p1",
        "p2",
        F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"),
        F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"),
        "n_words",
        (F.col("depth") == F.col("last")).alias("ends"),
    )
    zero = F.lit(0).cast("long")
    # The first turn's row makes the row of the root.
    roots = found.filter("depth = 1").select(
        "conv_id",
        *(zero.alias(c) for c in ("depth", "p1", "p2", "q1", "q2", "n_words")),
        F.lit(False).alias("ends"),
    )
    return found.unionByName(roots)


def nodes(conversations: DataFrame, hot: int = HOT, cut: int = SLICE) -> DataFrame:
    """The trie of rebuilt conversations, a row a node, as in `trie`."""
    read = staged(turns(conversations), "turns")
    numbered, several = ranked(read, hot, cut)
    return trie(prefixes(shared_leads(numbered), several), hot, cut)


def trie(paths: DataFrame, hot: int = HOT, cut: int = SLICE) -> DataFrame:
    """`conv_id`, `depth`, `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`,
    `saved_tokens`, `ends_sha256` of each node of `prefixes`."""
    paths = staged(paths, "prefixes")
    screened = staged(screen(paths), "screened")
    alone = F.col("single") & F.col("parent_single")
    kept, tails = screened.filter(~alone), screened.filter(alone)
    last = F.when(F.col("ends"), F.col("conv_id"))
    grouped = kept.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("q1").alias("q1"),
        F.min("q2").alias("q2"),
        F.min("n_words").alias("n_words"),
        F.count(last).alias("n_ends"),
        F.min(last).alias("first_end"),
    )
    grouped = staged(grouped, "nodes")
    inner = _with_children(grouped)
    value = (F.col("n_convs") - 1) * F.col("n_words")
    inner = staged(inner.withColumn("value", value), "inner")
    sums = _subtrees(kept, inner, tails)
    sliced, several = _sliced(inner, ["depth"], hot, cut)
    above = _running(sliced, ["depth"], {"so_far": ("sum", F.col("value"))}, several)
    above = above.select(*_NODE, (F.col("so_far") - F.col("value")).alias("above"))
    joined = _ends(kept, inner)
    one = F.sha2(F.col("first_end").cast("string"), 256)
    shared = (
        inner.join(sums, _NODE)
        .join(above, _NODE)
        .join(joined, _NODE, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("total") - F.col("above")).alias("saved_tokens"),
            F.when(F.col("n_ends") == 0, F.lit(NOTHING))
            .when(F.col("n_ends") == 1, one)
            .otherwise(F.col("ends_sha256"))
            .alias("ends_sha256"),
        )
    )
    own = F.sha2(F.col("conv_id").cast("string"), 256)
    return shared.unionByName(
        tails.select(
            "conv_id",
            "depth",
            F.col("conv_id").alias("parent_conv_id"),
            F.lit(1).cast("long").alias("n_convs"),
            F.when(F.col("ends"), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("n_children"),
            F.lit(1).cast("long").alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"),
            F.when(F.col("ends"), own).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
        )
    )


def screen(paths: DataFrame, power: int | None = None) -> DataFrame:
    """`paths` with `single` and `parent_single`: the prefix is proven to have one member."""
    power = bits.width(paths.count()) if power is None else power
    _, more = bits.counted(paths, ["p1", "p2"], power)
    shared = paths.sparkSession.sparkContext.broadcast(more)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deep = batch["depth"].to_numpy()
            flags = []
            for names, least in ((("p1", "p2"), 1), (("q1", "q2"), 2)):
                both = np.ones(len(deep), bool)
                for row, name in enumerate(names):
                    at = bits.cells(batch[name].to_numpy().view(np.uint64), power)
                    both &= bits.holds(shared.value[row], at)
                flags.append(pa.array(~both & (deep >= least)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *flags], names_out)

    names_out = [*paths.columns, "single", "parent_single"]
    schema = ", ".join(f"{n} {t}" for n, t in paths.dtypes)
    return paths.mapInArrow(look, f"{schema}, single boolean, parent_single boolean")


def _with_children(grouped: DataFrame) -> DataFrame:
    """Nodes with their number of children, and their parent's representative."""
    children = grouped.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")
    )
    of_parent = grouped.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("p1").alias("q1"),
        F.col("p2").alias("q2"),
        F.col("conv_id").alias("of_parent"),
    )
    # Children of a node with one member may be in its tail: the ends tell whether there is one.
    alone = F.when(F.col("n_ends") > 0, F.lit(0)).otherwise(F.lit(1)).cast("long")
    return (
        grouped.join(children.agg(F.count("*").alias("found")), _NODE, "left")
        .join(of_parent, ["depth", "q1", "q2"], "left")
        .withColumn(
            "n_children",
            F.when(F.col("n_convs") == 1, alone).otherwise(F.coalesce("found", F.lit(0).cast("long"))),
        )
        .withColumn(
            "parent_conv_id", F.when(F.col("depth") > 0, F.coalesce("of_parent", "conv_id"))
        )
        .drop("found", "of_parent", "q1", "q2")
    )


def _subtrees(kept: DataFrame, inner: DataFrame, tails: DataFrame) -> DataFrame:
    """Leaves below each node, and the value of all that its members represent."""
    zero, one = (F.lit(x).cast("long") for x in (0, 1))
    leaf = F.when(F.col("n_children") == 0, one).otherwise(zero)
    ends = tails.filter("ends").select("conv_id", one.alias("leaf"), zero.alias("value"))
    held = inner.select("conv_id", leaf.alias("leaf"), "value").unionByName(ends)
    held = held.groupBy("conv_id").agg(F.sum("leaf").alias("leaf"), F.sum("value").alias("value"))
    return (
        kept.select(*_NODE, "conv_id")
        .join(held, "conv_id", "left")
        .groupBy(*_NODE)
        .agg(
            F.coalesce(F.sum("leaf"), zero).alias("n_leaves"),
            F.coalesce(F.sum("value"), zero).alias("total"),
        )
    )


def _ends(kept: DataFrame, inner: DataFrame) -> DataFrame:
    """The digest of the ids that end at a node, where there are several."""
    several = inner.filter("n_ends > 1").select(*_NODE)
    rows = kept.filter("ends").select(*_NODE, "conv_id").join(several, _NODE, "left_semi")
    dealt = rows.repartitionByRange(*_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id")
    chunks = dealt.mapInArrow(_chunks, "depth long, p1 long, p2 long, first long, ids string")
    in_order = chunks.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
    return in_order.mapInArrow(_hashed, "depth long, p1 long, p2 long, ends_sha256 string")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a node in order, comma-joined, in rows of bounded size."""
    node, ids, size = None, [], 0

    def row() -> pa.RecordBatch:
        values = [*node, ids[0], ",".join(map(str, ids))]
        return pa.RecordBatch.from_arrays(
            [pa.array([v]) for v in values], [*_NODE, "first", "ids"]
        )

    for batch in batches:
        for depth, p1, p2, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if node != (depth, p1, p2) or size > CHUNK:
                if ids:
                    yield row()
                node, ids, size = (depth, p1, p2), [], 0
            ids.append(conv_id)
            size += 8
    if ids:
        yield row()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v]) for v in (*node, digest.hexdigest())], [*_NODE, "ends_sha256"]
        )

    for batch in batches:
        for depth, p1, p2, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if node == (depth, p1, p2):
                digest.update(b"," + ids.encode())
                continue
            if node is not None:
                yield row()
            node, digest = (depth, p1, p2), hashlib.sha256(ids.encode())
    if node is not None:
        yield row()


def _sliced(rows: DataFrame, order: list[str], hot: int, cut: int) -> tuple[DataFrame, bool]:
    """`rows` with a `slice`: 0, or a range of the order of a conversation of very many rows; and
    whether there is such a conversation."""
    counts = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    most = counts.agg(F.max("n")).first()[0]
    if most is None or most <= hot:
        return rows.withColumn("slice", F.lit(0)), False
    large = staged(counts.filter(F.col("n") > hot), "hot")
    slices = max(2, math.ceil(large.agg(F.sum("n")).first()[0] / cut))
    ranges = rows.join(large, "conv_id", "left_semi").repartitionByRange(slices, "conv_id", *order)
    numbered = staged(ranges.withColumn("slice", F.spark_partition_id() + 1), "slices")
    others = rows.join(large, "conv_id", "left_anti").withColumn("slice", F.lit(0))
    return others.unionByName(numbered), True


def _running(
    rows: DataFrame, order: list[str], totals: dict[str, tuple[str, Column]], several: bool
) -> DataFrame:
    """Running totals (`sum` or `bit_xor`) of a conversation, carried from slice to slice where
    there are `several`."""
    given = {f"_{name}": value for name, (_, value) in totals.items()}
    rows = rows.withColumns(given)
    local = Window.partitionBy("conv_id", "slice").orderBy(*order)
    local = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("conv_id").orderBy("slice")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    whole = {n: F.expr(f"{kind}(_{n})") for n, (kind, _) in totals.items()}
    found = rows.withColumns({n: e.over(local) for n, e in whole.items()}).drop(*given)
    if not several:
        return found
    slices = (
        rows.groupBy("conv_id", "slice")
        .agg(*(e.alias(f"_{n}") for n, e in whole.items()))
        .withColumns({f"before_{n}": F.expr(f"{kind}(_{n})").over(earlier) for n, (kind, _) in totals.items()})
    )
    slices = slices.select("conv_id", "slice", *(f"before_{n}" for n in totals))
    found = found.join(slices, ["conv_id", "slice"], "left")
    added = {}
    for n, (kind, _) in totals.items():
        before = F.coalesce(f"before_{n}", F.lit(0).cast("long"))
        added[n] = F.col(n) + before if kind == "sum" else F.col(n).bitwiseXOR(before)
    return found.withColumns(added).drop(*(f"before_{n}" for n in totals))
