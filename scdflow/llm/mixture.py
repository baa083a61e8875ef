"""Mixing sources to target weights: whole copies, and Pareto order sampling for the rest.

A source's documents share its target of words: each is taken `floor(target / size)` times for
certain; one more copy is drawn without replacement. Pareto order sampling (Rosen, 1997) ranks
the documents by random odds over inclusion odds, u / (1 - u) over p / (1 - p), with a random u
that is a hash of doc_id and `seed`; the first ones are taken, as many as fill the target best.
A document's p is its `odds`, its size unless others are given, scaled so that the words expected
are those that are left of the target; at most `CERTAIN`, where it comes first as good as always.

No source is ranked as a whole. Ranks fall into bins; sums by bin, added up before the shuffle,
show the bin in which a source's target is met, and only that bin's documents are put in order.
The cut of each source then decides each document by itself.

Sources are those of the `source` column, a null one too, in order of code points with null
last. A null or empty text has size 0, is not drawn and is taken 0 words. A source whose documents have no
words has target 0. Rows of the same doc_id and size in a source share a rank: they are taken
or left together. Reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scdflow.sources.shared import staged


#: Most copies of a document, and so of a source's size, that a mix takes.
MOST = 3
#: Weights of the sources, in order, repeating.
WEIGHTS = (1, 2, 3)
#: Largest chance of a document to be drawn.
CERTAIN = 0.99
#: Odds are added up exactly, so that reruns agree.
ODDS = "decimal(20,6)"
#: Bins of ranks a source.
BINS = 1 << 14
SEED = "mix"
#: A word: what stands between space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, odds: Column | None = None) -> DataFrame:
    """`(doc_id, source, size, odds)`: what the mix needs of each document, written once."""
    chosen = size() if odds is None else odds
    return staged(
        docs.select("doc_id", "source", size().alias("size"), chosen.cast(ODDS).alias("odds")), "sizes"
    )


def size(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """`(source, source_size, target, even)`: each source's share of all words by weight, and
    the odds of its words on average.

    A target stops at `most` times the source's size; the excess goes to the others by weight,
    again and again. That fills all sources to one level (words for a unit of weight) or their
    stop: sources in order of stop over weight, the level is what is left over the weight left,
    where it is first below the next source's. One row a source is sorted, no documents.
    """
    both = (F.col("odds") * F.col("size")).cast("decimal(38,6)")
    per_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(both).cast("double").alias("every")
    )
    per_source = per_source.withColumn(
        "even", F.when(F.col("every") > 0, F.col("every") / F.col("source_size")).otherwise(1.0)
    ).drop("every")
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    place = F.row_number().over(by_name) - 1
    listed = F.array(*(F.lit(float(w)) for w in weights))
    stop = F.col("source_size") * F.lit(most)
    rows = per_source.withColumn(
        "weight", F.element_at(listed, (place % len(weights) + 1).cast("int"))
    ).withColumn("stop", stop.cast("double"))
    order = [F.col("stop") / F.col("weight"), F.col("source").isNull(), F.col("source")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = rows.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(before), F.lit(0.0)))
        / F.sum("weight").over(rest),
    )
    below = F.col("level") * F.col("weight") <= F.col("stop")
    level = F.min(F.when(below, F.struct(*order, F.col("level")))).over(everything)["level"]
    return levels.select(
        "source",
        "source_size",
        F.least("stop", level * F.col("weight")).alias("target"),
        "even",
    )


def cuts(sized: DataFrame, aims: DataFrame, bins: int = BINS, seed: str = SEED) -> DataFrame:
    """`aims` with `copies` for certain and the last rank taken once more: `cut`, `cut_id`.

    Of the two documents at which the target is passed, the cut is after the one that comes
    nearer to it.
    """
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plans = aims.withColumn("copies", F.floor(ratio)).withColumn(
        "wanted", F.col("target") - F.col("copies") * F.col("source_size")
    )
    plans = staged(plans.withColumn("share", ratio - F.col("copies")), "plans")
    ranked = ranks(sized, plans, seed).filter("share > 0 AND size > 0").withColumn(
        "bin", F.floor(F.col("rank") * bins)
    )
    sums = ranked.groupBy("source", "wanted", "bin").agg(F.sum("size").alias("words"))
    so_far = Window.partitionBy("source").orderBy("bin")
    ended = sums.withColumn("ended", F.sum("words").over(so_far))
    # The first bin that reaches what is wanted; the sums of all bins do.
    last = (
        ended.filter(F.col("ended") >= F.col("wanted"))
        .groupBy("source")
        .agg(
            F.min("bin").alias("bin"),
            F.min_by(F.col("ended") - F.col("words"), "bin").alias("before"),
        )
        .withColumnRenamed("source", "in_source")
    )
    last = staged(last, "bins")
    inside = (
        ranked.withColumnRenamed("bin", "own_bin")
        .join(last, F.col("source").eqNullSafe(F.col("in_source")) & F.expr("own_bin = bin"))
        .groupBy("source", "wanted", "before", "rank", "doc_id")
        .agg(F.sum("size").alias("words"))
    )
    ordered = Window.partitionBy("source").orderBy("rank", "doc_id")
    taken = inside.withColumn("taken", F.col("before") + F.sum("words").over(ordered))
    off = F.abs(F.col("taken") - F.col("wanted"))
    # Nothing of the bin may be nearer still than its first document.
    nearest = taken.groupBy("source").agg(
        F.min(F.struct(off.alias("off"), "rank", "doc_id")).alias("nearest"),
        F.min(F.struct("rank", "doc_id")).alias("first"),
        F.first(F.abs(F.col("before") - F.col("wanted"))).alias("off_before"),
    )
    found = nearest.select(
        F.col("source").alias("in_source"),
        F.when(F.col("off_before") <= F.col("nearest.off"), F.lit(True)).otherwise(False).alias("none"),
        F.when(F.col("off_before") <= F.col("nearest.off"), F.col("first.rank"))
        .otherwise(F.col("nearest.rank"))
        .alias("cut"),
        F.when(F.col("off_before") <= F.col("nearest.off"), F.col("first.doc_id"))
        .otherwise(F.col("nearest.doc_id"))
        .alias("cut_id"),
    )
    return staged(
        plans.join(found, F.col("source").eqNullSafe(F.col("in_source")), "left").drop("in_source"),
        "cuts",
    )


def ranks(sized: DataFrame, plans: DataFrame, seed: str = SEED) -> DataFrame:
    """`sized` with its source's plan and `rank`, a rising function of the Pareto rank, below 1."""
    plan = plans.withColumnRenamed("source", "in_source")
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("in_source")), "left")
    return joined.drop("in_source").withColumn("rank", rank(seed))


def rank(seed: str = SEED) -> Column:
    """From `doc_id`, `share`, `odds` and `even`: q / (1 + q) of the odds' ratio q."""
    # 52 bits of a digest, moved off 0 and 1.
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    u = (bits + 0.5) / float(1 << 52)
    p = F.least(F.col("share") * F.col("odds").cast("double") / F.col("even"), F.lit(CERTAIN))
    return u * (1 - p) / (u * (1 - p) + (1 - u) * p)


def taken_copies() -> Column:
    """How often a document is taken, from its plan, cut and rank."""
    # A null doc_id sorts first, as in the window that made the cut.
    tie = F.col("cut_id").isNotNull() & (
        F.col("doc_id").isNull() | (F.col("doc_id") <= F.col("cut_id"))
    ) | (F.col("cut_id").isNull() & F.col("doc_id").isNull())
    upto = (F.col("rank") < F.col("cut")) | (
        (F.col("rank") == F.col("cut")) & tie & ~F.col("none")
    )
    drawn = (F.col("share") > 0) & (F.col("size") > 0) & upto
    return F.col("copies") + F.when(drawn, 1).otherwise(0)


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    odds: Column | None = None,
    seed: str = SEED,
) -> DataFrame:
    """`(doc_id, source, size, source_size, target, copies)` of all documents."""
    sized = sizes(docs, odds)
    planned = cuts(sized, targets(sized, weights, most), seed=seed)
    return ranks(sized, planned, seed).select(
        "doc_id", "source", "size", "source_size", "target", taken_copies().alias("copies")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    odds: Column | None = None,
    seed: str = SEED,
) -> DataFrame:
    """The documents that the mix takes, as often as it takes them; all columns kept."""
    sized = sizes(docs, odds)
    planned = cuts(sized, targets(sized, weights, most), seed=seed)
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = docs.select("*", (size() if odds is None else odds).cast(ODDS).alias("odds of it"))
    rows = own.toDF(*names, "odds").withColumns(
        {
            "doc_id": F.col(names[docs.columns.index("doc_id")]),
            "source": F.col(names[docs.columns.index("source")]),
            "size": size(names[docs.columns.index("text")]),
        }
    )
    decided = ranks(rows, planned, seed).withColumn("n", taken_copies())
    # A document without words adds none; it stays as often as its source's certain copies.
    copies = F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))
    return decided.filter("n > 0").select(*names, copies.alias("copy")).drop("copy").toDF(*docs.columns)
