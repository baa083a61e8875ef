"""Connected components of links, in rounds of joins and pre-aggregated groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scdflow.sources.shared import staged


def components(links: DataFrame) -> DataFrame:
    """`(node, root)` for each node of `links(a, b)`, root the smallest node it reaches.

    Large-star and small-star rounds (Kiveris et al., 2014): every node points to its smallest
    neighbour until all point to a root, in a number of rounds that grows with the logarithm of
    the largest component. Each round is written to the shared folder. A node with very many
    links is a hot join key on one side only, which Spark splits.
    """
    links = staged(_pairs(links.select("a", "b")), "links")
    known = _sign(links)
    while True:
        links = staged(_small_star(_large_star(links)), "links")
        before, known = known, _sign(links)
        if known == before:
            break
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = nodes.select(F.col("root").alias("node"), "root").distinct()
    return nodes.unionAll(roots)


def _sign(links: DataFrame) -> tuple:
    """Tells sets of links apart, by their number and 128 bits; they are not shuffled for it."""
    one, other = F.xxhash64("a", "b"), F.xxhash64("b", "a", F.lit(1))
    return tuple(links.agg(F.count("*"), F.bit_xor(one), F.bit_xor(other)).first())


def _pairs(links: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller."""
    return (
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to its smallest neighbour, or to itself."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    joined = both.filter("b > a").join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    itself = least.select("a", F.col("m").alias("b"))
    return joined.unionAll(itself).filter("a <> b").distinct()
