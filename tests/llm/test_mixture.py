import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from scdflow.llm import mixture

from .helpers import documents, words


def levels(sizes, weights=mixture.WEIGHTS, most=mixture.MOST):
    """Targets as the rule has it: excess goes round until none is above its stop."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    stop = {s: most * sizes[s] for s in order}
    target, rest, open_ = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while open_ and rest > 1e-9:
        total = sum(weight[s] for s in open_)
        share = {s: rest * weight[s] / total for s in open_}
        full = {s for s in open_ if target[s] + share[s] >= stop[s] - 1e-12}
        if not full:
            for s in open_:
                target[s] += share[s]
            break
        for s in open_:
            target[s] += share[s]
        rest = sum(target[s] - stop[s] for s in full)
        for s in full:
            target[s] = float(stop[s])
        open_ -= full
    return target


def make(rng, sources):
    texts = []
    for source, (n, most) in sources.items():
        for _ in range(n):
            texts.append(" ".join("w" for _ in range(rng.randrange(most))))
            texts[-1] = (len(texts), texts[-1], "en", source)
    return texts


@pytest.mark.parametrize("bins", [1, 64, mixture.BINS])
def test_targets_and_cuts(spark, bins):
    rng = random.Random(bins)
    sources = {"b": (200, 50), "a": (40, 30), "c": (5, 9), None: (60, 40), "Z": (3, 2), "é": (300, 80), "zero": (4, 1)}
    texts = make(rng, sources)
    docs = documents(spark, texts)
    sized = mixture.sizes(docs)
    planned = mixture.cuts(sized, mixture.targets(sized), bins)
    rows = mixture.ranks(sized, planned).withColumn("n", mixture.taken_copies()).collect()
    by = defaultdict(list)
    for r in rows:
        assert r["size"] == len(words(dict((t[0], t[1]) for t in texts)[r["doc_id"]]))
        by[r["source"]].append(r)
    want = levels({s: sum(r["size"] for r in g) for s, g in by.items()})
    for source, group in by.items():
        target, size = want[source], sum(r["size"] for r in group)
        assert group[0]["target"] == pytest.approx(target)
        copies = math.floor(target / size + 1e-12) if size else 0
        left = target - copies * size
        # The first documents by rank, as many as come nearest to what is left.
        order = sorted(group, key=lambda r: (r["rank"], r["doc_id"]))
        sums = [0]
        for r in order:
            sums.append(sums[-1] + r["size"])
        nearest = min(abs(s - left) for s in sums) if left > 1e-9 else 0
        taken = sum(r["n"] * r["size"] for r in group)
        assert abs(abs(taken - target) - nearest) < 1e-6
        chosen = [r["n"] - copies for r in order if r["size"]]
        assert chosen == sorted(chosen, reverse=True)
        assert all(0 <= r["n"] <= mixture.MOST for r in group)


def test_odds_favour_documents(spark):
    docs = documents(spark, [(i, "a b c d", "en", "x" if i < 2000 else "y") for i in range(4000)])
    sized = mixture.sizes(docs, F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0))
    planned = mixture.cuts(sized, mixture.targets(sized))
    rows = mixture.ranks(sized, planned).withColumn("n", mixture.taken_copies()).collect()
    x = [r for r in rows if r["source"] == "x"]
    even, odd = (sum(r["n"] for r in x if r["doc_id"] % 2 == p) for p in (0, 1))
    assert even > 1.15 * odd
    assert sum(r["n"] for r in x) == pytest.approx(2000 * 2 / 3, abs=1)


def test_inclusion_follows_size(spark):
    """Of many documents of three sizes, each is drawn about as often as its size wants it."""
    docs = documents(spark, [(i, "w " * (5, 10, 20)[i % 3], "en", "x" if i < 6000 else "y") for i in range(12_000)])
    for out in (mixture.mixed(docs), mixture.mix(docs).groupBy("doc_id", "source").agg(F.count("*").alias("copies")).withColumn("size", F.lit(0))):
        drawn = defaultdict(int)
        for r in out.collect():
            if r["source"] == "x":
                drawn[r["doc_id"] % 3] += r["copies"]
        # Two thirds of the words of x are wanted: p = 2 / 3 * size * sum(size) / sum(size ** 2).
        even = (25 + 100 + 400) / 35
        for i, size in enumerate((5, 10, 20)):
            want = min(mixture.CERTAIN, 2 / 3 * size / even)
            assert drawn[i] / 2000 == pytest.approx(want, abs=0.05)


def test_mix_returns_the_copies_that_mixed_counts(spark):
    rng = random.Random(4)
    docs = documents(spark, make(rng, {"a": (50, 20), "b": (10, 5), "c": (80, 60)})).withColumns(
        {"odds": F.lit("o"), "copies": F.lit(7), "rank": F.lit(1), "n": F.lit(2), "copy": F.lit(3)}
    )
    out = mixture.mix(docs)
    assert out.schema.names == docs.schema.names
    got = defaultdict(int)
    for r in out.collect():
        got[r["doc_id"]] += 1
    want = {r["doc_id"]: r["copies"] for r in mixture.mixed(docs).collect() if r["copies"]}
    assert got == want
    assert out.exceptAll(mixture.mix(docs)).count() == 0


def test_odd_rows(spark):
    rows = [(None, "a b", "en", None), (1, None, None, "s"), (2, "", "en", "s"), (3, "x y z", "en", "s")]
    rows += [(3, "x y z", "en", "s"), (4, "w " * 500_000, "en", "t"), (None, "c", "en", None)]
    got = mixture.mixed(documents(spark, rows)).collect()
    assert len(got) == 7
    assert sum(r["size"] for r in got) == 500_009
    assert all(0 <= r["copies"] <= 3 for r in got)
    assert mixture.mixed(documents(spark, [])).count() == 0
    assert mixture.mix(documents(spark, [])).count() == 0
    silent = documents(spark, [(1, None, "en", "a"), (2, "", "en", None)])
    assert [(r["target"], r["copies"]) for r in mixture.mixed(silent).collect()] == [(0.0, 0)] * 2


def test_no_python_on_executors(spark):
    docs = documents(spark, ["a b", "c"])
    for out in (mixture.mixed(docs), mixture.mix(docs)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
