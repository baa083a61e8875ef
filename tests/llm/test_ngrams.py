import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scdflow.llm import language, ngrams
from scdflow.llm.queries import op3_lm_scoring

from .helpers import FOLDER, documents, table, words


class Brute:
    """The automaton as dictionaries."""

    def __init__(self, texts, order, mu):
        self.order, self.mu, self.counts = order, mu, [Counter() for _ in range(order + 1)]
        for text in texts:
            row = ["<s>", *words(text), "</s>"]
            self.counts[1]["<s>",] += 1
            for i in range(1, len(row)):
                for n in range(1, order + 1):
                    if i - n + 1 >= (0 if n > 1 else 1):
                        self.counts[n][tuple(row[i - n + 1 : i + 1])] += 1
        own = {k: v for k, v in self.counts[1].items() if k != ("<s>",)}
        self.total, self.distinct = sum(own.values()), len(own)

    def root(self, w):
        c = 0 if w == "<s>" else self.counts[1][w,]
        return (c + ngrams.ADDED) / (self.total + ngrams.ADDED * (self.distinct + 1))

    def chance(self, context, w):
        if not context:
            return self.root(w)
        lower = self.chance(context[1:], w)
        seen = self.counts[len(context)][context]
        if not seen:
            return lower
        return (self.counts[len(context) + 1][(*context, w)] + self.mu * lower) / (seen + self.mu)

    def score(self, text):
        row = ["<s>", *words(text), "</s>"]
        base = sum(math.log10(self.root(w)) for w in row[1:])
        full = 0.0
        for i in range(1, len(row)):
            full += math.log10(self.chance(tuple(row[max(0, i - self.order + 1) : i]), row[i]))
        known = sum(self.counts[1][w,] > 0 for w in row[1:])
        return len(row) - 1, known, self.total, base, full


@pytest.mark.parametrize(("order", "block"), [(2, 100_000), (3, 40_000), (1, 10**9)])
def test_against_dictionaries(spark, monkeypatch, order, block):
    monkeypatch.setattr(ngrams, "BLOCK_BYTES", block)
    docs = table(spark, "documents")
    marked = docs.select("doc_id", "text", (language.remainder(10) != 0).alias("t"))
    rows = marked.collect()
    model = Brute([r["text"] for r in rows if r["t"]], order, ngrams.MU)
    got = {r["doc_id"]: r for r in ngrams.score(docs, language.remainder(10) != 0, order).collect()}
    assert len(got) == len(rows)
    for r in rows:
        g = got[r["doc_id"]]
        tokens, known, total, base, full = model.score(r["text"])
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (tokens, known, total)
        assert g["held_out"] == (not r["t"])
        assert g["base_score"] == pytest.approx(base, rel=1e-9)
        assert g["score"] == pytest.approx(full, rel=1e-9)
    held = [g for g in got.values() if g["held_out"]]
    if order > 1:
        assert sum(g["score"] for g in held) > sum(g["base_score"] for g in held)


def test_chances_add_up(spark):
    texts = ["a b a c", "b a b", "c c", ""]
    docs = documents(spark, texts)
    # Texts of one word more, for every word known and one unknown one.
    prefix = "a b a"
    ends = ["a", "b", "c", "zzz"]
    asked = documents(spark, [f"{prefix} {e}" for e in ends], first=100)
    rows = ngrams.score(docs.unionAll(asked), F.col("doc_id") < 100, 3).collect()
    model = Brute(texts, 3, ngrams.MU)
    for r in rows:
        if r["doc_id"] >= 100:
            assert r["score"] == pytest.approx(model.score(f"{prefix} {ends[r['doc_id'] - 100]}")[4])
    chances = [model.chance(("b", "a"), w) for w in ("a", "b", "c", "</s>", "zzz")]
    assert sum(chances) == pytest.approx(1)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 997}" for i in range(300_000))
    rows = [(None, None, "en", "a"), (1, "", "en", "a"), (2, "A a", "en", "a"), (2, "A a", "en", "a"), (3, long, "en", "b")]
    docs = documents(spark, rows).withColumns({"block": F.lit("x"), "shard": F.lit(1), "training": F.lit(0)})
    got = ngrams.score(docs, F.col("doc_id").isNotNull()).collect()
    model = Brute(["", "a a", "a a", long], 2, ngrams.MU)
    texts = {None: None, 1: "", 2: "a a", 3: long}
    assert len(got) == 5
    for r in got:
        want = model.score(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert (r["base_score"], r["score"]) == pytest.approx(want[3:])
        assert r["held_out"] == (r["doc_id"] is None)


def test_empty_and_untaught(spark):
    docs = documents(spark, ["a b", "c"])
    assert ngrams.score(docs.limit(0), F.lit(True)).count() == 0
    rows = ngrams.score(docs, F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] == r["base_score"] for r in rows)


class Estimated(Brute):
    """Trigrams, with a mu for each length from the counts."""

    def __init__(self, texts):
        super().__init__(texts, 3, None)
        self.mus = [None] + [self.estimate(n) for n in (2, 3)]

    def estimate(self, n):
        contexts = {k: c for k, c in self.counts[n - 1].items() if k[-1] != "</s>"}
        once = sum(c == 1 for c in self.counts[n].values()) - sum(c == 1 for c in contexts.values())
        bins = Counter()
        sums = Counter()
        for c in contexts.values():
            bins[c.bit_length()] += 1
            sums[c.bit_length()] += c
        low, high = 1e-3, 1e6
        for _ in range(200):
            mu = math.sqrt(low * high)
            new = sum(sums[b] * mu / (sums[b] / bins[b] - 1 + mu) for b in bins if b > 1)
            low, high = (mu, high) if new < once else (low, mu)
        return mu

    def chance(self, context, w):
        self.mu = self.mus[len(context)] if context else None
        if not context:
            return self.root(w)
        lower, mu = self.chance(context[1:], w), self.mus[len(context)]
        seen = self.counts[len(context)][context]
        return (self.counts[len(context) + 1][(*context, w)] + mu * lower) / (seen + mu) if seen else lower


def test_query_reads_trigrams_with_estimated_weights(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "BLOCK_BYTES", 100_000)
    rows = table(spark, "documents").select("doc_id", "text", (language.remainder(10) != 0).alias("t")).collect()
    model = Estimated([r["text"] for r in rows if r["t"]])
    assert all(ngrams.LEAST_MU * 2 < mu < ngrams.MOST_MU / 2 for mu in model.mus[1:])
    got = {r["doc_id"]: r["score"] for r in op3_lm_scoring(spark, FOLDER).collect()}
    for r in rows:
        assert got[r["doc_id"]] == pytest.approx(model.score(r["text"])[4], rel=1e-6)


def test_lanes_and_slices(spark, monkeypatch):
    """Long texts are walked in lanes and blocks in slices, in blocks of a few texts each."""
    monkeypatch.setattr(ngrams, "LANE", 5)
    monkeypatch.setattr(ngrams, "SLICE_BYTES", 60)
    monkeypatch.setattr(ngrams, "BLOCK_BYTES", 400)
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(60))) for _ in range(60)]
    docs = documents(spark, texts)
    model = Brute([t for i, t in enumerate(texts) if i % 3], 4, 2.0)
    got = ngrams.score(docs, F.col("doc_id") % 3 != 0, 4, 2.0).collect()
    assert len(got) == len(texts)
    for r in got:
        want = model.score(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert (r["base_score"], r["score"]) == pytest.approx(want[3:])


def test_equal_rows_are_one_row_of_a_block(spark):
    rows = [(None, "a b c", "en", "a")] * 700 + [(1, None, "en", "a")] * 300 + [(2, "a b d", "en", "a")]
    docs = documents(spark, rows)
    once = ngrams._once(docs.select("doc_id", "text", (F.col("doc_id") == 2).eqNullSafe(False).alias("training")))
    assert sorted(r["weight"] for r in once.collect()) == [1, 300, 700]
    got = ngrams.score(docs, F.lit(True), 3).collect()
    model = Brute([r[1] for r in rows], 3, ngrams.MU)
    assert len(got) == 1001
    for r in got:
        text = "a b c" if r["doc_id"] is None else None if r["doc_id"] == 1 else "a b d"
        assert (r["train_tokens"], r["score"]) == (model.total, pytest.approx(model.score(text)[4]))
