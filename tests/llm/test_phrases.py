"""Collocations against plain counting."""

import random
import re
from collections import Counter

import pytest

from scdflow.llm import phrases

from .helpers import FOLDER, LOWER, documents, table


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(rows, least=30, top=2000):
    """`rows` of (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in pieces(text):
            n[lang] += len(piece)
            for k in range(1, 5):
                for i in range(len(piece) - k + 1):
                    f[lang, tuple(piece[i : i + k])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    dropped = set()
    for (lang, phrase), longer in candidates.items():
        for size in range(2, len(phrase)):
            for i in range(len(phrase) - size + 1):
                inner = lang, phrase[i : i + size]
                if 100 * longer >= 80 * candidates[inner]:
                    dropped.add(inner)
    out = []
    for lang in n:
        found = []
        for (own, phrase), a in candidates.items():
            if own != lang or (lang, phrase) in dropped:
                continue
            cuts = [(f[lang, phrase[:k]], f[lang, phrase[k:]]) for k in range(1, len(phrase))]
            score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
            found.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(spark, rows, **given):
    df = documents(spark, [(i, text, lang, "a") for i, (text, lang) in enumerate(rows)])
    got = phrases.collocations(df.repartition(3), **given)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


def some(seed, docs=80, longest=200):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "the", "of", "x\x00y", "é", "Ä", "　", "zz"]
    rows = []
    for _ in range(docs):
        text = "".join(
            rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "!?", "\x0b"])
            for _ in range(rng.randrange(longest))
        )
        rows.append((text, rng.choice(["en", "de", None, "und"])))
    return rows + rows[:20]


@pytest.mark.parametrize("seed,chunk", [(0, 32), (1, 3), (2, 1)])
def test_random(spark, seed, chunk):
    rows = some(seed)
    want = brute(rows)
    assert len(want) > 50
    assert found(spark, rows, chunk=chunk) == want


def test_few_of_each_language(spark):
    rows = some(3)
    assert found(spark, rows, top=7, salts=3, least=10) == brute(rows, 10, 7)


def test_full_map_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases.bits, "width", lambda *_: 4)
    rows = some(4, 40)
    assert found(spark, rows) == brute(rows)


def test_odd_texts(spark):
    rows = [(None, None), ("", "en"), (" \t ", "en"), ("...", "de"), ("one", "fr")]
    assert found(spark, rows) == []
    rows += [("w " * 5000 + "." + "a b c d e " * 3000, None), ("x" * 300_000, "en")]
    assert found(spark, rows) == brute(rows)


def test_each_ngram_begins_in_one_core(spark):
    rows = some(5, 30, 400)
    df = documents(spark, [(i, t, lang, "a") for i, (t, lang) in enumerate(rows)])
    cut = phrases.parsed(df).collect()
    assert sum(r["n_words"] * r["n"] for r in cut) == sum(len(p) for t, _ in rows for p in pieces(t))
    assert max(r["core"] for r in cut) <= phrases.MOST_CHUNK
    assert max(r["n"] for r in cut) > 1


def test_columns_with_clashing_names(spark):
    rows = some(6, 30)
    df = documents(spark, [(i, t, lang, "a") for i, (t, lang) in enumerate(rows)])
    for name in ("chunk", "phrase", "n", "length", "score"):
        df = df.withColumn(name, df["text"])
    assert sorted(map(tuple, phrases.collocations(df).collect())) == brute(rows)


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_000
    known = spark.createDataFrame(
        [("en", "a", 1, big + 1), ("en", "b", 1, big + 2), ("en", "a b", 2, big)],
        "lang string, phrase string, length int, n long",
    )
    (row,) = phrases._scored(known).collect()
    assert row["score"] == 2_000_000 * big // (2 * big + 3)


def test_given_table(spark):
    rows = [(r["text"], r["lang"]) for r in table(spark, "documents").collect()]
    got = phrases.collocations(table(spark, "documents"), least=5)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)
