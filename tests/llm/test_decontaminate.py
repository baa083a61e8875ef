import random

import pytest
from pyspark.sql import functions as F

from scdflow.llm import decontaminate

from .helpers import documents, words


def best(item, text):
    """Plain Smith-Waterman over the whole text."""
    row, most = [0] * (len(text) + 1), 0
    for w in item:
        new = [0]
        for j, v in enumerate(text):
            new.append(max(0, row[j] + (1 if v == w else -0.5), row[j + 1] - 0.5, new[j] - 0.5))
        row, most = new, max(most, *new)
    return most


def brute(docs, items, shortest=1):
    """Scores of all items that reach the share of their words, and of short ones that are there."""
    found = {}
    for d, text in docs:
        for i, item in items:
            own = words(item)
            if len(own) >= shortest:
                score = best(own, words(text)) / len(own)
                if score >= (0.7 if len(own) > 4 else 1) - 1e-9:
                    found[d, i] = score
    return found


def changes(item, text):
    """Fewest words replaced, put in or taken out that make the item a part of the text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(text):
            new.append(min(row[j] + (v != w), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng, item, n, letters):
    out = list(item)
    for _ in range(n):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.4:
            out[at] = rng.choice(letters)
        elif kind < 0.7:
            out.insert(at, rng.choice(letters))
        else:
            del out[at]
    return out


@pytest.fixture(scope="module")
def case():
    rng = random.Random(5)
    letters = [f"w{i}" for i in range(30)]
    items = [(i, [rng.choice(letters) for _ in range(rng.randrange(3, 40))]) for i in range(25)]
    texts = []
    for d in range(150):
        text = [rng.choice(letters) for _ in range(rng.randrange(0, 120))]
        for _ in range(rng.randrange(3)):
            item = items[rng.randrange(len(items))][1]
            at = rng.randrange(len(text) + 1)
            text[at:at] = edited(rng, item, rng.randrange(1 + len(item) // 4), letters)
        texts.append((d, " ".join(text).upper() if d % 3 else "\n".join(text)))
    return texts, [(i, " ".join(x)) for i, x in items]


@pytest.mark.parametrize("block_words", [500_000, 60])
def test_against_all_alignments(spark, case, block_words):
    texts, items = case
    docs = documents(spark, [(d, t, "en", "a") for d, t in texts])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.leaks(docs, benchmark, block_words=block_words).collect()
    every = brute(texts, items)
    by_id, of = dict(texts), dict(items)
    # All copies with up to a fifth of the words changed, and nothing that does not reach the score.
    near = {k for k in every if 5 * changes(words(of[k[1]]), words(by_id[k[0]])) <= len(words(of[k[1]]))}
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in rows}
    assert len(near) > 50 and near <= set(got) <= set(every)
    assert got == pytest.approx({k: every[k] for k in got})
    assert len(rows) == len(got) >= 0.97 * len(every)
    for r in rows:
        span = words(by_id[r["doc_id"]])[r["first_word"] : r["last_word"] + 1]
        own = words(of[r["item_id"]])
        assert best(own, span) / len(own) == pytest.approx(r["score"])
    kept = {r["doc_id"] for r in decontaminate.clean(docs, benchmark, block_words=block_words, shortest=1).collect()}
    assert kept == set(by_id) - {d for d, _ in got}


@pytest.mark.parametrize("share,least", [(0.1, 1.0), (0.2, 1.0), (0.3, 0.0)])
def test_recall_by_share_of_replaced_words(spark, share, least):
    rng = random.Random(7)
    items = [[f"w{rng.randrange(4000)}" for _ in range(rng.randrange(5, 60))] for _ in range(200)]
    texts = []
    for item in items:
        own = list(item)
        for at in rng.sample(range(1, len(own) - 1), int(share * len(own) + 1e-9)):
            own[at] = "other"
        texts.append(" ".join(["before"] * 9 + own + ["behind"] * 9))
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    rows = decontaminate.leaks(documents(spark, texts), benchmark).collect()
    caught = sum(r["doc_id"] == r["item_id"] for r in rows)
    assert least * len(items) <= caught and len(rows) == caught


def test_many_items_of_one_beginning(spark):
    """Each place of the beginning points to every item; few are aligned, the copies are found."""
    rng = random.Random(2)
    items = [(i, "which of the following is " + " ".join(f"v{rng.randrange(9000)}" for _ in range(20))) for i in range(3000)]
    text = "which of the following is " * 300 + items[77][1]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, [text, "which of the following is nothing", items[5][1]])
    rows = decontaminate.leaks(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(0, 77), (2, 5)]


def test_long_item_takes_few_words_at_once(spark):
    rng = random.Random(1)
    item = [f"x{rng.randrange(500)}" for _ in range(3000)]
    text = ["a"] * 5000 + item[:1500] + ["y"] * 100 + item[1500:] + ["b"] * 5000
    docs = documents(spark, [" ".join(text), " ".join(item[:2000])])
    benchmark = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    rows = decontaminate.leaks(docs, benchmark).collect()
    assert [(r["doc_id"], r["first_word"], r["last_word"]) for r in rows] == [(0, 5000, 8099)]
    assert rows[0]["score"] == pytest.approx(2950 / 3000)


def test_odd_rows(spark):
    item = "one two three four five six"
    benchmark = spark.createDataFrame(
        [(1, item), (1, item), (2, None), (3, ""), (4, "one two three"), (None, "p q r s t u")],
        "item_id long, text string",
    )
    docs = documents(
        spark,
        [(None, item, "en", None), (5, None, None, "a"), (6, "", "en", "a"), (7, "a " + item, "en", "a")]
        + [(7, "a " + item, "en", "a"), (8, "p Q r s t u", "en", "a"), (9, "clean text", "en", "a")],
    ).withColumns({"item_id": F.lit(9), "score": F.lit("s"), "seed": F.lit(1.5)})
    found = sorted((str(r["doc_id"]), str(r["item_id"])) for r in decontaminate.leaks(docs, benchmark).collect())
    assert found == [("7", "1"), ("7", "1"), ("7", "4"), ("7", "4"), ("8", "None"), ("None", "1"), ("None", "4")]
    kept = decontaminate.clean(docs, benchmark)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == [5, 6, 9]


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark, ["a b c d e f"])
    assert decontaminate.leaks(docs, none).count() == 0
    assert decontaminate.clean(docs, none).count() == 1
    some = spark.createDataFrame([(1, "a b c d e f")], none.schema)
    assert decontaminate.leaks(docs.limit(0), some).count() == 0
    assert decontaminate.clean(docs.limit(0), some).count() == 0


def test_a_single_seed_that_many_items_share(spark):
    """A fifth of the words replaced leaves one seed, the beginning that all items have."""
    items = [(i, "all items begin so " + " ".join(f"w{i}x{k}" for k in range(16))) for i in range(100)]
    text = words(items[7][1])
    for at in (4, 8, 12, 16):
        text[at] = f"other{at}"
    docs = [(0, "before " + " ".join(text) + " behind"), (1, "all items begin so and go on otherwise")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.leaks(documents(spark, [t for _, t in docs]), frame).collect()
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in found}
    assert got == pytest.approx(brute(docs, items)) and list(got) == [(0, 7)]
    assert [r["doc_id"] for r in decontaminate.clean(documents(spark, [t for _, t in docs]), frame).collect()] == [1]
