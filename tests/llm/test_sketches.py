"""Near-duplicates by sketches against all pairs of sets."""

import random

import numpy as np
import pyarrow as pa
import pytest

from scdflow.llm import sketches

from .helpers import documents, table, words


def shingles(text):
    own = words(text)
    return {tuple(own[i : i + 4]) for i in range(max(1, len(own) - 3))} if own else set()


def brute(rows):
    """`rows` of (doc_id, text)."""
    distinct = {}
    for doc_id, text in rows:
        distinct.setdefault(frozenset(shingles(text)), []).append(doc_id)
    sets = list(distinct)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, a in enumerate(sets):
        ids = [x for x in distinct[a] if x is not None]
        if a and ids:
            least[find(i)] = min(*ids, least.get(find(i), ids[0]), ids[0])
    out = []
    for i, a in enumerate(sets):
        for doc_id in distinct[a]:
            component = least.get(find(i)) if a else doc_id
            out.append((doc_id, len(a), component, doc_id == component))
    return sorted(out, key=repr)


def found(spark, rows, **given):
    df = documents(spark, [(i, text, "en", "a") for i, text in rows]).repartition(3)
    got = sketches.near_duplicates(df, **given)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(map(tuple, got.collect()), key=repr)


def chains(seed, bases=12, edits=8, longest=120):
    """Texts and copies of copies, a few words changed in each."""
    rng = random.Random(seed)
    texts = []
    for _ in range(bases):
        own = [rng.choice("abcdefghij") + rng.choice("klmnopq") for _ in range(rng.randrange(1, longest))]
        for _ in range(rng.randrange(1, edits)):
            texts.append(" ".join(own))
            own = list(own)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = rng.choice("xyz")
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", range(4))
def test_random(spark, seed):
    rows = chains(seed)
    assert found(spark, rows) == brute(rows)


def test_small_tiles(spark):
    rows = chains(5, 6, 30)
    assert found(spark, rows, tile=200, held=100) == brute(rows)


def test_a_hub_unlike_most_of_its_group(spark):
    """Copies that differ from each other by more than from their source, at the limit."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):
        own = list(base)
        for at in rng.sample(range(200), 5 + i % 9):
            own[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    assert found(spark, rows, tile=3000, held=1000) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, "one text of several words"), (None, "One text OF several\twords"), (None, None)]
    rows += [(5, ""), (6, None), (7, " \n"), (8, "short"), (9, "short"), (8, "short"), (10, "short one")]
    rows += [(11, "long " * 50_000), (12, "long " * 49_000), (13, "x" * 400_000), (13, "x" * 400_000)]
    rows += [(None, "short"), (20, "a b c d e f g h"), (21, "a b c d e f g"), (21, "a b c d e f g")]
    assert found(spark, rows) == brute(rows)


def test_columns_with_clashing_names(spark):
    rows = chains(9, 5)
    df = documents(spark, [(i, text, "en", "a") for i, text in rows])
    for name in ("node", "bands", "text_hash", "tile", "root", "key"):
        df = df.withColumn(name, df["lang"])
    got = sketches.near_duplicates(df).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_sketches_fill_and_estimate_similarity():
    rng = np.random.default_rng(0)
    for size, shared in ((1, 1), (5, 4), (40, 30), (3000, 2000)):
        every = rng.integers(0, 1 << 63, 2 * size).astype(np.uint64)
        a, b = np.sort(every[:size]), np.sort(every[size - shared : 2 * size - shared])
        made = sketches.sketch(np.concatenate([a, b]), np.array([0, size, 2 * size]))
        assert (made != ~np.uint64(0)).all()
        assert abs((made[0] == made[1]).mean() - shared / (2 * size - shared)) < 0.16
    empty = sketches.sketch(np.empty(0, np.uint64), np.array([0, 0]))
    assert (empty == ~np.uint64(0)).all()


def test_order_of_a_set_does_not_matter():
    texts = pa.array(["a b c d e", "b c d e", "a b c d", None, "", "a b"])
    sets, starts = sketches.shingle_sets(texts)
    assert np.diff(starts).tolist() == [2, 1, 1, 0, 0, 1]
    assert set(sets[:2]) == {sets[2], sets[3]}


def test_given_table(spark):
    docs = table(spark, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sketches.near_duplicates(docs).collect()
    want = brute(rows)
    assert sorted(map(tuple, got), key=repr) == want
    assert not all(r[3] for r in want)


