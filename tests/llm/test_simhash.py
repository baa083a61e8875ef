import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from scdflow.llm import simhash
from scdflow.llm.components import components

from .helpers import FOLDER, documents, table, words


def print_of(text, shingle=3):
    own = words(text)
    if not own:
        return 0
    grams = [" ".join(own[i : i + shingle]) for i in range(max(1, len(own) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, bits):
    """Least member of each component, by comparing all pairs."""
    todo, root = list(dict.fromkeys(prints)), {}
    rest = set(todo)
    for p in todo:
        if p not in rest:
            continue
        rest.discard(p)
        found, at = [p], 0
        while at < len(found):
            near = [q for q in rest if (q ^ found[at]).bit_count() <= bits]
            rest.difference_update(near)
            found += near
            at += 1
        root |= dict.fromkeys(found, min(found))
    return root


def signed(values):
    return np.array(values, np.uint64).view(np.int64).tolist()


def test_fingerprints_and_components(spark):
    docs = table(spark, "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    want = {d: print_of(t) for d, t in rows}
    made = simhash.fingerprints(docs).collect()
    assert {r["doc_id"]: r["fingerprint"] % (1 << 64) for r in made} == want
    roots = brute_groups(list(want.values()), 2)
    least = {}
    for d, p in want.items():
        least[roots[p]] = min(d, least.get(roots[p], d))
    prints = simhash.fingerprints(docs)
    found = prints.join(simhash.groups(prints), "fingerprint").collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {d: least[roots[p]] for d, p in want.items()}
    kept = {r["doc_id"] for r in simhash.representatives(table(spark, "documents")).collect()}
    assert kept == set(least.values())
    assert FOLDER


@pytest.mark.parametrize("kind", ["random", "dense", "chain"])
def test_links_over_shards(spark, kind):
    rng = random.Random(3)
    if kind == "random":
        values = [rng.getrandbits(64) for _ in range(1500)]
        values += [v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for v in values[:500]]
    elif kind == "dense":
        centre = rng.getrandbits(64)
        values = [centre]
        for _ in range(2500):
            v = rng.choice(values[-300:])
            for _ in range(rng.randrange(1, 4)):
                v ^= 1 << rng.randrange(64)
            values.append(v)
        values += [rng.getrandbits(64) for _ in range(300)]
    else:
        values = [0]
        for i in range(60):
            values.append(values[-1] ^ (1 << i) ^ (1 << (i + 1)))
    values = list(dict.fromkeys(values))
    frame = spark.createDataFrame([(v,) for v in signed(values)], "fingerprint long")
    want = brute_groups(values, 2)
    for shard in (150, 10**9):
        links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(frame, 2, shard).collect()]
        assert all(want[a] == want[b] for a, b in links)
        root = {v: v for v in values}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        assert {v: find(v) for v in values} == want


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    names = rng.sample(range(10**6), 400)
    path = list(zip(names[:200], names[1:200], strict=False))
    star = [(names[200], n) for n in names[201:390]]
    frame = spark.createDataFrame(path + star + [(names[395], names[395])], "a long, b long")
    got = {r["node"]: r["root"] for r in components(frame).collect()}
    assert {got[n] for n in names[:200]} == {min(names[:200])}
    assert {got[n] for n in names[200:390]} == {min(names[200:390])}
    assert len(got) == 390


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    docs = documents(
        spark,
        [(None, None, "en", None), (4, None, "en", "a"), (3, "", "en", "a"), (9, " \n", "en", "a")]
        + [(7, "one", "en", "a"), (8, "ONE", "en", "a"), (8, "ONE", "en", "a"), (10, long, "en", "b")]
        + [(None, "x y z q", "en", "a"), (None, "x y z q", "en", "a")],
    ).withColumns({"fingerprint": F.lit("f"), "root": F.lit(1), "own_id": F.lit(2), "shard": F.lit(0)})
    prints = simhash.fingerprints(docs)
    assert prints.drop("fingerprint").columns == docs.drop("fingerprint").columns
    found = prints.join(simhash.groups(prints).drop("root"), "fingerprint").collect()
    got = sorted((str(r["text"])[:9], str(r["doc_id"]), str(r["component_id"])) for r in found)
    empties = [g for g in got if g[0] in ("", " \n", "None")]
    assert [g[2] for g in empties] == ["3"] * 4
    assert [g for g in got if g[0] in ("one", "ONE")] == [("ONE", "8", "7")] * 2 + [("one", "7", "7")]
    assert [g[2] for g in got if g[0] == "x y z q"] == ["None"] * 2
    kept = simhash.representatives(docs)
    assert kept.schema == docs.schema
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["10", "3", "7", "None"]


def test_empty(spark):
    docs = documents(spark, [])
    assert simhash.representatives(docs).count() == 0
    assert simhash.groups(simhash.fingerprints(docs)).count() == 0
