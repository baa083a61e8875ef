"""The prefix trie against a plain one of nested dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from scdflow.llm import bits, trie

from .helpers import FOLDER, words

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = [
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
]


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    below = defaultdict(set)
    for node in members:
        if node:
            below[node[:-1]].add(node)
    out = {}
    for node in sorted(members, key=len, reverse=True):
        leaves = sum(out[x][0] for x in below[node]) or 1
        value = (len(members[node]) - 1) * (len(words(node[-1][1])) if node else 0)
        out[node] = leaves, value + sum(out[x][1] for x in below[node])
    found = []
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(paths[c]) == len(node))
        found.append(
            (
                min(of),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(of),
                len(below[node]),
                *out[node],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(found, key=lambda r: r[:2])


def found(spark, rows, **limits):
    got = trie.nodes(spark.createDataFrame(rows, SCHEMA), **limits)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=lambda r: r[:2])


def some(seed, conversations=120, longest=7):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), conversations):
        for turn in range(rng.randrange(1, longest)):
            rows.append((c, turn, rng.choice(["user", "user", None]), rng.choice(["a b", "", "c", None])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_random(spark, seed):
    rows = some(seed)
    assert found(spark, rows) == brute(rows)


def test_conversations_cut_into_slices(spark):
    rows = some(7, 40, 60) + [(c, t, "user", f"{t % 5}") for c in (1000, 1001, 1013) for t in range(90)]
    assert found(spark, rows, hot=20, cut=15) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "left out"),
        (20, None, None, None),
        (20, 0, "user", "hi there"),
        (21, 5, "user", "hi there"),
        (21, -5, "", ""),
        (39, 1, "x" * 10, "long " * 100_000),
        (47, 1, "user", "no first conversation"),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows[:1]) == []


def test_repeated_rows_and_turn_numbers_give_one_order(spark):
    rows = [(1, 0, "user", t) for t in "cab"] * 2 + [(2, 0, "user", t) for t in "bca"] * 2
    got = found(spark, rows)
    assert got == found(spark, rows[::-1])
    assert max(r[1] for r in got if r[0] == 2 or r[3] == 2) <= 6


def test_columns_with_clashing_names(spark):
    rows = some(3, 30)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("depth", "slice", "p1", "ends", "lead", "n"):
        df = df.withColumn(name, df["text"])
    assert sorted(map(tuple, trie.nodes(df).collect()), key=lambda r: r[:2]) == brute(rows)


def test_many_ends_of_one_node(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 64)
    rows = [(c, 0, "user", "same words here") for c in range(0, 4000, 2)]
    assert found(spark, rows) == brute(rows)


def test_a_full_map_only_groups_more(spark):
    rows = some(5)
    read = trie.turns(spark.createDataFrame(rows, SCHEMA))
    numbered, several = trie.ranked(read)
    paths = trie.prefixes(trie.shared_leads(numbered), several)
    singles = {}
    for power in (4, 20):
        flags = trie.screen(paths, power).collect()
        singles[power] = sum(r["single"] for r in flags)
        count = defaultdict(int)
        for r in flags:
            count[r["p1"], r["p2"]] += 1
        assert all(count[r["p1"], r["p2"]] == 1 for r in flags if r["single"])
    assert singles[4] < singles[20]


def test_bits_count_to_two(spark):
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 62, 3000)
    values = np.concatenate([values, values[:700]])
    df = spark.createDataFrame([(int(v),) for v in values], "h long").repartition(5)
    once, more = bits.counted(df, ["h"], 16)
    at, n = np.unique(bits.cells(values.view(np.uint64), 16), return_counts=True)
    every = np.arange(1 << 16)
    assert (np.flatnonzero(bits.holds(once[0], every)) == at).all()
    assert (np.flatnonzero(bits.holds(more[0], every)) == at[n > 1]).all()


def test_given_table(spark):
    table = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert found(spark, rows) == brute(rows)
