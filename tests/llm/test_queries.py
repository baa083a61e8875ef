"""Queries and pipeline on the test tables, against DuckDB or stage by stage."""

import os
import random
from collections import Counter

import duckdb
import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from scdflow.llm import language, mixture
from scdflow.llm.queries import ORACLE_SQL, QUERIES

from .helpers import FOLDER, documents, table, write_tables
from .test_decontaminate import brute as leaking
from .test_simhash import brute_groups, print_of
from .test_tokens import expected


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, folder, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        path = f"{folder}/{t}.parquet"
        db.execute(f"create view {t} as from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    want = db.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    compare(spark, FOLDER, name)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_of_odd_rows(spark, name, tmp_path):
    rng = random.Random(1)
    texts = [(i, " ".join("w" for _ in range(rng.randrange(30))), "en", rng.choice("abcde")) for i in range(300)]
    texts += [(400, None, None, None), (401, "", "en", None), (402, "Under the MIT license\ncc by-nc", "en", None)]
    pages = spark.createDataFrame(
        [(1, None, None), (2, "http://a.net/", ""), (3, "x", "h" * 1000), (4, "HTTP://B.org/fr/", "h" * 1000)],
        "page_id long, url string, html string",
    )
    turns = [(c, t, "user", rng.choice("abc")) for c in range(0, 200, 3) for t in range(rng.randrange(1, 6))]
    turns += [(None, 0, "user", "x"), (7, None, None, None), (7, 4, "user", "")]
    conversations = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    folder = write_tables(
        tmp_path, documents=documents(spark, texts), pages=pages, conversations=conversations
    )
    compare(spark, folder, name)


def test_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", [*sorted(QUERIES), "pipeline"])
def test_empty_tables(spark, name, tmp_path):
    folder = write_tables(
        tmp_path, **{t: table(spark, t).limit(0) for t in ("documents", "pages", "benchmark", "conversations")}
    )
    assert entry.queries()[name](spark, folder).count() == 0


def test_pipeline_stage_by_stage(spark):
    """Each stage against a plain version over what the stage before kept."""
    docs = table(spark, "documents")
    columns = docs.columns
    benchmark = [(r["item_id"], r["text"]) for r in table(spark, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    own = {r["doc_id"]: r for r in docs.collect()}

    docs = stages["language ID"](spark, docs, FOLDER)
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert docs.columns == columns
    assert set(kept) == {d for d, r in own.items() if language._LETTER.search(r["text"])}

    docs = stages["SimHash near-dedup"](spark, docs, FOLDER)
    prints = {d: print_of(t) for d, t in kept.items()}
    roots = brute_groups(list(prints.values()), 2)
    least = {}
    for d, p in prints.items():
        least[roots[p]] = min(d, least.get(roots[p], d))
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert docs.columns == columns and set(kept) == set(least.values())

    docs = stages["benchmark decontamination"](spark, docs, FOLDER)
    short = [(d, t) for d, t in kept.items() if len(t) < 20_000]
    bad = {d for d, _ in leaking(short, benchmark)}
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert docs.columns == columns
    assert bad and set(kept) & {d for d, _ in short} == {d for d, _ in short} - bad

    before = docs
    docs = stages["mixing sources to target weights"](spark, docs, FOLDER)
    want = {r["doc_id"]: r["copies"] for r in mixture.mixed(before).collect() if r["copies"]}
    assert docs.columns == columns
    assert Counter(r["doc_id"] for r in docs.collect()) == want

    files = stages["token-ID / binary output"](spark, docs, FOLDER)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert sorted(map(tuple, files.collect())) == expected(rows)
    run = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, run.collect())) == expected(rows)


def test_odd_documents_go_through_the_pipeline(spark, tmp_path):
    rows = [(None, "a first text without an id", "en", None), (1, None, None, None), (2, "", "en", "a")]
    rows += [(3, "123 456", "en", "a"), (4, "hello big wide world out there", "en", "a")] * 2
    rows += [(5, "item text one two three four", "en", "b"), (6, "w " * 300_000, "en", "b")]
    folder = write_tables(
        tmp_path,
        documents=documents(spark, rows),
        benchmark=spark.createDataFrame([(1, "item text one two three four"), (2, None)], "item_id long, text string"),
    )
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in got} <= {None, 4, 6}
    assert public_tokenizers.path("word_bpe_49k.json")
