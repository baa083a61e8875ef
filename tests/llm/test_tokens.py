import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scdflow.llm import tokens
from scdflow.sources.shared import new_folder

from .helpers import documents, table

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.one_of(st.just(0), st.integers(0, 70_000), st.integers(0, 2**64 - 1)), max_size=900))
@settings(deadline=None, max_examples=150)
def test_round_trip(values):
    values = np.array(values, np.uint64)
    packed, offsets, escapes = tokens.pack(values)
    assert np.array_equal(tokens.unpack(packed, offsets, escapes, len(values)), values)


@pytest.mark.parametrize("top", [1, 2, 300, 1 << 15, 1 << 16, 1 << 30, 1 << 60, 1 << 64])
def test_round_trip_of_many(top):
    rng = np.random.default_rng(top % 97)
    values = rng.integers(0, top, 5000, dtype=np.uint64, endpoint=False) if top < 1 << 64 else rng.integers(
        0, top - 1, 5000, dtype=np.uint64
    )
    values[1000:1700] = 0
    packed, offsets, escapes = tokens.pack(values)
    assert np.array_equal(tokens.unpack(packed, offsets, escapes, len(values)), values)
    # One block, read without the others.
    begin, end = int(offsets[7]), int(offsets[8])
    part = tokens.unpack(packed[begin:end], np.array([0], np.uint32), escapes, tokens.BLOCK)
    assert np.array_equal(part, values[7 * tokens.BLOCK : 8 * tokens.BLOCK])


def test_small_ids_take_few_words():
    assert len(tokens.pack(np.zeros(128, np.uint64))[0]) == 2
    assert len(tokens.pack(np.full(120, 15, np.uint64))[0]) == 8


def test_encoder_equals_the_tokenizer():
    rng = random.Random(4)
    plain = Tokenizer.from_file(PATH)
    encoder = tokens.Encoder(PATH, 2, True)
    bits = [" ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "　", "é", "é", "́", "Σ", "ς", "İ"]
    bits += ["'s", "'S,", "it's", "12", "3", "ab", "AB", "Word,", "x.", "...", "K", "ﬁ", "한", "ᄒ", "\U0001f600"]
    for some in (bits, [*bits, "<|endoftext|>", "<|STARTOFTEXT|>", "<|", "|>"]):
        texts = ["".join(rng.choices(some, k=rng.randrange(40))) for _ in range(3000)] + [None, ""]
        ids, sizes = encoder.batch(pa.array(texts))
        got = np.split(ids, np.cumsum(sizes)[:-1])
        for text, found in zip(texts, got, strict=True):
            assert found.tolist() == [*plain.encode(text or "", add_special_tokens=False).ids, 2]


def expected(rows):
    plain, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files(spark, monkeypatch):
    monkeypatch.setattr(tokens, "PART_BYTES", 50_000)
    docs = table(spark, "documents").repartition(5, "lang")
    folder = new_folder(spark, "tokens")
    tokens.write(docs, PATH, 2, folder, True)
    got = sorted(tuple(r) for r in tokens.digests(spark, folder).collect())
    assert got == expected(sorted(tuple(r) for r in docs.select("doc_id", "text").collect()))
    ids = {r["doc_id"]: r["ids"] for r in tokens.read(spark, folder).collect()}
    assert all(len(ids[d]) == n for d, _, n, _ in got)


def test_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(400_000))
    docs = documents(
        spark,
        [(9, None, "en", "a"), (3, "", "en", "a"), (None, "first", "en", "a"), (5, long, "en", "a")]
        + [(5, "tie", "en", "a"), (5, "tie", "en", "a")],
    ).withColumns({"part": F.lit("p"), "start": F.lit(1), "words": F.lit(2), "sizes": F.lit(3)})
    folder = new_folder(spark, "tokens")
    tokens.write(docs, PATH, 2, folder, True)
    got = sorted((tuple(r) for r in tokens.digests(spark, folder).collect()), key=lambda r: r[1])
    order = [(None, "first"), (3, ""), (5, "tie"), (5, "tie"), (5, long), (9, None)]
    assert got == expected(order)
    assert got[4][2] > tokens.SEGMENT


def test_empty(spark):
    folder = new_folder(spark, "tokens")
    tokens.write(documents(spark, []), PATH, 2, folder)
    assert tokens.digests(spark, folder).count() == 0


def test_rows_of_one_id_are_dealt_to_several_parts(spark, monkeypatch):
    monkeypatch.setattr(tokens, "PART_BYTES", 2000)
    rows = [(None if i % 3 else i, f"text {i} " * 10, "en", "a") for i in range(300)]
    folder = new_folder(spark, "tokens")
    tokens.write(documents(spark, rows), PATH, 2, folder, True)
    parts = spark.read.parquet(folder).select("part", "segment", F.explode("doc_ids").alias("doc_id"))
    held = parts.filter("doc_id IS NULL").groupBy("part").count().collect()
    assert len(held) > 3 and sum(r["count"] for r in held) == 200
    ids = [r["doc_id"] for r in parts.orderBy("part", "segment").collect()]
    ids = [-1 if i is None else i for i in ids]
    assert ids == sorted(ids) and len(ids) == 300
