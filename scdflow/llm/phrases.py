"""Phrase collocations from a prefix-free parse of all texts.

Parsing: a text is its words in order, with a mark where punctuation or a line end parts it. It
is cut before a word where the hash of the word and of the one before says so, a rule of the
content alone, so equal passages are cut alike wherever they stand. A chunk goes on for
`LONGEST - 1` words beyond its end, so each n-gram lies whole in the chunk in whose core it
begins, and belongs to that one only. The parse is a dictionary of distinct chunks with the
number of times each occurs; copies and repeated passages add to a number, not to the dictionary.

Counting: n-grams are counted in distinct chunks, weighted by these numbers, under 64-bit hashes
of their language and words. An n-gram can occur `least` times only if its parts do: words are
counted first, then pairs of frequent words, then longer ones of frequent pairs; others are
never shuffled. Frequent ones are known by bit maps of bounded size (at most 16 MB each): with more
of them than a map was made for, more n-grams are counted exactly and dropped, and the result
is the same. Only what is frequent then gets its words, in one more reading of the chunks.

A candidate's cuts meet the counts of their parts in equi joins; all counts are exact, and scores
are decimals. A hot word or phrase is one row a batch before the shuffle. The best of a language
are chosen in salted parts first.

A null text is empty, a null language `und`. An empty table has no phrases. Rows count each for
itself, repeated ones and those of one doc_id too; columns other than text and lang are not
read. A long text is parsed in one task, in memory of some tens of times its size; counting
reads its chunks. Ties in score and count go by the phrase's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scdflow.sources.shared import staged

from . import bits, words

#: Words of the longest phrase, occurrences of a candidate, and phrases of a language.
LONGEST, LEAST, TOP = 4, 30, 2000
#: Share of a phrase's occurrences, in percent, that a longer one has if it stands for it.
INSIDE = 80
#: Words of a chunk's core on average, and at most.
CHUNK, MOST_CHUNK = 32, 256
#: Score of a phrase whose words occur nowhere else: half of it.
SCALE = 2_000_000
#: Parts in which the best of a language are chosen first.
SALTS = 64
#: Bytes of text that a task works on at once, and phrases that it remembers to have named.
SLICE_BYTES, SENT = 3_000_000, 4_000_000
#: Where a text is parted: no word has this character.
_MARK = "."
_PARTING = r"[.,;:!?\x0A-\x0D]+"
_SEED = np.uint64(0x9E3779B97F4A7C15)


def parsed(docs: DataFrame, chunk: int = CHUNK, longest: int = LONGEST) -> DataFrame:
    """The dictionary `(lang, chunk, core, n_words, n)`: words of the chunk's core, marks among
    them, words of the core without marks, and how often the chunk occurs."""
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.sliced(batches, limit=SLICE_BYTES):
            yield _chunks(batch, chunk, longest)

    schema = "lang string, chunk string, core int, n_words int, n long"
    cut_up = rows.mapInArrow(cut, schema)
    return cut_up.groupBy("lang", "chunk", "core", "n_words").agg(F.sum("n").alias("n"))


def _chunks(batch: pa.RecordBatch, chunk: int, longest: int) -> pa.RecordBatch:
    filled = pc.ascii_lower(words.filled_in(batch["text"]))
    flat, starts = words.flat(pc.replace_substring_regex(filled, _PARTING, f" {_MARK} "))
    coded = flat.dictionary_encode()
    vocabulary = coded.dictionary.cast(pa.large_binary()).to_pylist()
    codes = coded.indices.to_numpy()
    mark = vocabulary.index(_MARK.encode()) if _MARK.encode() in vocabulary else -1
    hashes = words.hash_all(vocabulary)[codes] if len(codes) else np.empty(0, np.uint64)
    before = np.concatenate([[_SEED], hashes[:-1]]) if len(codes) else hashes
    cuts = words.chained(before, hashes) % np.uint64(chunk) == 0
    heads = starts[:-1][np.diff(starts) > 0]
    cuts[heads] = True
    begins = np.flatnonzero(cuts)
    # A core without a cut for long is cut by the number of words from its own beginning.
    sizes = np.diff(np.append(begins, len(codes)))
    pieces = -(-sizes // MOST_CHUNK)
    within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begins = np.repeat(begins, pieces) + within * MOST_CHUNK
    ends = np.append(begins[1:], len(codes))
    text_ends = starts[1:][np.searchsorted(starts[1:], begins, side="right")] if len(begins) else ends
    # Words beyond the core, up to the next mark or the end of the text.
    marks = np.append(np.flatnonzero(codes == mark), len(codes))
    next_mark = marks[np.searchsorted(marks, np.maximum(ends - 1, 0))] if len(begins) else ends
    over = np.minimum(np.minimum(ends + longest - 1, text_ends), np.maximum(next_mark, ends))
    spans = over - begins
    offsets = np.concatenate([[0], np.cumsum(spans)])
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - begins, spans)
    # A text is under 2 GB, so offsets of 32 bits do.
    taken = flat.take(pa.array(at)).cast(pa.string())
    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), taken)
    texts = pc.binary_join(lists, " ")
    so_far = np.concatenate([[0], np.cumsum(codes != mark)])
    of_text = np.searchsorted(starts[1:], begins, side="right")
    table = pa.table(
        {
            "lang": batch["lang"].take(pa.array(of_text)),
            "chunk": texts,
            "core": pa.array((ends - begins).astype(np.int32)),
            "n_words": pa.array((so_far[ends] - so_far[begins]).astype(np.int32)),
        }
    )
    # Chunks that repeat within the batch are one row already.
    grouped = table.group_by(table.column_names).aggregate([([], "count_all")])
    grouped = grouped.rename_columns([*table.column_names, "n"]).combine_chunks()
    names = ["lang", "chunk", "core", "n_words", "n"]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([], k) if not grouped.num_rows else grouped[n].combine_chunks().cast(k)
            for n, k in zip(names, kinds, strict=True)
        ],
        names,
    )


class Known(NamedTuple):
    """Hashes of frequent phrases as a broadcast map, and its power of two."""

    shared: Broadcast
    power: int

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        return bits.holds(self.shared.value[0], bits.cells(hashes, self.power))


def known_by(found: DataFrame) -> Known:
    """The map of the keys of some phrases."""
    power = bits.width(found.count(), 32)
    once, _ = bits.counted(found, ["key"], power)
    return Known(found.sparkSession.sparkContext.broadcast(once), power)


def frequent(
    dictionary: DataFrame, lengths: range, least: int, known: Known | None, part: int
) -> DataFrame:
    """`(key, n)` of all phrases of these lengths with `least` occurrences or more, of which all
    parts of `part` words are known."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.sliced(batches, "chunk", SLICE_BYTES):
            chunks = _read(batch)
            keys, weights = [], []
            for length in lengths:
                at, hashes = _whole(chunks, length, known, part)
                keys.append(hashes)
                weights.append(chunks.n[chunks.row[at]])
            own, n = _added(np.concatenate(keys), np.concatenate(weights))
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n)], ["key", "n"])

    counted = dictionary.select("lang", "chunk", "core", "n").mapInArrow(count, "key long, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def named(dictionary: DataFrame, known: list[tuple[range, Known]]) -> DataFrame:
    """`(key, lang, phrase, length)` of the phrases of known keys, and of few others."""

    of_length = {length: own for lengths, own in known for length in lengths}

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What a task has named is not sent again; the keys are those of what is frequent.
        sent = np.empty(0, np.uint64)
        for batch in words.sliced(batches, "chunk", SLICE_BYTES):
            chunks = _read(batch)
            at = np.flatnonzero(chunks.in_core & chunks.is_word)
            hashes = chunks.seeds[chunks.row[at]]
            for length, own in of_length.items():
                # A frequent phrase begins with a frequent one of a word less.
                last = at + length - 1
                inside = last < len(chunks.codes)
                at, hashes, last = at[inside], hashes[inside], last[inside]
                goes_on = chunks.is_word[last] & (chunks.row[last] == chunks.row[at])
                at, hashes, last = at[goes_on], hashes[goes_on], last[goes_on]
                hashes = words.chained(hashes, chunks.hashes[last])
                kept = own.holds(hashes)
                at, hashes = at[kept], hashes[kept]
                keys, first = np.unique(hashes, return_index=True)
                place = np.minimum(np.searchsorted(sent, keys), max(0, len(sent) - 1))
                new = sent[place] != keys if len(sent) else np.ones(len(keys), bool)
                yield _names(chunks, at[first[new]], keys[new], length)
                sent = np.sort(np.concatenate([sent, keys[new]]))
            if len(sent) > SENT:
                sent = np.empty(0, np.uint64)

    rows = dictionary.select("lang", "chunk", "core", "n").mapInArrow(
        name, "key long, lang string, phrase string, length int"
    )
    return rows.groupBy("key", "lang", "phrase", "length").agg(F.lit(1).alias("once")).drop("once")


class _Chunks(NamedTuple):
    vocabulary: list[bytes]
    codes: np.ndarray
    hashes: np.ndarray
    row: np.ndarray
    #: Is this token a word, and does it stand in the core?
    is_word: np.ndarray
    in_core: np.ndarray
    seeds: np.ndarray
    langs: pa.Array
    lang: np.ndarray
    n: np.ndarray


def _read(batch: pa.RecordBatch) -> _Chunks:
    flat, starts = words.flat(batch["chunk"].cast(pa.large_string()))
    coded = flat.dictionary_encode()
    vocabulary = coded.dictionary.cast(pa.large_binary()).to_pylist()
    codes = coded.indices.to_numpy()
    hashes = words.hash_all(vocabulary)[codes] if len(codes) else np.empty(0, np.uint64)
    mark = vocabulary.index(_MARK.encode()) if _MARK.encode() in vocabulary else -1
    sizes = np.diff(starts)
    row = np.repeat(np.arange(len(sizes)), sizes)
    in_core = np.arange(len(codes)) - starts[:-1][row] < batch["core"].to_numpy()[row]
    seeds, langs, lang = _language_seeds(batch["lang"])
    n = batch["n"].to_numpy()
    return _Chunks(vocabulary, codes, hashes, row, codes != mark, in_core, seeds, langs, lang, n)


def _whole(
    chunks: _Chunks, length: int, known: Known | None, part: int
) -> tuple[np.ndarray, np.ndarray]:
    """Where an n-gram begins in a core, of words of one piece, with all its parts known; and its
    hash."""
    n = max(0, len(chunks.codes) - length + 1)
    whole = chunks.in_core[:n].copy()
    for k in range(length):
        whole &= chunks.is_word[k : k + n] & (chunks.row[k : k + n] == chunks.row[:n])
    at = np.flatnonzero(whole)
    if known is not None:
        for k in range(length - part + 1):
            at = at[known.holds(_hashed(chunks, at + k, part))]
    return at, _hashed(chunks, at, length)


def _hashed(chunks: _Chunks, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of language and words from each place on."""
    found = chunks.seeds[chunks.row[at]]
    for k in range(length):
        found = words.chained(found, chunks.hashes[at + k])
    return found


def _added(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(weights[order], first) if len(keys) else weights


def _names(chunks: _Chunks, at: np.ndarray, keys: np.ndarray, length: int) -> pa.RecordBatch:
    phrases = [
        b" ".join([chunks.vocabulary[c] for c in chunks.codes[i : i + length].tolist()])
        for i in at.tolist()
    ]
    lang = chunks.langs.take(pa.array(chunks.lang[chunks.row[at]]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys.view(np.int64)),
            lang.cast(pa.string()),
            pa.array(phrases, pa.binary()).cast(pa.string()),
            pa.array(np.full(len(at), length, np.int32)),
        ],
        ["key", "lang", "phrase", "length"],
    )


def _language_seeds(langs: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """For each row its language's hash and code, and the languages."""
    coded = langs.dictionary_encode()
    names = coded.dictionary
    codes = coded.indices.to_numpy()
    return words.hash_all(x.encode() for x in names.to_pylist())[codes], names, codes


def counts(dictionary: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """`(lang, phrase, length, n)` of all phrases of up to `longest` words that are frequent."""
    found, known, maps = None, None, []
    steps = [range(1, 2), range(2, 3), range(3, longest + 1)]
    for step, lengths in enumerate(x for x in steps if x and x[0] <= longest):
        own = staged(frequent(dictionary, lengths, least, known, step), "frequent")
        known = known_by(own)
        maps.append((lengths, known))
        found = own if found is None else found.unionByName(own)
    return staged(found.join(named(dictionary, maps), "key").drop("key"), "phrases")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    inside: int = INSIDE,
    longest: int = LONGEST,
    chunk: int = CHUNK,
    salts: int = SALTS,
) -> DataFrame:
    """The first `top` phrases of each language: `lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`,
    `score`."""
    dictionary = staged(parsed(docs, chunk, longest), "chunks")
    every = dictionary.groupBy("lang").agg(
        F.sum(F.col("n_words").cast("long") * F.col("n")).alias("n")
    )
    known = counts(dictionary, least, longest)
    scored = _scored(known).join(_contained(known, inside), ["lang", "phrase"], "left_anti")
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    near = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    best = salted.withColumn("near", near).filter(F.col("near") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.join(every, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _scored(known: DataFrame) -> DataFrame:
    """Candidates with the parts and the score of their worst cut."""
    split = F.split("phrase", " ")
    cuts = (
        known.filter("length > 1")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
        .select(
            "lang",
            "phrase",
            F.col("n").alias("a"),
            "k",
            F.array_join(F.slice(split, F.lit(1), F.col("k")), " ").alias("first"),
            F.array_join(F.slice(split, F.col("k") + 1, F.col("length")), " ").alias("rest"),
        )
    )
    parts = known.select("lang", "phrase", "n")
    first = parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rest = parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    exact = "cast(a as decimal(20, 0))", "cast(l as decimal(20, 0)) + cast(r as decimal(20, 0))"
    score = F.expr(f"cast(({SCALE} * {exact[0]}) div ({exact[1]}) as long)")
    cuts = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"])
    worst = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")
    )
    return worst.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score")


def _contained(known: DataFrame, inside: int) -> DataFrame:
    """Candidates that a longer one stands for: it has nearly all their occurrences."""
    split = F.split("phrase", " ")
    lengths = F.sequence(F.lit(2), F.col("length") - 1)
    within = (
        known.filter("length > 2")
        .withColumn("size", F.explode(lengths))
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)))
        .select(
            "lang",
            F.array_join(F.slice(split, F.col("at"), F.col("size")), " ").alias("phrase"),
            F.col("n").alias("of_longer"),
        )
        .groupBy("lang", "phrase")
        .agg(F.max("of_longer").alias("of_longer"))
    )
    share = F.col("of_longer").cast("decimal(20, 0)") * 100 >= F.col("n").cast("decimal(20, 0)") * inside
    return within.join(known.select("lang", "phrase", "n"), ["lang", "phrase"]).filter(share).select(
        "lang", "phrase"
    )
