"""Benchmark decontamination: rare word n-grams as seeds, Smith-Waterman alignment to decide.

A benchmark item leaks into a document if the best local alignment of their words scores at
least `SCORE` (0.7) of the item's length: a match counts 1, a mismatch or a gap -1/2 (A-Z
lower-cased). So an item may have a fifth of its words replaced (0.8 - 0.1), or three fifths of
its length put in between, or three tenths missing at an end. An item of `EXACT` (4) words or
fewer leaks only as it is.

The search looks along seeds. An item's seeds are its 3-grams (pairs for items of 5 words, whole
items for shorter ones); of a longer item than `ALL_SEEDS` words, the one of each two neighbours
that is rarer in the documents. An item with g words replaced, put in or taken out has a run of
(0.8 L) / (g + 1) words or more that are as they were: at g up to a fifth of the words that is a
seed at every length, so no such copy is lost; a copy with more changes is found if a seed is
left of it. The alignment stays within its errors of the seed's diagonal, so a window of the
document is enough. A window is aligned unless it has too few of the item's words for the score.

Items are taken in blocks of a bounded number of words. A block is broadcast, and the documents
are read without any shuffle: no document, hot passage or hot source meets in one task. Places
at which a text and an item share a seed are gathered by bands of diagonals, a bounded number at
a time, however many items share the seed. Of the bands found, those are left out whose window
has too few of the item's words to reach the score: a bound, so no leak is lost.

Null and empty items match nothing; null and empty texts leak nothing. A long text is one batch,
in memory of some fifty times its size. Repeated rows are judged alike, each by itself. Of equal
alignments of an item the first one's place is told.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words

#: Words of a seed, and of the longest item that has to be there as it is.
SEED, EXACT = 3, 4
#: Items of up to so many words keep all their seeds.
ALL_SEEDS = 16
#: Share of an item's words that the alignment's score must reach; what a match counts, and an
#: error takes off, in halves.
SCORE, MATCH, ERROR = 0.7, 2, 1
#: Places of seeds that are taken at once; candidates, and words of each, that are looked up at once.
AT_ONCE, CHECKED, CHECKED_WORDS = 1_000_000, 50_000, 16
#: Words of benchmark items that are broadcast at once; an item that has more comes alone.
BLOCK_WORDS = 500_000
#: Cells of the alignment matrices' rows that a task computes at once.
CELLS = 60_000


class Block(NamedTuple):
    """Items and their seeds; `seeds` is sorted, `at[first[s]:first[s + 1]]` are its places."""

    ids: np.ndarray
    starts: np.ndarray
    words: np.ndarray
    #: Lengths of the seeds; a seed's hash tells its length too.
    lengths: list[int]
    seeds: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SCORE,
    block_words: int = BLOCK_WORDS,
    shortest: int = 1,
) -> DataFrame:
    """A row per document and item that leaks into it: score and place of the best alignment.

    Items of fewer than `shortest` words are left out.
    `doc_id`, `item_id`, `score` (0 to 1), `item_words`, `first_word`, `last_word` (the span in
    the document's words, from 0).
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("item_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("item_words", T.IntegerType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("last_word", T.LongType()),
        ]
    )
    narrow = docs.select("doc_id", "text")
    found = None
    for shared in _shared_blocks(narrow, benchmark, block_words, shortest):
        part = narrow.mapInArrow(_finder(shared, similarity), schema)
        found = part if found is None else found.unionAll(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SCORE,
    block_words: int = BLOCK_WORDS,
    shortest: int = EXACT + 1,
) -> DataFrame:
    """The documents into which no item leaks, all columns kept.

    Items of fewer than `shortest` words are left out: everyday phrases are in clean texts.
    """
    kept = docs
    for shared in _shared_blocks(docs.select("text"), benchmark, block_words, shortest):
        kept = kept.mapInArrow(_filter(shared, similarity), docs.schema)
    return kept


def _shared_blocks(
    docs: DataFrame, benchmark: DataFrame, block_words: int, shortest: int
) -> Iterator:
    context = docs.sparkSession.sparkContext
    for items in _item_blocks(benchmark, block_words, shortest):
        everything = _block(*items, None)
        if len(everything.seeds):
            counts = _frequencies(docs, context.broadcast(everything), len(everything.seeds))
            yield context.broadcast(_block(*items, counts))


def _item_blocks(
    benchmark: DataFrame, block_words: int, shortest: int
) -> Iterator[tuple[list, list]]:
    """(ids, word hashes) of items, as many as have `block_words` words."""
    rows = (
        benchmark.select(F.col("item_id").cast("long"), "text")
        .filter(F.col("text").isNotNull())
        .distinct()
    )
    ids: list[int] = []
    hashes: list[np.ndarray] = []
    held = 0
    for row in rows.toLocalIterator():
        parts = words.split(pa.array([row["text"]], pa.string()))
        if len(parts.codes) < max(1, shortest):
            continue
        if ids and held + len(parts.codes) > block_words:
            yield ids, hashes
            ids, hashes, held = [], [], 0
        held += len(parts.codes)
        ids.append(row["item_id"])
        hashes.append(parts.hashes()[parts.codes])
    if ids:
        yield ids, hashes


def _seed_length(size: int) -> int:
    return size if size <= EXACT else SEED if size > EXACT + 1 else SEED - 1


def _grams(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the n-gram that begins at each word; n - 1 shorter than the words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    gram = words.chained(np.full(n, length, np.uint64), hashes[:n])
    for k in range(1, length):
        gram = words.chained(gram, hashes[k : n + k])
    return gram


def _block(ids: list, hashes: list[np.ndarray], counts: dict[int, int] | None) -> Block:
    """All n-grams as seeds or, with their counts in the documents, the rare ones."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i, item in enumerate(hashes):
        grams = _grams(item, _seed_length(len(item)))
        places = np.arange(len(grams))
        if counts is not None and len(item) > ALL_SEEDS:
            often = np.array([counts.get(g, 0) for g in grams.tolist()])
            rarer = np.where(often[1:] < often[:-1], places[1:], places[:-1])
            places = np.unique(rarer)
        found.append((grams[places], np.full(len(places), i), places))
    gram, item, place = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(gram, kind="stable")
    seeds, first = np.unique(gram[order], return_index=True)
    table = np.zeros(1 << 20, bool)
    table[seeds >> np.uint64(44)] = True
    return Block(
        np.array(ids, dtype=object),
        np.concatenate([[0], np.cumsum([len(x) for x in hashes])]),
        np.concatenate(hashes),
        sorted({_seed_length(len(x)) for x in hashes}),
        seeds,
        np.append(first, len(gram)),
        item[order],
        place[order],
        table,
    )


def _hits(block: Block, batch: pa.RecordBatch) -> tuple[words.Words, np.ndarray, ...]:
    """Words of the batch, their hashes, and for each seed found: text, place, seed."""
    parts = words.split(batch["text"])
    hashes = parts.hashes()[parts.codes] if len(parts.codes) else np.empty(0, np.uint64)
    found = []
    for length in block.lengths:
        grams = _grams(hashes, length)
        at = np.flatnonzero(block.table[grams >> np.uint64(44)])
        seed = np.searchsorted(block.seeds, grams[at])
        known = block.seeds[np.minimum(seed, len(block.seeds) - 1)] == grams[at]
        at, seed = at[known], seed[known]
        text = np.searchsorted(parts.starts, at, side="right") - 1
        inside = at + length <= parts.starts[text + 1]
        found.append((text[inside], at[inside], seed[inside]))
    return parts, hashes, *(np.concatenate(x) for x in zip(*found, strict=True))


def _frequencies(docs: DataFrame, shared, seeds: int) -> dict[int, int]:
    """How often each seed stands in the documents; as many entries as the block has seeds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        total = np.zeros(len(block.seeds), np.int64)
        for batch in words.sliced(batches):
            total += np.bincount(_hits(block, batch)[4], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["seed", "n"])

    counted = docs.select("text").mapInArrow(count, "seed long, n long")
    rows = counted.groupBy("seed").agg(F.sum("n").alias("n")).collect()
    of = shared.value.seeds.tolist()
    return {of[r["seed"]]: r["n"] for r in rows}


def _finder(shared, similarity: float) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.sliced(batches):
            text, item, score, first, last = _best(shared.value, batch, similarity)
            sizes = np.diff(shared.value.starts)[item]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(text)),
                    pa.array(shared.value.ids[item].tolist(), pa.int64()),
                    pa.array(score / sizes, pa.float64()),
                    pa.array(sizes, pa.int32()),
                    pa.array(first, pa.int64()),
                    pa.array(last, pa.int64()),
                ],
                ["doc_id", "item_id", "score", "item_words", "first_word", "last_word"],
            )

    return find


def _filter(shared, similarity: float) -> Callable:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.sliced(batches):
            kept = np.ones(batch.num_rows, bool)
            kept[_best(shared.value, batch, similarity)[0]] = False
            yield batch.filter(pa.array(kept))

    return keep


def _candidates(
    block: Block,
    parts: words.Words,
    similarity: float,
    text: np.ndarray,
    at: np.ndarray,
    seed: np.ndarray,
) -> np.ndarray:
    """Text, item and band of diagonals of all that is to be aligned, each once.

    Places of a seed in the items are taken a bounded number at a time, and what cannot reach the
    score, for too few of the item's words are there, is left out before the next are taken.
    """
    many = block.first[seed + 1] - block.first[seed]
    sizes = np.diff(block.starts)
    stands = _stands(parts)
    kept: list[np.ndarray] = []
    ends = np.cumsum(many)
    low = 0
    while low < len(at):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + AT_ONCE, side="right")))
        own = slice(low, high)
        row = np.repeat(np.arange(low, high), many[own])
        of = np.arange(len(row)) - np.repeat(ends[own] - many[own] - done, many[own]) + block.first[seed[row]]
        item = block.item[of]
        width = np.maximum(1, sizes[item] // 4)
        band = (at[row] - parts.starts[text[row]] - block.place[of]) // width
        low = high
        triple = np.unique(np.stack([text[row], item, band]), axis=1)
        for some in range(0, triple.shape[1], CHECKED):
            part = triple[:, some : some + CHECKED]
            kept.append(part[:, _enough(block, parts, stands, similarity, *part)])
    return np.unique(np.concatenate(kept, axis=1), axis=1) if kept else np.empty((3, 0), np.int64)


def _windows(
    block: Block, starts: np.ndarray, similarity: float, text, item, band
) -> tuple[np.ndarray, np.ndarray]:
    """Where in their texts the alignments of some candidates lie."""
    size = np.diff(block.starts)[item]
    width = np.maximum(1, size // 4)
    # As many words more or less as errors leave the score that is wanted.
    gaps = np.floor((1 - similarity) * MATCH / ERROR * size + 1e-9).astype(np.int64)
    gaps[size <= EXACT] = 0
    low = np.maximum(0, band * width - gaps)
    return low, np.minimum(np.diff(starts)[text], band * width + width + size + gaps)


def _stands(parts: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """The batch's words in order, and their places: number of the word, then place, as one."""
    own = parts.hashes()
    order = np.argsort(own)
    number = np.empty(len(own), np.int64)
    number[order] = np.arange(len(own))
    n = len(parts.codes)
    return own[order], np.sort(number[parts.codes] * (n + 1) + np.arange(n))


def _enough(
    block: Block, parts: words.Words, stands, similarity: float, text, item, band
) -> np.ndarray:
    """Which candidates may reach the score: a match takes a word of the item and one of the window,
    so as many of the item's words must stand there as the score counts."""
    known, places = stands
    low, high = _windows(block, parts.starts, similarity, text, item, band)
    low, high = parts.starts[text] + low, parts.starts[text] + high
    size = np.diff(block.starts)[item]
    wanted = np.where(size <= EXACT, 1.0, similarity)
    # Words that may be missing; most candidates miss as many among the first ones.
    left = size - np.ceil(wanted * size - 1e-9).astype(np.int64)
    alive = np.arange(len(item))
    n = places.size + 1
    for first in range(0, int(size.max(initial=0)), CHECKED_WORDS):
        own = alive[size[alive] > first]
        if not len(own):
            break
        at = first + np.arange(CHECKED_WORDS)
        inside = at < size[own][:, None]
        word = block.words[np.where(inside, block.starts[item[own]][:, None] + at, 0)]
        number = np.minimum(np.searchsorted(known, word), len(known) - 1)
        here = known[number] == word
        next_one = np.searchsorted(places, number * n + low[own][:, None])
        there = places[np.minimum(next_one, len(places) - 1)]
        here &= (there >= number * n + low[own][:, None]) & (there < number * n + high[own][:, None])
        left[own] -= (inside & ~here).sum(axis=1)
        alive = alive[left[alive] >= 0]
    return alive


def _best(block: Block, batch: pa.RecordBatch, similarity: float) -> tuple[np.ndarray, ...]:
    """Text, item, score, first and last word of the best alignment of each leak."""
    parts, hashes, text, at, seed = _hits(block, batch)
    empty = tuple(np.empty(0, np.int64) for _ in range(5))
    if not len(at):
        return empty
    in_order = np.lexsort((at, text))
    found = _candidates(
        block, parts, similarity, text[in_order], at[in_order], seed[in_order]
    )
    text, item, band = found
    size = np.diff(block.starts)[item]
    low, high = _windows(block, parts.starts, similarity, text, item, band)
    score, last = _align(block, item, hashes, parts.starts[text] + low, high - low)
    wanted = np.where(size <= EXACT, 1.0, similarity)
    good = np.flatnonzero(score >= wanted * MATCH * size - 1e-9)
    if not len(good):
        return empty
    text, item, score, low = text[good], item[good], score[good], low[good]
    # The same alignment backwards from its end gives its start.
    length = last[good] + 1
    _, back = _align(block, item, hashes, parts.starts[text] + low, length, backwards=True)
    first, last = low + length - 1 - back, low + length - 1
    order = np.lexsort((first, -score, item, text))
    text, item = text[order], item[order]
    one = np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]))
    return text[one], item[one], score[order][one] / MATCH, first[order][one], last[order][one]


def _align(
    block: Block,
    item: np.ndarray,
    hashes: np.ndarray,
    start: np.ndarray,
    length: np.ndarray,
    backwards: bool = False,
) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each item in its window, in halves, and the last word it takes there."""
    sizes = np.diff(block.starts)[item]
    score, end = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
    order = np.lexsort((length, sizes))
    at = 0
    while at < len(order):
        many = max(1, CELLS // max(1, int(length[order[at]])))
        some = order[at : at + many]
        at += len(some)
        score[some], end[some] = _align_some(
            block, item[some], sizes[some], hashes, start[some], length[some], backwards
        )
    return score, end


def _align_some(block, item, sizes, hashes, start, length, backwards):
    width = int(length.max())
    column = np.arange(width)
    inside = column < length[:, None]
    from_end = length[:, None] - 1 - column if backwards else column
    window = hashes[np.where(inside, start[:, None] + from_end, start[:, None])]
    above = np.zeros((len(item), width + 1), np.int32)
    best = np.zeros(len(item), np.int32)
    end = np.zeros(len(item), np.int64)
    slope = np.arange(width + 1, dtype=np.int32) * ERROR
    for i in range(int(sizes.max())):
        live = i < sizes
        place = np.where(live, sizes - 1 - i if backwards else i, 0)
        word = block.words[block.starts[item] + place]
        same = (window == word[:, None]) & inside & live[:, None]
        row = np.zeros_like(above)
        step = np.where(same, MATCH, -ERROR)
        row[:, 1:] = np.maximum(above[:, :-1] + step, above[:, 1:] - ERROR)
        np.maximum(row, 0, out=row)
        # A gap in the item may be of any length: the best start to the left, less its distance.
        row = np.maximum.accumulate(row + slope, axis=1) - slope
        most = row[:, 1:].argmax(axis=1)
        value = row[np.arange(len(item)), most + 1]
        better = live & (value > best)
        best[better], end[better] = value[better], most[better]
        above = row
    return best, end
