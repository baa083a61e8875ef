"""Texts of Arrow batches as arrays of words and code points."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

#: Bytes of text that a task holds at once; a longer text comes alone.
SLICE_BYTES = 4_000_000
#: Parts of a table that is dealt by ranges.
MOST_PARTS = 20_000


def sliced(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows in batches of bounded text, in order."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(first, stop - first)
            first = stop
    give_back()


def give_back() -> None:
    """Memory that a task has freed goes back to the system: its worker lives on, beside those of
    other stages and the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Words(NamedTuple):
    """Words of a batch: `vocabulary[codes[starts[i]:starts[i + 1]]]` are those of text i."""

    starts: np.ndarray
    codes: np.ndarray
    vocabulary: list[bytes]

    def hashes(self) -> np.ndarray:
        """XXH64 of each word of the vocabulary."""
        return hash_all(self.vocabulary)


def hash_all(values: Iterable[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(v) for v in values), np.uint64)


def filled_in(texts: pa.Array) -> pa.Array:
    """Empty texts for nulls, in an array of its own: `ascii_lower` of a slice goes wrong."""
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    return filled.take(pa.array(np.arange(len(filled))))


def flat(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and where each text's begin (and the last one's end)."""
    lists = pc.ascii_split_whitespace(texts)
    every = lists.flatten()
    kept = pc.not_equal(pc.binary_length(every), 0)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    so_far = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])
    return every.filter(kept), so_far[offsets - offsets[0]]


def split(texts: pa.Array, lower: bool = True) -> Words:
    """Words between space, tab, line feed, vertical tab, form feed, return; A-Z lower-cased.

    A null text has no words.
    """
    filled = filled_in(texts)
    words, starts = flat(pc.ascii_lower(filled) if lower else filled)
    coded = words.dictionary_encode()
    vocabulary = coded.dictionary.cast(pa.large_binary()).to_pylist()
    return Words(starts, coded.indices.to_numpy(), vocabulary)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def chained(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of all but its last element and that element's."""
    return mixed(before * np.uint64(0x9E3779B97F4A7C15) + last)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts."""
    total = docs.selectExpr(f"sum(octet_length(`{column}`)) AS total").first()["total"]
    return int(total or 0)


def parts_of(docs: DataFrame, part_bytes: int, column: str = "text") -> int:
    """Parts of about `part_bytes` of text; a task reads a part row by row, so any size will do
    and there need not be more than `MOST_PARTS`."""
    return max(1, min(MOST_PARTS, -(-text_bytes(docs, column) // part_bytes)))
