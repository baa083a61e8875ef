"""Document fingerprints by Order MinHash (Marcais et al., 2019): alike at a small edit distance.

The elements of a text are its k-mers of code points, each with the number of times that it has
occurred before. Each of `SKETCHES` hash functions selects the `TUPLE` elements of least value;
they are put in the order of the text and hashed together. Two texts share a tuple if they share
the selected k-mers in the same order, so a fingerprint feels both edits and moved passages.
`likeness` is the share of equal tuples, to the power 1 / `TUPLE`: about the share of k-mers kept
in order; 1 for equal texts.

A text shorter than a k-mer is one k-mer, an empty one has the one element "nothing"; a text with
fewer elements than `TUPLE` hashes all it has. A null text is fingerprinted like an empty one.
All of a text counts: its k-mers' hashes are held in memory, some 60 bytes a code point, and
selected from in pieces of `PIECE`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scdflow.sources.shared import staged

from . import words

#: Code points of a k-mer, elements of a tuple, tuples of a fingerprint.
K, TUPLE, SKETCHES = 8, 2, 32
#: K-mers that are hashed at once.
PIECE = 8192
#: Bytes of text of a part.
PART_BYTES = 8_000_000

_random = np.random.Generator(np.random.PCG64(42))
_XOR = _random.integers(0, 1 << 63, SKETCHES, dtype=np.uint64)[:, None]
_TIMES = _random.integers(0, 1 << 63, SKETCHES, dtype=np.uint64)[:, None] * 2 + 1


def fingerprint(text: str | None, k: int = K) -> np.ndarray:
    """`SKETCHES` 32-bit hashes."""
    elements = _elements(words.code_points(text or ""), k)
    n, many = len(elements), min(TUPLE, len(elements))
    chosen, values = [], []
    for low in range(0, n, PIECE):
        piece = elements[low : low + PIECE]
        value = ((piece ^ _XOR) * _TIMES).view(np.int64)
        for _ in range(min(many, len(piece))):
            least = value.argmin(axis=1)
            chosen.append(least + low)
            values.append(value[_ROWS, least])
            value[_ROWS, least] = np.iinfo(np.int64).max
    place, value = np.stack(chosen, axis=1), np.stack(values, axis=1)
    if place.shape[1] > many:
        first = np.lexsort((place, value), axis=1)[:, :many]
        place = np.take_along_axis(place, first, axis=1)
    place = np.sort(place, axis=1)
    made = np.arange(SKETCHES, dtype=np.uint64) + np.uint64(many)
    for i in range(many):
        made = words.chained(made, elements[place[:, i]])
    return (made >> np.uint64(32)).astype(np.uint32)


_ROWS = np.arange(SKETCHES)


def _elements(points: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k-mer and the times that it has occurred before."""
    n = max(1, len(points) - k + 1)
    gram = np.full(n, np.uint64(min(len(points), k)))
    for i in range(min(k, len(points))):
        gram = (gram ^ points[i : n + i]) * np.uint64(0x9E3779B97F4A7C15)
        gram ^= gram >> np.uint64(29)
    # Equal k-mers side by side, in the order of the text: the low bits of a key are its place.
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    keys = np.sort(((gram >> bits) << bits) | np.arange(n, dtype=np.uint64))
    same = keys >> bits
    new = np.append(True, same[1:] != same[:-1])
    if new.all():
        return words.mixed(gram)
    begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    times = np.zeros(n, np.uint64)
    at = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    times[at] = (np.arange(n) - begin).astype(np.uint64)
    return words.mixed(gram + times * np.uint64(0xD6E8FEB86659FD93))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b)) ** (1 / TUPLE)


def as_text(prints: np.ndarray) -> str:
    return prints.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame) -> DataFrame:
    """`(doc_id, fingerprint)`, the fingerprint as lower-case hex digits, 8 a tuple."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("fingerprint", T.StringType())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.sliced(batches):
            prints = [as_text(fingerprint(t)) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(prints, pa.string())], schema.names
            )

    return docs.select("doc_id", "text").mapInArrow(make, schema)


def with_next(docs: DataFrame, handle: Callable, schema: T.StructType | str) -> DataFrame:
    """`handle(rows, following)` for each document with the next one by ascending doc_id.

    `handle` gets an iterator of pairs `((doc_id, text), (doc_id, text))` and yields batches. The
    document after the last is the first. Documents are dealt to parts by ranges of doc_id; the
    first of each part also goes to the part before, so no part needs another. Rows of the same
    doc_id follow each other in the order of their texts' hashes, then texts; a null doc_id comes
    first. A doc_id with more text than two parts has parts of its own, ranges of the hash.
    """
    narrow = docs.select("doc_id", "text")
    parts = words.parts_of(narrow, PART_BYTES)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    ids = staged(narrow.select(key.alias("key"), F.xxhash64("text").alias("tie"), size.alias("size")), "ids")
    bounds, pieces = _plan(ids, parts)
    deal = _dealer(bounds, pieces)
    firsts = ids.groupBy(deal(F.col("key"), F.col("tie")).alias("part")).agg(
        F.min(F.struct("key", "tie")).alias("first")
    )
    # One row a part.
    begins = sorted((r["part"], *r["first"]) for r in firsts.collect())
    before = [(k, tie, begins[i - 1][0]) for i, (_, k, tie) in enumerate(begins)]
    tie = F.xxhash64("text")
    rows = narrow.select(
        deal(key, tie).alias("part"), F.lit(0).alias("after"), key.alias("key"), tie.alias("tie"), "doc_id", "text"
    )
    seams = docs.sparkSession.createDataFrame(before, "of_key long, of_tie long, part int")
    again = narrow.join(F.broadcast(seams), (key == F.col("of_key")) & (tie == F.col("of_tie")))
    again = again.groupBy("part", key.alias("key"), tie.alias("tie")).agg(
        F.min(F.struct(F.col("text").isNotNull().alias("known"), "text")).alias("least")
    )
    again = again.select(
        "part", F.lit(1).alias("after"), "key", "tie", F.lit(None).cast("long").alias("doc_id"), "least.text"
    )
    dealt = (
        rows.withColumn("doc_id", F.col("doc_id").cast("long"))
        .unionByName(again)
        .repartitionById(len(begins) and begins[-1][0] + 1 or 1, F.col("part").cast("int"))
        .sortWithinPartitions("part", "after", "key", "tie", "text")
    )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, tuple]]:
        last = None
        for batch in words.sliced(batches):
            columns = (batch[c].to_pylist() for c in ("part", "after", "doc_id", "text"))
            for part, after, doc_id, text in zip(*columns, strict=True):
                if last is not None and last[0] == part:
                    yield last[1], (doc_id, text)
                last = None if after else (part, (doc_id, text))

    return dealt.mapInArrow(lambda batches: handle(pairs(batches)), schema)


def _plan(ids: DataFrame, parts: int) -> tuple[list[int], dict[int, int]]:
    """Bounds of doc_id between parts, and hot ids, which stand alone, with their pieces."""
    large = ids.groupBy("key").agg(F.sum("size").alias("size")).filter(F.col("size") > 2 * PART_BYTES)
    # Fewer than there are parts.
    pieces = {r["key"]: -(-r["size"] // PART_BYTES) for r in large.collect()}
    shares = [(i + 1) / parts for i in range(parts - 1)]
    found = ids.select(F.percentile_approx("key", shares or [1.0], max(10_000, 20 * parts))).first()[0]
    bounds = set(found or []) if shares else set()
    for k in pieces:
        bounds |= {k, k - 1} if k > -(1 << 63) else {k}
    return sorted(bounds), pieces


def _dealer(bounds: list[int], pieces: dict[int, int]) -> Callable[[Column, Column], Column]:
    """The part of a row from its key and the hash of its text; parts are in the order of both."""
    hot = sorted(pieces)
    extra = [0]
    for k in hot:
        extra.append(extra[-1] + pieces[k] - 1)

    def part(key: Column, tie: Column) -> Column:
        own = _part(key, bounds)
        if not hot:
            return own.cast("int")
        at = _part(key, hot)
        is_hot = F.get(F.array(*(F.lit(k).cast("long") for k in hot)), at) == key
        many = F.get(F.array(*(F.lit(pieces[k]) for k in hot)), at)
        # The hash as a share of its range; doubles rise with it.
        share = (tie.cast("double") + float(1 << 63)) / float(1 << 64)
        piece = F.when(is_hot, F.least(F.floor(share * many), many - 1)).otherwise(F.lit(0))
        ahead = F.get(F.array(*(F.lit(x) for x in extra)), at)
        return (own + ahead + piece).cast("int")

    return part


def _part(key: Column, bounds: list[int]) -> Column:
    """How many bounds the key is over."""
    if not bounds:
        return F.lit(0)
    # Groups of bounds, then bounds of a group: the square root of all is looked at twice.
    step = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    lasts = F.array(*(F.lit(g[-1]).cast("long") for g in groups))
    listed = F.array(*(F.array(*(F.lit(b).cast("long") for b in g)) for g in groups))
    group = F.size(F.filter(lasts, lambda b: key > b))
    inside = F.when(group < len(groups), F.size(F.filter(F.get(listed, group), lambda b: key > b)))
    return F.coalesce(group * step + inside, F.lit(len(bounds)))


def compared(docs: DataFrame) -> DataFrame:
    """Each document against its edited text and the next document.

    The edited text: the last quarter of the code points, rounded down, replaced by the first as
    many of the next text, or all of them. `doc_id`, `n_chars`, `edited_sha256`, `fingerprint`,
    `edited_fingerprint`, and the likeness `near_edited`, `near_next`.
    """
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    names = [c.split()[0] for c in schema.split(", ")]

    def handle(pairs: Iterator[tuple[tuple, tuple]]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        known: tuple = (None, None)
        for (doc_id, text), (_, following) in pairs:
            text, following = text or "", following or ""
            own = known[1] if known[0] == text else fingerprint(text)
            known = following, fingerprint(following)
            n = len(text)
            edited = text[: n - n // 4] + following[: n // 4]
            changed = fingerprint(edited)
            digest = hashlib.sha256(edited.encode()).hexdigest()
            near = likeness(own, changed), likeness(own, known[1])
            rows.append((doc_id, n, digest, as_text(own), as_text(changed), *near))
            if len(rows) >= 1000:
                yield _batch(rows, names)
                rows = []
        if rows:
            yield _batch(rows, names)

    return with_next(docs, handle, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )
