"""Token ids of documents in Simple-8b files, in ascending doc_id order.

A file is a table of segments, written and read with Spark's Parquet reader and writer, so it
may lie in any store and a lost task leaves nothing half written. A segment holds up to
`SEGMENT` ids, more only for a single document that has more:

    part, segment    its place: parts ascend by doc_id, segments ascend in a part
    doc_ids, sizes   documents that begin and end in it, and the number of ids of each
    n_tokens         ids in the segment
    words            64-bit little-endian words; the top 4 bits are the selector, the rest holds
                     ids from the lowest bits on
    offsets          where each block of `BLOCK` ids begins in `words`, 32-bit little-endian
    escapes          64-bit values that no word holds; selector 15 gives the index of one

Blocks are packed by themselves, so all blocks of a segment are packed and unpacked at once, and
one can be read without the others.

A null text is encoded like an empty one; every document has at least the end id. Rows of the
same doc_id follow each other in the order of their texts; a null doc_id comes first.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scdflow.sources.shared import staged

from . import words

#: Ids and documents of a segment, and ids of a block.
SEGMENT, SEGMENT_DOCS, BLOCK = 1_000_000, 20_000, 128
#: (ids, bits) that each selector packs; the first stands for a run of zeros.
PACKINGS = (
    (120, 0),
    (60, 1),
    (30, 2),
    (20, 3),
    (15, 4),
    (12, 5),
    (10, 6),
    (8, 7),
    (7, 8),
    (6, 10),
    (5, 12),
    (4, 15),
    (3, 20),
    (2, 30),
    (1, 60),
)
#: The selector of a value of over 60 bits: the word holds its index in the escapes.
ESCAPE = 15
#: Words whose ids a Python worker remembers, and bytes of text that it encodes at once.
REMEMBERED, SLICE = 800_000, 6_000_000
#: Bytes of text of a part.
PART_BYTES = 32_000_000


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, offsets of blocks, escapes) of unsigned 64-bit values."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    block_end = np.minimum(np.arange(1, blocks + 1) * BLOCK, n)
    escaped = np.flatnonzero(values >> np.uint64(60))
    escapes = values[escaped]
    small = values.copy()
    small[escaped] = 0
    need = _bits(small)
    need[escaped] = 64
    # A row a block; zeros behind the last id leave the last word of a block partly filled.
    grid = np.zeros((blocks, BLOCK), np.uint8)
    grid.reshape(-1)[:n] = need
    best = np.full((blocks, BLOCK), ESCAPE, np.int8)
    most, reach = grid, 1
    for selector in range(len(PACKINGS) - 1, -1, -1):
        count, bits = PACKINGS[selector]
        most, reach = _widest(grid, most, reach, count), count
        np.putmask(best, most <= bits, selector)
    best = best.reshape(-1)
    best[escaped] = ESCAPE
    # All blocks step from word to word together.
    counts = np.array([c for c, _ in PACKINGS] + [1])
    at = np.arange(blocks) * BLOCK
    live = np.arange(blocks)
    starts, owners = [], []
    while len(live):
        starts.append(at[live])
        owners.append(live)
        at[live] += counts[best[at[live]]]
        live = live[at[live] < block_end[live]]
    start = np.sort(np.concatenate(starts)) if starts else np.empty(0, np.int64)
    per_block = np.bincount(np.concatenate(owners), minlength=blocks) if starts else []
    offsets = np.cumsum(np.append(0, per_block))[:-1].astype(np.uint32)
    selector = best[start]
    packed = selector.astype(np.uint64) << np.uint64(60)
    padded = np.append(small, np.zeros(BLOCK, np.uint64))
    end = block_end[start // BLOCK] if n else start
    for s, (count, bits) in enumerate(PACKINGS):
        here = np.flatnonzero(selector == s)
        for k in range(count if bits else 0):
            value = np.where(start[here] + k < end[here], padded[start[here] + k], np.uint64(0))
            packed[here] |= value << np.uint64(k * bits)
    here = np.flatnonzero(selector == ESCAPE)
    packed[here] |= np.searchsorted(escaped, start[here]).astype(np.uint64)
    return packed, offsets, escapes


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value takes; halves, since a float has 53 exact ones."""
    low = np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    high = values >> np.uint64(32)
    if high.any():
        low = np.where(high > 0, 32 + np.frexp(high.astype(np.float64))[1], low)
    return low.astype(np.uint8)


def _widest(grid: np.ndarray, most: np.ndarray, reach: int, count: int) -> np.ndarray:
    """Most bits of the next `count` ids in the block, from those of the next `reach`."""
    while reach < count:
        ahead = min(reach, count - reach)
        step = most.copy()
        # Both windows overlap or touch; together they are `reach + ahead` long.
        shift = ahead
        if shift < grid.shape[1]:
            np.maximum(step[:, :-shift], most[:, shift:], out=step[:, :-shift])
        most, reach = step, reach + ahead
    return most


def unpack(packed: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The values again; any run of whole blocks can be read by itself."""
    selector = (packed >> np.uint64(60)).astype(np.int64)
    counts = np.array([c for c, _ in PACKINGS] + [1])[selector]
    before = np.cumsum(counts) - counts
    block = np.zeros(len(packed), np.int64)
    block[offsets[1:]] = 1
    block = np.cumsum(block)
    start = block * BLOCK + before - before[offsets][block] if len(packed) else before
    end = np.minimum((block + 1) * BLOCK, n)
    values = np.zeros(n, np.uint64)
    for s, (count, bits) in enumerate(PACKINGS):
        here = np.flatnonzero(selector == s)
        mask = np.uint64((1 << bits) - 1)
        for k in range(count if bits else 0):
            place = start[here] + k
            inside = place < end[here]
            values[place[inside]] = (packed[here[inside]] >> np.uint64(k * bits)) & mask
    here = np.flatnonzero(selector == ESCAPE)
    values[start[here]] = escapes[(packed[here] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return values


class Encoder:
    """Ids of whole texts; words that white space parts are encoded once and remembered.

    The tokenizer must part texts at white space. `lower` says that it is a byte-level one that
    also lower-cases and parts letters from punctuation: then so do we beforehand, fewer words
    differ, and words of small letters go straight to its model.
    """

    def __init__(self, path: str, end_id: int, lower: bool):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.lower = lower
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        # Word i has the ids `ids[first[i]:first[i + 1]]`; the end id is word 0, which no text has.
        self.words = pa.array([" "], pa.large_string())
        self.ids = np.array([end_id], np.uint32)
        self.first = np.array([0, 1])

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id, number of each)."""
        filled = words.filled_in(texts)
        # A special token is matched in the text as it stands.
        if self.lower and not pc.any(pc.match_substring(filled, "<|")).as_py():
            filled = pc.ascii_lower(filled)
            filled = pc.replace_substring_regex(filled, r"([a-zß-öø-ÿ])([.,])(\s|$)", r"\1 \2\3")
        flat, starts = words.flat(filled)
        at = pc.index_in(flat, value_set=self.words)
        known, ids, first = self.words, self.ids, self.first
        if at.null_count:
            new = flat.filter(pc.is_null(at)).unique()
            known = pa.concat_arrays([known, new])
            pieces = [self._encoded(w) for w in new.to_pylist()]
            ids = np.append(ids, np.fromiter(chain.from_iterable(pieces), np.uint32))
            first = np.append(first, first[-1] + np.cumsum([len(p) for p in pieces]))
            at = pc.index_in(flat, value_set=known)
        if len(known) <= REMEMBERED:
            self.words, self.ids, self.first = known, ids, first
        # The end id stands behind the words of each text.
        codes = np.insert(at.to_numpy(), starts[1:], 0)
        many = np.diff(first)[codes]
        so_far = np.cumsum(many)
        take = np.repeat(first[codes] - (so_far - many), many)
        take += np.arange(len(take))
        ends = so_far[starts[1:] + np.arange(len(texts))]
        return ids[take], np.diff(np.append(0, ends))

    def _encoded(self, word: str) -> list[int]:
        if self.lower and _PLAIN.fullmatch(word):
            as_bytes = word if word.isascii() else word.translate(self.bytes)
            return [t.id for t in self.model.tokenize(as_bytes)]
        return self.tokenizer.encode(word, add_special_tokens=False).ids


#: Words of which a lower-casing byte-level tokenizer changes and parts nothing, bytes aside.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(path: str, end_id: int, lower: bool) -> Encoder:
    """One for all tasks of a Python worker."""
    key = path, end_id, lower
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


SEGMENT_SCHEMA = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("segment", T.IntegerType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("words", T.BinaryType()),
        T.StructField("offsets", T.BinaryType()),
        T.StructField("escapes", T.BinaryType()),
    ]
)


def write(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str, lower: bool = False
) -> None:
    """Encode `text` of all documents into `folder`, in ascending doc_id order.

    Rows of one doc_id come in the order of their texts' hashes, so that many of them, or many
    without one, are dealt to several parts. Only rows with the same text as well stay together.

    `tokenizer` is the path of a tokenizers file, which each executor reads; `lower` is as in
    `Encoder`.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = words.parts_of(narrow, PART_BYTES)
    tie = F.xxhash64("text")
    ordered = narrow.repartitionByRange(parts, "doc_id", tie).sortWithinPartitions(
        "doc_id", tie, "text"
    )
    segments = ordered.mapInArrow(_segments(tokenizer, end_id, lower), SEGMENT_SCHEMA)
    segments.write.option("compression", "zstd").parquet(folder)


def _segments(tokenizer: str, end_id: int, lower: bool) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, end_id, lower)
        part = TaskContext.get().partitionId()
        rows = _documents(encoder, batches)
        segment = 0
        while group := _segment(rows):
            doc_ids, ids = zip(*group, strict=True)
            values = np.concatenate(ids)
            packed, offsets, escapes = pack(values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([segment], pa.int32()),
                    pa.array([list(doc_ids)], pa.list_(pa.int64())),
                    pa.array([[len(x) for x in ids]], pa.list_(pa.int64())),
                    pa.array([len(values)], pa.int64()),
                    *(
                        pa.array([x.tobytes()], pa.binary())
                        for x in (packed.astype("<u8"), offsets.astype("<u4"), escapes.astype("<u8"))
                    ),
                ],
                SEGMENT_SCHEMA.names,
            )
            segment += 1

    return encode


def _documents(encoder: Encoder, batches) -> Iterator[tuple[int | None, np.ndarray]]:
    for batch in words.sliced(batches, limit=SLICE):
        ids, sizes = encoder.batch(batch["text"])
        ends = np.cumsum(sizes)[:-1]
        yield from zip(batch["doc_id"].to_pylist(), np.split(ids, ends), strict=True)


def _segment(rows: Iterator) -> list:
    """Documents of the next segment."""
    group, size = [], 0
    for row in islice(rows, SEGMENT_DOCS):
        group.append(row)
        size += len(row[1])
        if size >= SEGMENT:
            break
    return group


def read(spark: SparkSession, folder: str) -> DataFrame:
    """`(doc_id, start, ids)` of the documents in a folder of segments."""
    schema = "doc_id long, start long, ids array<long>"
    return _each(spark, folder, lambda ids: ids.astype(np.int64), pa.list_(pa.int64()), schema)


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """`(doc_id, start, n_tokens, ids_crc32)` of the documents in a folder of segments."""
    crc = _each(
        spark,
        folder,
        lambda ids: (len(ids), zlib.crc32(ids.astype("<u4").tobytes())),
        pa.struct([("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]),
        "doc_id long, start long, ids struct<n_tokens: long, ids_crc32: long>",
    )
    return crc.select("doc_id", "start", "ids.n_tokens", "ids.ids_crc32")


def _each(spark: SparkSession, folder: str, made: Callable, kind, schema: str) -> DataFrame:
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(folder)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {n: batch[n][row].as_py() for n in batch.schema.names}
                values = unpack(
                    np.frombuffer(one["words"], "<u8"),
                    np.frombuffer(one["offsets"], "<u4"),
                    np.frombuffer(one["escapes"], "<u8"),
                    one["n_tokens"],
                )
                ends = np.cumsum(one["sizes"])
                documents = np.split(values, ends[:-1])
                start = one["start"] + ends - np.array(one["sizes"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one["doc_ids"], pa.int64()),
                        pa.array(start, pa.int64()),
                        pa.array(
                            [
                                v if not isinstance(v, tuple) else dict(zip([f.name for f in kind], v, strict=True))
                                for v in map(made, documents)
                            ],
                            kind,
                        ),
                    ],
                    ["doc_id", "start", "ids"],
                )

    starts = staged(_starts(segments), "starts")
    return segments.join(starts, ["part", "segment"]).mapInArrow(decode, schema)


def _starts(segments: DataFrame) -> DataFrame:
    """Ids before each segment: first those of earlier parts, then of the part's earlier ones."""
    sizes = segments.select("part", "segment", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("part", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("segment")
    earlier = F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return sizes.join(before, "part").select(
        "part", "segment", (F.col("before") + F.coalesce(earlier, F.lit(0))).alias("start")
    )
