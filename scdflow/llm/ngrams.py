"""LM scoring: a weighted backoff automaton over all the n-grams of the training documents.

A state is a context: the last words read, as many as the training texts have in this sequence.
Its arc for a word w that followed it there has the weight

    log10 P(w | context) = log10((c(context w) + mu P(w | shorter)) / (c(context) + mu))

and leads to the state of the words then read; any other word takes the failure arc, of weight
log10(mu / (c(context) + mu)), to the state of the shorter context, down to the root, whose arcs
are P(w) = (c(w) + a) / (N + a (V + 1)), that of an unseen word too. The probabilities of a state's
words add up to 1 (MacKay and Peto, 1995). A text's score is the sum of the weights on its way.

The counts grow with the documents, so no task holds them. They are dealt to shards by their
n-gram's hash. Documents are dealt to blocks of bounded text; a block asks each shard for the
counts of the distinct n-grams that it has, with its own training counts in the same message,
sorted and packed. A shard adds up the counts of all messages and answers each in its own order.
A block then has the states and arcs that its texts can
reach, and all its texts are walked through them side by side, each lane carrying its state. A
long text is several lanes: a state depends on the last words only, so a lane that begins inside
a text first reads these without weights. A hot n-gram is one entry a message. Rows that are equal
are one row with a weight, so a block holds each once.

Without a given `mu`, each length has its own, estimated from all training counts. Leave out a
token at a time: a context seen C times gives words it has not had mu / (C - 1 + mu), and the
tokens that were such words are those whose n-gram was seen once. The mu of a length makes the two
add up to the same over all contexts seen twice or more. Shards count contexts by powers of two
of C, and n-grams seen once, and send both with each answer; so every block has all of them.

Words are told apart by 64-bit hashes, of which the lowest bits give way to the length and to
whether an end is last; longer n-grams by as many bits as the texts' size wants for a chance of
at most 1 in 2^`SPARE` that two are one. Words as in `words.split`, then one end, which is a
token. A null text has no words, only the end. Rows of the same doc_id are scored each by itself.
A text is read whole by one task, slice by slice with others; a longer one than a slice comes
alone, in memory of some hundred times its size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.ipc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdflow.sources.shared import staged

from . import words

#: Words of the longest n-gram.
ORDER = 2
#: What a context's shorter one counts as, in words seen; the best of several on held-out texts.
MU = 1000.0
#: Added to a word's count.
ADDED = 0.1
#: Bytes of text of a block, and of text that gives a shard its n-grams, at least.
BLOCK_BYTES = 5_000_000
#: Bytes of text behind a message from a block to a shard, at least: over 100 GB of text, blocks
#: grow with its square root, since there are blocks times shards messages.
MESSAGE_BYTES = 250
#: Powers of two by which contexts are counted, and bounds of an estimated mu.
BINS, LEAST_MU, MOST_MU = 48, 1e-3, 1e6
#: Bytes of text that a task gathers before it packs them by block.
GATHERED_BYTES = 32_000_000
#: Bytes of text that a block works on at once; of a block whose slices are kept; tokens of a lane.
SLICE_BYTES, KEPT_BYTES, LANE = 2_500_000, 8_000_000, 256
#: Bits of an n-gram's hash beyond those that number the bytes of all texts.
SPARE = 18
#: Hashes of the ends of a text, which no word has: words are hashed as they are, these mixed.
END, BEGIN = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949C7DEFABE1EB3)


def score(docs: DataFrame, training: Column, order: int = ORDER, mu: float | None = MU) -> DataFrame:
    """`doc_id`, `held_out` (not in training), `n_tokens`, `n_known`, `train_tokens`, the log10
    probabilities `base_score` (of the root alone) and `score` of each document."""
    rows = _once(docs.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("training")))
    size = words.text_bytes(rows)
    blocks = max(1, -(-size // max(BLOCK_BYTES, math.isqrt(MESSAGE_BYTES * size))))
    texts = rows.withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    )
    bits = min(64, size.bit_length() + SPARE)
    # One job: packed documents are dealt to their blocks once, for the questions and the reading.
    dealt = texts.mapInArrow(_packing, "block int, pack binary").groupBy("block")
    asked = dealt.applyInArrow(
        _asking(blocks, order, bits), "shard int, block int, keys binary, counts binary"
    )
    told = asked.groupBy("shard").applyInArrow(
        _answering(order), "block int, shard int, counts binary, seen binary"
    )
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, weight long"
    )
    read = _reading(blocks, order, bits, mu)
    found = dealt.cogroup(told.groupBy("block")).applyInArrow(read, schema)
    copies = F.explode(F.array_repeat(F.lit(0), F.col("weight").cast("int")))
    return found.withColumn("copy", copies).drop("weight", "copy")


def _once(rows: DataFrame) -> DataFrame:
    """Equal rows as one, with their number as `weight`.

    They are found by their id and the hash of the text; only rows that come again are shuffled.
    """
    key = {"of_id": F.col("doc_id"), "of_hash": F.xxhash64("text")}
    hashed = rows.withColumns(key)
    again = hashed.groupBy(*key).agg(F.count("*").alias("weight")).filter("weight > 1")
    again = staged(again, "again")
    if again.isEmpty():
        return rows.withColumn("weight", F.lit(1).cast("long"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in key]
    single = hashed.alias("a").join(again.alias("b"), same, "left_anti").drop(*key)
    others = hashed.alias("a").join(again.alias("b"), same, "left_semi")
    merged = others.groupBy(*key, "training").agg(
        F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count("*").alias("weight")
    )
    columns = "doc_id", "text", "training", "weight"
    return single.withColumn("weight", F.lit(1).cast("long")).unionByName(merged.select(*columns))


def _packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block together, compressed: texts shrink far more than in a shuffle's own blocks."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in words.sliced(batches):
        held.append(batch)
        size += batch.nbytes
        if size >= GATHERED_BYTES:
            yield _packs(held)
            held, size = [], 0
    if held:
        yield _packs(held)


def _packs(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    order = np.argsort(table["block"].to_numpy(), kind="stable")
    table = table.take(pa.array(order)).combine_chunks()
    blocks, first = np.unique(table["block"].to_numpy(), return_index=True)
    rest = table.drop_columns("block")
    packs = []
    for low, high in zip(first, [*first[1:], table.num_rows], strict=True):
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        with pa.ipc.new_stream(sink, rest.schema, options=options) as writer:
            writer.write_table(rest.slice(low, high - low))
        packs.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks.astype(np.int32)), pa.array(packs, pa.binary())], ["block", "pack"]
    )


def _by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    """(shard, its part of the sorted keys); a shard that has none comes with none.

    Shards are ranges of the hash, so keys of a shard are close to each other.
    """
    shard = (keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
    ends = np.searchsorted(shard, np.arange(shards + 1))
    for i in range(shards):
        yield i, slice(ends[i], ends[i + 1])


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte of all: their high bytes are zero and shrink."""
    steps = keys.astype("<u8")
    steps[1:] -= keys[:-1]
    return _squeezed(steps)


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers(data), dtype=np.uint64)


def _squeezed(numbers: np.ndarray) -> bytes:
    """Integers byte by byte of all, compressed, behind how many there are."""
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _numbers(data: bytes) -> np.ndarray:
    size = 8 * int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)


def _unpacks(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The rows of a block, about a slice together."""
    held: list[pa.RecordBatch] = []
    size = 0
    for pack in table["pack"]:
        for batch in pa.ipc.open_stream(pack.as_buffer()):
            held.append(batch)
            size += batch.nbytes
        if size >= SLICE_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _slices(table: pa.Table) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of bounded text, the hash of each token, an end behind each text, and where each
    text begins."""
    for batch in words.sliced(_unpacks(table), limit=2 * SLICE_BYTES):
        parts = words.split(batch["text"])
        hashes = parts.hashes()[parts.codes] if len(parts.codes) else np.empty(0, np.uint64)
        starts = parts.starts + np.arange(len(parts.starts))
        yield batch, np.insert(hashes, parts.starts[1:], END), starts


def _grams(tokens: np.ndarray, starts: np.ndarray, order: int, bits: int = 64) -> list[np.ndarray]:
    """For each length, the hash of the n-gram that ends at each token.

    A text begins with one `BEGIN`, so its first token has no n-gram of over 2 words, and so on:
    there the hash is 0.
    """
    place = np.arange(len(tokens)) - np.repeat(starts[:-1], np.diff(starts))
    grams = [tokens]
    for n in range(2, order + 1):
        shorter = np.append(np.uint64(0), grams[-1][:-1])
        if n == 2:
            shorter[place == 0] = BEGIN
        gram = words.chained(shorter + np.uint64(n), tokens)
        gram[place < n - 2] = 0
        grams.append(gram)
    ended, tag = tokens == END, _tag_bits(order)
    lost = [np.uint64(max(tag, 64 - bits if n > 1 else 0)) for n in range(1, order + 1)]
    return [
        np.where(g == 0, g, g >> low << low | (np.uint64(2 * i) + ended.astype(np.uint64)))
        for i, (g, low) in enumerate(zip(grams, lost, strict=True))
    ]


def _tag_bits(order: int) -> int:
    return (2 * order - 1).bit_length()


class _Slice(NamedTuple):
    """Some texts of a block, and of each length their distinct n-grams."""

    rows: pa.RecordBatch
    starts: np.ndarray
    #: Sorted n-grams, a token where each ends, and of each token the number of that which ends there.
    keys: list[np.ndarray]
    first: list[np.ndarray]
    at: list[np.ndarray]
    tokens: np.ndarray


def _sliced(table: pa.Table, order: int, bits: int) -> Iterator[_Slice]:
    for rows, tokens, starts in _slices(table):
        found = [_placed(g) for g in _grams(tokens, starts, order, bits)]
        keys, first, at = (list(x) for x in zip(*found, strict=True))
        yield _Slice(rows, starts, keys, first, at, tokens)


def _placed(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(grams)
    in_order = grams[order]
    new = np.append(True, in_order[1:] != in_order[:-1])
    at = np.empty(len(grams), np.int64)
    at[order] = np.cumsum(new) - 1
    return in_order[new], order[new], at


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    """Sorted and each once: a plain sort is several times faster than one that keeps places."""
    every = np.sort(np.concatenate(parts))
    return every[np.append(True, every[1:] != every[:-1])]


def _taught(keys: np.ndarray, rows: pa.RecordBatch, starts: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """How often the training texts have each of the sorted n-grams."""
    weight = rows["weight"].to_numpy() * rows["training"].to_numpy(zero_copy_only=False)
    by_token = np.repeat(weight, np.diff(starts))
    found = np.zeros(len(keys))
    for times in np.unique(weight[weight > 0]):
        own = np.sort(grams[by_token == times])
        ends = np.searchsorted(own, keys, "right")
        found += times * (ends - np.searchsorted(own, keys, "left"))
    return found


def _asking(shards: int, order: int, bits: int) -> Callable:
    def ask(table: pa.Table) -> pa.Table:
        parts: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        for batch, tokens, starts in _slices(table):
            for grams in _grams(tokens, starts, order, bits):
                parts.append(_distinct([grams]))
                counts.append(_taught(parts[-1], batch, starts, grams))
        keys = _distinct(parts)
        taught = np.zeros(len(keys))
        for own, count in zip(parts, counts, strict=True):
            taught[np.searchsorted(keys, own)] += count
        rows = [
            (shard, _packed(keys[part]), _squeezed(taught[part]))
            for shard, part in _by_shard(keys, shards)
        ]
        shard, packed, counted = zip(*rows, strict=True)
        block = [table["block"][0].as_py()] * len(rows)
        return pa.table(
            {
                "shard": pa.array(shard, pa.int32()),
                "block": pa.array(block, pa.int32()),
                "keys": pa.array(packed, pa.binary()),
                "counts": pa.array(counted, pa.binary()),
            }
        )

    return ask


def _answering(order: int) -> Callable:
    def answer(table: pa.Table) -> pa.Table:
        keys = [_unpacked(x) for x in table["keys"].to_pylist()]
        every = _distinct(keys)
        places = [np.searchsorted(every, k) for k in keys]
        # A float is exact up to 2 to the 53rd.
        total = np.zeros(len(every))
        for at, count in zip(places, table["counts"].to_pylist(), strict=True):
            total[at] += _numbers(count)
        seen = _squeezed(_seen(every, total, order).reshape(-1))
        return pa.table(
            {
                "block": table["block"],
                "shard": table["shard"],
                "counts": pa.array([_squeezed(total[at]) for at in places], pa.binary()),
                "seen": pa.array([seen] * len(keys), pa.binary()),
            }
        )

    return answer


def _seen(keys: np.ndarray, total: np.ndarray, order: int) -> np.ndarray:
    """A row a length: contexts by powers of two of their counts, the sums of these, n-grams seen
    once; and a row of the distinct tokens, all tokens and the documents."""
    tags = (keys & np.uint64((1 << _tag_bits(order)) - 1)).astype(np.int64)
    found = np.zeros((order + 1, 2 * BINS + 1))
    tokens = (tags >> 1 == 0) & (keys != 0) & (total > 0)
    found[order, :3] = tokens.sum(), total[tokens].sum(), total[tokens & (tags & 1 == 1)].sum()
    for i in range(order):
        own = (tags >> 1 == i) & (keys != 0) & (total > 0)
        # Nothing follows an end.
        counts = total[own & (tags & 1 == 0)]
        power = np.frexp(counts)[1] - 1
        found[i, :BINS] = np.bincount(power, minlength=BINS)
        found[i, BINS:-1] = np.bincount(power, weights=counts, minlength=BINS)
        found[i, -1] = np.count_nonzero(total[own] == 1)
    return found


def estimated(seen: np.ndarray, documents: int) -> list[float]:
    """mu of each length from 2, from the sum of all `_seen`; a text's begin is a context too."""
    found = []
    for n in range(2, len(seen) + 1):
        contexts, sums = seen[n - 2, :BINS].copy(), seen[n - 2, BINS:-1].copy()
        if n == 2 and documents:
            contexts[documents.bit_length() - 1] += 1
            sums[documents.bit_length() - 1] += documents
        new = seen[n - 1, -1] - contexts[0]
        often = np.flatnonzero(contexts[1:]) + 1
        sums = sums[often]
        rest = sums / contexts[often] - 1
        low, high = math.log(LEAST_MU), math.log(MOST_MU)
        for _ in range(60):
            mu = math.exp((low + high) / 2)
            if (sums * mu / (rest + mu)).sum() < new:
                low = math.log(mu)
            else:
                high = math.log(mu)
        found.append(math.exp((low + high) / 2))
    return found


class _Automaton(NamedTuple):
    """States and arcs that the texts of a slice can reach; state 0 is the root."""

    begin: int
    #: Of each token, the number of its word among the slice's.
    word: np.ndarray
    n_words: int
    #: Arcs by state and word, sorted.
    arcs: np.ndarray
    weight: np.ndarray
    to: np.ndarray
    #: Failure arcs by state.
    fail_weight: np.ndarray
    fail_to: np.ndarray


def _automaton(
    own: _Slice,
    counts: list[np.ndarray],
    mus: list[float],
    root_chance: Callable[[np.ndarray], np.ndarray],
    documents: int,
) -> _Automaton:
    """From the distinct n-grams of a slice and the counts of each."""
    order = len(own.keys)
    begins = np.zeros(len(own.tokens), bool)
    begins[own.starts[:-1]] = True
    begin = 1 if documents and order > 1 else 0
    states = 1 + begin
    fail_weight, fail_to = [np.zeros(states)], [np.zeros(states, np.int64)]
    seen_as_state = np.zeros(states)
    if begin:
        seen_as_state[1] = documents
        fail_weight[0][1] = math.log10(mus[0] / (documents + mus[0]))
    arcs, weights, targets = [], [], []
    shorter_state = shorter_chance = word = None
    n_words = 0
    for n in range(1, order + 1):
        first, at, count = own.first[n - 1], own.at[n - 1], counts[n - 1]
        ended = own.tokens[first] == END
        contexts = np.flatnonzero((count > 0) & ~ended)
        state = np.zeros(len(first), np.int64)
        if n < order:
            state[contexts] = states + np.arange(len(contexts))
        if n == 1:
            word, n_words = at, len(first)
            chance = root_chance(count)
            made = np.arange(len(first))
            source = np.zeros(len(first), np.int64)
            down = np.zeros(len(contexts), np.int64)
        else:
            # An n-gram's context ends a token earlier; that of a text's first one is its begin.
            made = np.flatnonzero(count > 0)
            token = first[made]
            source = np.where(begins[token], begin, shorter_state[token - 1])
            lower = shorter_chance[token]
            chance = np.zeros(len(first))
            chance[made] = (count[made] + mus[n - 2] * lower) / (seen_as_state[source] + mus[n - 2])
            down = shorter_state[first[contexts]]
        arcs.append(source * n_words + word[first[made]])
        weights.append(np.log10(chance[made]))
        reached = state[made] if n < order else (shorter_state[first[made]] if n > 1 else 0 * made)
        targets.append(np.where(ended[made], 0, reached))
        if n < order:
            fail_to.append(down)
            fail_weight.append(np.log10(mus[n - 1] / (count[contexts] + mus[n - 1])))
            seen_as_state = np.append(seen_as_state, count[contexts])
            states += len(contexts)
        shorter_state, shorter_chance = state[at], chance[at]
    arcs_by = np.concatenate(arcs)
    order_by = np.argsort(arcs_by)
    return _Automaton(
        begin,
        word,
        n_words,
        arcs_by[order_by],
        np.concatenate(weights)[order_by],
        np.concatenate(targets)[order_by],
        np.concatenate(fail_weight),
        np.concatenate(fail_to),
    )


def _walk(auto: _Automaton, starts: np.ndarray, order: int) -> np.ndarray:
    """The weights on the way of each text, all of them side by side, a token at a time."""
    sizes = np.diff(starts)
    lanes = -(-sizes // LANE)
    text = np.repeat(np.arange(len(sizes)), lanes)
    part = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    at = starts[:-1][text] + part * LANE
    length = np.minimum(starts[1:][text] - at, LANE)
    longest_first = np.argsort(-length, kind="stable")
    text, part, at, length = (x[longest_first] for x in (text, part, at, length))
    state = np.where(part == 0, auto.begin, 0)
    total = np.zeros(len(at))
    # Inside a text, the words before a lane lead to its first state.
    inner = np.flatnonzero(part > 0)
    for back in range(order - 1, 0, -1):
        state[inner], _ = _step(auto, state[inner], auto.word[at[inner] - back])
    for k in range(length[0] if len(length) else 0):
        n = np.searchsorted(-length, -k, side="left")
        state[:n], weight = _step(auto, state[:n], auto.word[at[:n] + k])
        total[:n] += weight
    return np.bincount(text, weights=total, minlength=len(sizes))


def _step(auto: _Automaton, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The state after a word from each state, and the weight of its arcs."""
    weight = np.zeros(len(state))
    state = state.copy()
    found = np.zeros(len(state), np.int64)
    todo = np.arange(len(state))
    while len(todo):
        key = state[todo] * auto.n_words + word[todo]
        # The root has an arc for every word.
        at = np.minimum(np.searchsorted(auto.arcs, key), len(auto.arcs) - 1)
        hit = auto.arcs[at] == key
        found[todo[hit]] = at[hit]
        todo = todo[~hit]
        weight[todo] += auto.fail_weight[state[todo]]
        state[todo] = auto.fail_to[state[todo]]
    return auto.to[found], weight + auto.weight[found]


def _reading(
    shards: int, order: int, bits: int, mu: float | None
) -> Callable:
    def read(table: pa.Table, answers: pa.Table) -> pa.Table:
        # A small block's slices are made once, those of a large one again.
        slices: Iterable[_Slice] = list(_sliced(table, order, bits)) if table.nbytes < KEPT_BYTES else ()
        keys = _distinct([k for x in slices or _sliced(table, order, bits) for k in x.keys])
        told = dict(zip(answers["shard"].to_pylist(), answers["counts"].to_pylist(), strict=True))
        known = np.zeros(len(keys))
        for shard, part in _by_shard(keys, shards):
            known[part] = _numbers(told[shard])
        known[keys == 0] = 0
        seen = sum(_numbers(x).astype(float) for x in answers["seen"].to_pylist()).reshape(order + 1, -1)
        vocabulary, tokens_seen, documents = (int(x) for x in seen[order, :3])
        mus = estimated(seen[:order], documents) if mu is None else [mu] * (order - 1)

        def root_chance(counts: np.ndarray) -> np.ndarray:
            return (counts + ADDED) / (tokens_seen + ADDED * (vocabulary + 1))

        parts = []
        for x in slices or _sliced(table, order, bits):
            counts = [known[np.searchsorted(keys, own)] for own in x.keys]
            auto = _automaton(x, counts, mus, root_chance, documents)
            seen_words = counts[0][x.at[0]]
            taught = x.rows["training"].to_numpy(zero_copy_only=False)
            parts.append(
                pa.table(
                    {
                        "doc_id": x.rows["doc_id"].cast(pa.int64()),
                        "held_out": np.logical_not(taught),
                        "n_tokens": np.diff(x.starts),
                        "n_known": np.add.reduceat((seen_words > 0).astype(np.int64), x.starts[:-1]),
                        "train_tokens": np.full(len(taught), tokens_seen),
                        "base_score": np.add.reduceat(
                            np.log10(root_chance(counts[0]))[x.at[0]], x.starts[:-1]
                        ),
                        "score": _walk(auto, x.starts, order),
                        "weight": x.rows["weight"],
                    }
                )
            )
        return pa.concat_tables(parts)

    return read
