"""Language identification: multinomial naive Bayes over hashed character n-grams.

The model is a matrix of log probabilities, buckets x languages, learned from a bounded sample
of labelled texts (`PER_LANGUAGE` a language, whole texts) and broadcast. A task scores a batch
of texts at once: the buckets of all their 1-, 2- and 3-grams pick rows of the matrix, which are
added up by text, a bounded number of rows at a time. Every text is scored, as a whole; a long
one is read in pieces. The matrix has a fixed size at most: with very many languages (labels of
any kind are languages) it has fewer buckets, `FEWEST` at least.

A null text and one without a letter get `und` and score 0; so does every text if nothing was
learned. Ties go to the language that sorts first. Rows without text or label teach nothing.
Repeated rows are judged alike, each by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words

UNKNOWN = "und"
#: Characters of the longest n-gram.
N_GRAM = 3
BUCKETS = 1 << 16
#: Labelled texts of each language that teach the model, about.
PER_LANGUAGE = 3000
#: Added to each count.
SMOOTHING = 0.1
#: Bytes of the matrix, which is broadcast, and buckets of a language at least.
MODEL_BYTES, FEWEST = 256_000_000, 64
#: Numbers of the matrix that a task picks at once, and characters of a text that it reads at once.
PICKED, PIECE = 4_000_000, 500_000
#: Posterior probability below which the filter rejects a document.
LEAST_SCORE = 0.5

_LETTER = regex.compile(r"\p{L}")


class Model(NamedTuple):
    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray
    n: int


def train(
    docs: DataFrame,
    n: int = N_GRAM,
    buckets: int = BUCKETS,
    per_language: int = PER_LANGUAGE,
) -> Model:
    """A model from `text` and `lang` of labelled documents."""
    labelled = docs.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    rows = labelled.groupBy("lang").count().collect()
    counts = {r["lang"]: r["count"] for r in sorted(rows, key=lambda r: r["lang"])}
    languages = list(counts)
    buckets = min(buckets, max(FEWEST, MODEL_BYTES // (4 * max(1, len(languages)))))
    grams = np.zeros((buckets, len(languages)), np.float32)
    number = {x: i for i, x in enumerate(languages)}
    if languages:
        sampled = labelled.join(F.broadcast(_shares(docs, counts, per_language)), "lang").filter(
            F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
        )
        # No more rows than the matrix has numbers.
        for row in _counted(sampled.select("text", "lang"), n, buckets).toLocalIterator():
            grams[row["bucket"], number[row["lang"]]] = row["n"]
    total = grams.sum(axis=0, dtype=np.float64) + SMOOTHING * buckets
    grams += np.float32(SMOOTHING)
    weights = np.log(grams, out=grams)
    weights -= np.log(total).astype(np.float32)
    every = sum(counts.values())
    prior = np.log(np.array([counts[x] / every for x in languages]))
    return Model(languages, prior, weights, n)


def _shares(docs: DataFrame, counts: dict[str, int], per_language: int) -> DataFrame:
    """A row a language, of which the model has a bounded number."""
    rows = [(x, min(1.0, per_language / c)) for x, c in counts.items()]
    return docs.sparkSession.createDataFrame(rows, "lang string, share double")


def _counted(labelled: DataFrame, n: int, buckets: int) -> DataFrame:
    """How often each bucket comes up, by language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.sliced(batches):
            sums: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
                for piece in _pieces(text, n):
                    for found in _buckets_of(piece, n, buckets):
                        sums.setdefault(lang, []).append(found.astype(np.int32))
            for lang, parts in sums.items():
                some, total = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(some), pa.string()),
                        pa.array(some.astype(np.int64)),
                        pa.array(total),
                    ],
                    ["lang", "bucket", "n"],
                )

    made = labelled.mapInArrow(count, "lang string, bucket long, n long")
    return made.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def _pieces(text: str, n: int) -> Iterator[np.ndarray]:
    """The code points in which a piece's n-grams begin, and the n - 1 behind them.

    n - 1 zeros stand before and behind each text, so no n-gram has parts of two.
    """
    last = len(text) + n - 1
    for low in range(0, last, PIECE):
        high = min(low + PIECE, last) + n - 1
        inside = text[max(0, low - (n - 1)) : max(0, high - (n - 1))]
        before, behind = max(0, n - 1 - low), max(0, high - (n - 1) - len(text))
        yield words.code_points("\0" * before + inside + "\0" * behind).astype(np.uint64)


def _buckets_of(points: np.ndarray, n: int, buckets: int) -> Iterator[np.ndarray]:
    """The buckets of the 1-, 2-, ... n-grams that begin at all code points but the last n - 1."""
    size = len(points) - (n - 1)
    seed = np.uint64(0x9E3779B97F4A7C15)
    gram = np.zeros(size, np.uint64)
    for k in range(n):
        gram = (gram ^ points[k : size + k]) * seed
        gram ^= gram >> np.uint64(29)
        spread = gram * np.uint64(0xBF58476D1CE4E5B9)
        yield ((spread >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _scores(model: Model, texts: list[str]) -> np.ndarray:
    """Log of prior times likelihood, texts x languages."""
    total = np.tile(model.prior, (len(texts), 1))
    most = max(1, PICKED // max(1, len(model.languages)))
    held: list[np.ndarray] = []
    of: list[int] = []

    def add() -> None:
        """The pieces held, side by side: the zeros between them are behind each one's n-grams."""
        begins = [np.arange(len(p) - (model.n - 1)) for p in held]
        shift = np.cumsum([0, *(len(p) for p in held[:-1])])
        at = np.concatenate([b + s for b, s in zip(begins, shift, strict=True)])
        own = np.repeat(of, [len(b) for b in begins])
        for found in _buckets_of(np.concatenate(held), model.n, len(model.weights)):
            found = found[at]
            for low in range(0, len(found), most):
                part, text = found[low : low + most], own[low : low + most]
                first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
                picked = model.weights.take(part, axis=0)
                total[text[first]] += np.add.reduceat(picked, first, axis=0, dtype=np.float64)

    size = 0
    for i, text in enumerate(texts):
        for piece in _pieces(text, model.n):
            held.append(piece)
            of.append(i)
            size += len(piece)
            if size >= PIECE:
                add()
                held.clear()
                of.clear()
                size = 0
    if held:
        add()
    return total


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score`, the posterior; columns of these names are replaced."""
    rest = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    names = [f.name for f in rest]
    schema = T.StructType(
        [*rest, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.sliced(batches, text, words.SLICE_BYTES // 4):
            langs, scores = _judged(shared.value, batch[text].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), pa.array(langs, pa.string()), pa.array(scores)],
                [*names, "lang_pred", "score"],
            )

    return docs.select(names).mapInArrow(add, schema)


def _judged(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
    if known and model.languages:
        total = _scores(model, [texts[i] for i in known])
        best = total.argmax(axis=1)
        for i, b in zip(known, best, strict=True):
            langs[i] = model.languages[b]
        odds = np.exp(total - total.max(axis=1, keepdims=True))
        scores[known] = 1 / odds.sum(axis=1)
    return langs, scores


def known_language(docs: DataFrame, model: Model, least: float = LEAST_SCORE) -> DataFrame:
    """The documents with a language that is likely enough, all columns kept."""
    names = docs.columns
    numbered = docs.toDF(*(f"c{i}" for i in range(len(names))))
    judged = predict(numbered, model, f"c{names.index('text')}")
    kept = judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return kept.drop("lang_pred", "score").toDF(*names)


def remainder(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo; a null doc_id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(modulus))
