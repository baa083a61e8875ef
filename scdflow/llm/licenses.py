r"""License scan: an exact set-similarity join of windows of words with license templates.

A template is found in a window if this has at least `threshold` of the template's distinct words
(A-Z lower-cased, words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`), all words of its `must`, and its
`name` as it is. A template of n words reaches over r, the next power of two from n / threshold
(8 at least). Windows are 2r words long and begin every r words, whatever lines they stand in, so a
place of a template of up to r words lies whole in one. In a window a template whose shared words
are among those of another is taken for part of that: a window of the Affero license has all
words of the General one's name.

Words of templates are put in one order for all texts, the rarest in the documents first. If a
window and a template of |T| words share o words, one of the template's first |T| - o + 1 (its
prefix) is among the window's first |B| - o + 1. So a text without any word of a prefix is left
after one look at its words; of the others, windows that have such a word meet the prefixes in an
equi-join by word, and pairs go on if the window has o words (length filter) and enough words
follow the first shared one on both sides (positional filter). Those left are compared as a whole.

The templates are a parameter of the program, broadcast as they are: their number times their
length is the bound. All is done by DataFrame functions.

A null or empty text has no words, no labels and score 0. Rows of the same doc_id and text get
the same result, each of them. A text's words are an array in one row of a task, a long text's
too; windows are rows of their own. Ties: of equal sets of shared words both templates stay.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scdflow.sources.shared import staged

from .license_texts import TEMPLATES, Template
from .urls import ascii_lower

THRESHOLD = 0.8
#: Words that a template reaches over, at least.
LEAST_REACH = 8
#: All that is not in a word, before A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Phrases that name a license.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}


def words(text: Column) -> Column:
    """The text's words, case kept, each between spaces: ` a b c ` (a space if there are none)."""
    kept = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), BETWEEN, " "), F.lit(" "))
    return F.when(kept == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), kept, F.lit(" ")))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def phrases(docs: DataFrame, labels: Mapping[str, str] = PHRASES) -> DataFrame:
    """`docs` with `n_words`, `n_base`, `first_word`, `last_word`, `base_labels` (an array).

    Places where the words of a phrase stand together: how many, the first's and last's word.
    """
    either = "|".join(labels)
    # A place is the space before it, so places may overlap. (?i) knows ASCII only.
    place = f"(?i) (?=(?:{either}) )"
    spaced = F.col("words_")
    has = F.col("n_base") > 0
    first = F.substring_index(F.regexp_replace(spaced, f"(?s){place}.*", "\n"), "\n", 1)
    last = F.regexp_extract(spaced, f"(?s)^(.*){place}", 1)
    found = [
        F.when(F.regexp_like(spaced, F.lit(f"(?i) {phrase} ")), F.lit(label))
        for phrase, label in labels.items()
    ]
    return (
        docs.withColumn("words_", words(F.col("text")))
        .withColumn("n_words", _spaces(spaced) - 1)
        .withColumn("n_base", F.regexp_count(spaced, F.lit(place)).cast("long"))
        .withColumn("first_word", F.when(has, _spaces(first)))
        .withColumn("last_word", F.when(has, _spaces(last)))
        .withColumn("base_labels", F.when(has, F.array_distinct(F.array_compact(F.array(*found)))))
        .drop("words_")
    )


class Sought(NamedTuple):
    """A template as sets of words."""

    template: int
    label: str
    reach: int
    #: Shared words that are enough.
    o: int
    t: list[str]
    must: list[str]
    name: list[str]


def _split(text: str) -> list[str]:
    return re.sub(BETWEEN, " ", text).lower().split()


def sought(templates: Iterable[Template] = TEMPLATES, threshold: float = THRESHOLD) -> list[Sought]:
    found = []
    for i, (label, text, name, must) in enumerate(templates):
        own = _split(text)
        distinct = list(dict.fromkeys(own))
        reach = max(LEAST_REACH, 1 << (math.ceil(round(len(own) / threshold, 9)) - 1).bit_length())
        o = math.ceil(round(len(distinct) * threshold, 9))
        found.append(Sought(i, label, reach, o, distinct, _split(must), _split(name)))
    return found


def _array(texts: Column) -> Column:
    return F.split(F.btrim(ascii_lower(words(texts)), F.lit(" ")), " ")


def scan(
    docs: DataFrame, templates: Iterable[Template] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """A row per window and template found in it, for the distinct (doc_id, text) of `docs`.

    `doc_id`, `text_hash` (XXH64 of the text), `reach` and `window` (its first word is reach times
    window), `template` (its number), `label`, `score` (share of the template's words).
    """
    spark = docs.sparkSession
    listed = sought(templates, threshold)
    vocabulary = sorted({w for s in listed for w in (*s.t, *s.must, *s.name)})
    texts = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), _array(F.col("text")).alias("own")
    )
    known = F.broadcast(spark.createDataFrame([(w,) for w in vocabulary], "word string"))
    often = texts.select(F.explode("own").alias("word")).join(known, "word").groupBy("word").count()
    # One number a word of the templates, the rarest first; a word that no text has is rarest.
    counts = {r["word"]: r["count"] for r in often.collect()}
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    rows = []
    for s in listed:
        t = sorted(rank[w] for w in s.t)
        prefix = t[: len(t) - s.o + 1]
        rows.append((*s[:4], t, [rank[w] for w in s.must], [rank[w] for w in s.name], prefix))
    schema = (
        "template int, label string, reach int, o int, t array<int>, must array<int>, "
        "name array<int>, prefix array<int>"
    )
    index = spark.createDataFrame(rows, schema)
    first_words = sorted({w for s, r in zip(listed, rows, strict=True) for w in s.t if rank[w] in r[-1]})
    # A text without a word of any prefix has no template.
    some = texts.filter(F.arrays_overlap("own", F.array(*(F.lit(w) for w in first_words))))
    numbers = F.broadcast(spark.createDataFrame(list(rank.items()), "word string, rank int"))
    held = some.select("doc_id", "text_hash", F.posexplode("own").alias("pos", "word")).join(
        numbers, "word"
    )
    uses = {
        (rank[w], s.reach, rank[w] in r[-1])
        for s, r in zip(listed, rows, strict=True)
        for w in (*s.t, *s.must, *s.name)
    }
    by_reach = {}
    for word, reach, is_first in uses:
        by_reach[word, reach] = by_reach.get((word, reach), False) or is_first
    of_reach = spark.createDataFrame(
        [(*k, v) for k, v in by_reach.items()], "rank int, reach int, is_first boolean"
    )
    placed = held.drop("word").join(F.broadcast(of_reach), "rank")
    last = F.floor(F.col("pos") / F.col("reach")).cast("int")
    placed = placed.withColumn("window", F.explode(F.sequence(F.greatest(last - 1, F.lit(0)), last)))
    windows = (
        placed.groupBy("doc_id", "text_hash", "reach", "window")
        .agg(
            F.max("is_first").alias("is_first"),
            F.array_sort(F.collect_set("rank")).alias("b"),
            F.collect_set(F.struct("pos", "rank")).alias("places"),
        )
        .filter("is_first")
        .drop("is_first")
    )
    windows = staged(windows, "windows")
    entries = index.select(
        "template", "label", "reach", "o", "t", "must", "name", F.posexplode("prefix").alias("i", "word")
    )
    firsts = windows.select("*", F.posexplode("b").alias("j", "word"))
    rest = F.least(F.size("t") - F.col("i"), F.size("b") - F.col("j"))
    pairs = firsts.join(F.broadcast(entries), ["reach", "word"]).filter(
        (F.size("b") >= F.col("o")) & (F.col("j") <= F.size("b") - F.col("o")) & (rest >= F.col("o"))
    )
    common = F.array_intersect("t", "b")
    # A pair may share more words of its prefixes; the first of them stands for it.
    found = pairs.filter((F.array_min(common) == F.col("word")) & (F.size(common) >= F.col("o")))
    found = found.filter((F.size(F.array_except("must", "b")) == 0) & _stands())
    return _largest(found.withColumn("common", common)).select(
        "doc_id",
        "text_hash",
        "reach",
        "window",
        "template",
        "label",
        (F.size("common") / F.size("t")).alias("score"),
    )


def _stands() -> Column:
    """The words of `name` follow each other somewhere in the window."""
    begins = F.filter("places", lambda x: x["rank"] == F.get("name", F.lit(0)))

    def whole(x: Column) -> Column:
        follow = F.transform(
            F.col("name"),
            lambda w, k: F.struct((x["pos"] + k).alias("pos"), w.alias("rank")),
        )
        return F.size(F.array_except(follow, F.col("places"))) == 0

    return (F.size("name") == 0) | F.exists(begins, whole)


def _largest(found: DataFrame) -> DataFrame:
    """Without templates that share less in a window than another one that has all these words."""
    others = F.collect_set("common").over(
        Window.partitionBy("doc_id", "text_hash", "reach", "window")
    )
    within = F.exists(
        "others",
        lambda x: (F.size(x) > F.size("common")) & (F.size(F.array_except("common", x)) == 0),
    )
    return found.withColumn("others", others).filter(~within)


def labelled(
    docs: DataFrame,
    labels: Mapping[str, str] = PHRASES,
    templates: Iterable[Template] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """`doc_id`, what `phrases` finds, all `labels` (an array) and `score`, the best window's."""
    texts = docs.select("doc_id", "text")
    found = (
        scan(texts, templates, threshold)
        .groupBy(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"))
        .agg(F.collect_set("label").alias("found"), F.max("score").alias("best"))
    )
    base = phrases(texts, labels).withColumn("text_hash", F.xxhash64("text")).drop("text")
    joined = base.join(
        found,
        F.col("text_hash").eqNullSafe(F.col("of_hash")) & F.col("doc_id").eqNullSafe(F.col("of_id")),
        "left",
    )
    none = F.array().cast("array<string>")
    own = F.coalesce("base_labels", none)
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_sort(own).alias("base_labels"),
        F.array_sort(F.array_union(own, F.coalesce("found", none))).alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"),
    )
