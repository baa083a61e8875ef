"""From raw documents to token ids: language, copies, benchmark leaks, mixture, files.

Each stage takes `(spark, docs, sf_dir)` and works on all that the one before it kept. All but
the last return the columns of `documents`; the last returns a row for each document in its
files, copies of the mixture included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scdflow.llm import decontaminate, language, mixture, simhash, tokens
from scdflow.llm.queries import END_ID, LOWER, TOKENIZER
from scdflow.sources.shared import new_folder, staged


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out texts without a letter and those whose language is not likely enough."""
    model = language.train(docs.filter(language.remainder(4) != 2))
    return language.known_language(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of SimHash fingerprints."""
    return simhash.representatives(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents into which an item of `benchmark` leaks."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as its source's target weight wants it."""
    return mixture.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token ids and returns what the files hold of each document."""
    folder = new_folder(spark, "tokens")
    tokens.write(docs, TOKENIZER, END_ID, folder, LOWER)
    return tokens.digests(spark, folder)


STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing sources to target weights", source_mixture),
    ("token-ID / binary output", token_files),
]

#: No SQL has the hashes, models and tokenizer of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage")
    return docs
