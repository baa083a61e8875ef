"""Small tables and slow, plain versions of the operators."""

import os
import re
import string

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def documents(spark, texts, first=0):
    """A row a text; a tuple gives (doc_id, text, lang, source)."""
    rows = []
    for i, text in enumerate(texts, first):
        row = text if isinstance(text, tuple) else (i, text, "en", "a")
        rows.append((*row, len(row[1] or "")))
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def write_tables(folder, **frames):
    for name, frame in frames.items():
        frame.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
