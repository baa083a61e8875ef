import hashlib
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from scdflow.llm import fingerprint as fp
from scdflow.llm import words as w

from .helpers import documents, table

MASK = (1 << 64) - 1


def mix(h):
    h ^= h >> 33
    h = h * 0xFF51AFD7ED558CCD & MASK
    h ^= h >> 33
    h = h * 0xC4CEB9FE1A85EC53 & MASK
    return h ^ (h >> 33)


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def brute(text, k=fp.K):
    """Every element by itself, every selection by sorting."""
    text = text or ""
    n = max(1, len(text) - k + 1)
    seen, elements = {}, []
    for i in range(n):
        gram = min(len(text), k)
        for c in text[i : i + k]:
            gram = ((gram ^ ord(c)) * 0x9E3779B97F4A7C15) & MASK
            gram ^= gram >> 29
        occurrence = seen[text[i : i + k]] = seen.get(text[i : i + k], -1) + 1
        elements.append(mix((gram + occurrence * 0xD6E8FEB86659FD93) & MASK))
    many, out = min(fp.TUPLE, n), []
    for s in range(fp.SKETCHES):
        xor, times = int(fp._XOR[s, 0]), int(fp._TIMES[s, 0])
        value = [signed((e ^ xor) * times & MASK) for e in elements]
        chosen = sorted(sorted(range(n), key=lambda i: (value[i], i))[:many])
        made = s + many
        for i in chosen:
            made = mix((made * 0x9E3779B97F4A7C15 + elements[i]) & MASK)
        out.append(made >> 32)
    return out


def test_against_plain_selection(monkeypatch):
    rng = random.Random(6)
    texts = ["", "a", "abcdefg", "abcdefgh", "abcdefghi", "ab" * 300, "a" * 500, "é\U0001f600" * 40]
    texts += ["".join(rng.choices("abc ", k=rng.randrange(900))) for _ in range(30)]
    for piece in (8192, 100):
        monkeypatch.setattr(fp, "PIECE", piece)
        for text in texts:
            assert fp.fingerprint(text).tolist() == brute(text)


def test_likeness_falls_with_edits_and_moves():
    rng = random.Random(9)
    text = "".join(rng.choices("abcdefghij ", k=4000))
    own = fp.fingerprint(text)
    near = []
    for share in (0, 0.01, 0.05, 0.25, 1):
        cut = int(len(text) * (1 - share))
        near.append(fp.likeness(own, fp.fingerprint(text[:cut] + "".join(rng.choices("klmnop", k=len(text) - cut)))))
    assert near[0] == 1 and near[-1] == 0
    assert near == sorted(near, reverse=True)
    # Order counts: halves changed over have the same k-mers, but for a few.
    moved = fp.likeness(own, fp.fingerprint(text[2000:] + text[:2000]))
    assert moved < 0.85


def tie(text):
    """Spark's hash of a null is its seed."""
    return 42 if text is None else signed(xxhash.xxh64_intdigest(text.encode(), 42))


def neighbours(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1]), r[1] or ""))
    return [(a, order[(i + 1) % len(order)]) for i, a in enumerate(order)]


def check(rows, got):
    want = []
    for (doc_id, text), (_, following) in neighbours(rows):
        text, following = text or "", following or ""
        n = len(text)
        edited = text[: n - n // 4] + following[: n // 4]
        own, other, changed = (fp.fingerprint(t) for t in (text, following, edited))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        near = fp.likeness(own, changed), fp.likeness(own, other)
        want.append((doc_id, n, digest, fp.as_text(own), fp.as_text(changed), *near))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_documents(spark, monkeypatch):
    docs = table(spark, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for part in (10**9, 40_000):
        monkeypatch.setattr(fp, "PART_BYTES", part)
        got = fp.compared(docs.repartition(4, "source")).collect()
        check(rows, got)
    prints = {r["doc_id"]: r["fingerprint"] for r in fp.fingerprints(docs).collect()}
    assert prints == {r["doc_id"]: r["fingerprint"] for r in got}
    far = [r for r in got if r["n_chars"] > 200]
    assert np.mean([r["near_edited"] for r in far]) > 0.5
    assert np.mean([r["near_next"] for r in far]) < 0.1


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(fp, "PART_BYTES", 300_000)
    rows = [(7, None), (-3, ""), (None, "x"), (5, "same text here"), (5, "same text here"), (5, "another"), (9, "é" * 7)]
    rows += [(None, None), (12, "long " * 200_000), (2**63 - 1, "last of all"), (13, "long " * 200_000)]
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows]).withColumns(
        {"part": F.lit("p"), "after": F.lit(3), "key": F.lit("k"), "least": F.lit(0), "fingerprint": F.lit(1)}
    )
    check(rows, fp.compared(docs).collect())


def test_few_rows(spark):
    docs = documents(spark, ["one two three four"])
    check([(0, "one two three four")], fp.compared(docs).collect())
    assert fp.compared(docs.limit(0)).count() == 0
    assert w.text_bytes(docs.limit(0)) == 0


def test_a_hot_id_is_dealt_to_several_parts(spark, monkeypatch):
    """Two thirds of the rows without an id: no part has over twice the mean."""
    monkeypatch.setattr(fp, "PART_BYTES", 20_000)
    rng = random.Random(3)
    rows = [(None if i % 3 else i, "".join(rng.choices("abcdef ", k=rng.randrange(60, 140)))) for i in range(3000)]
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows])
    sizes = []

    def handle(pairs):
        import pyarrow as pa

        n = sum(1 for _ in pairs)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    sizes = [r["n"] for r in fp.with_next(docs, handle, "n long").collect()]
    assert sum(sizes) == len(rows) and len(sizes) >= 12
    assert max(sizes) <= 2 * len(rows) / len(sizes)
    check(rows, fp.compared(docs).collect())
