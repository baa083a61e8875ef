import numpy as np
from pyspark.sql import functions as F

from scdflow.llm import language

from .helpers import documents


def brute(model, text):
    """Log scores by single n-grams."""
    gap, total = "\0" * (model.n - 1), np.array(model.prior)
    padded, mask = gap + text + gap, (1 << 64) - 1
    for start in range(len(text) + model.n - 1):
        gram = 0
        for k in range(model.n):
            gram = ((gram ^ ord(padded[start + k])) * 0x9E3779B97F4A7C15) & mask
            gram ^= gram >> 29
            spread = (gram * 0xBF58476D1CE4E5B9) & mask
            total += model.weights[(spread >> 40) % len(model.weights)]
    return total


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = language.remainder(4) == 2
    model = language.train(docs.filter(~held_out))
    assert model.languages == ["de", "en", "es", "fr"]
    judged = language.predict(docs, model).filter(held_out)
    right = judged.filter("lang = lang_pred").count()
    assert right >= 0.97 * judged.count()
    small = language.train(docs.filter(~held_out), per_language=20)
    judged = language.predict(docs, small).filter(held_out)
    assert judged.filter("lang = lang_pred").count() >= 0.9 * judged.count()


def test_scores_are_those_of_single_grams(spark):
    docs = documents(spark, [(i, t, lang, "a") for i, (t, lang) in enumerate([("abc abd", "x"), ("zyx éz", "y")])])
    model = language.train(docs)
    texts = ["a", "", "ab", "\0é", "zy abcé \U0001f600x", "abc abd", "b" * 50]
    got = language._scores(model, texts)
    assert np.allclose(got, [brute(model, t) for t in texts])
    # A text's scores do not depend on its neighbours.
    assert np.allclose(got, [language._scores(model, [t])[0] for t in texts])


def test_odd_rows(spark):
    rows = [(1, "hallo welt", "de", "a"), (2, "hello world", "en", "a"), (None, None, "de", "a"), (3, "x", None, None)]
    docs = documents(spark, [*rows, (4, "123 !?²", "en", "a"), (5, "", "en", "a"), (6, "é" * 3_000_000, None, "a")])
    docs = docs.withColumns({"lang_pred": F.lit(1), "share": F.lit(2), "bucket": F.lit(3), "c0": F.lit(4)})
    model = language.train(docs)
    assert model.languages == ["de", "en"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()}
    assert got[1][0] == "de" and got[2][0] == "en" and got[6][0] != "und"
    assert got[None] == got[4] == got[5] == ("und", 0.0)
    assert all(0 <= s <= 1 for _, s in got.values())
    kept = language.known_language(docs, model)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 6]


def test_nothing_learned(spark):
    docs = documents(spark, [(1, "hallo", None, "a")])
    model = language.train(docs)
    assert [r["lang_pred"] for r in language.predict(docs, model).collect()] == ["und"]
    assert language.predict(docs.limit(0), model).count() == 0
    assert language.train(docs.limit(0)).languages == []


def test_pieces_of_a_long_text_score_as_the_whole(monkeypatch):
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(64, 3)).astype(np.float32)
    model = language.Model(["a", "b", "c"], np.log([0.5, 0.3, 0.2]), weights, 3)
    texts = ["".join(chr(97 + x) for x in rng.integers(0, 26, n)) for n in (0, 1, 2, 9, 10, 11, 57)]
    want = [brute(model, t) for t in texts]
    for piece in (1, 2, 3, 10, 1000):
        for picked in (1, 7, 10**6):
            monkeypatch.setattr(language, "PIECE", piece)
            monkeypatch.setattr(language, "PICKED", picked)
            assert np.allclose(language._scores(model, texts), want, atol=1e-4)


def test_any_number_of_labels(spark):
    """More labels than a matrix of all buckets has room for."""
    many = 5000
    rows = [(i, f"{'xyz'[i % 3]}{i} text of its own {i}", f"l{i}", "a") for i in range(many)]
    rows += [(many + i, t, lang, "a") for i in range(300) for t, lang in (("hallo schöne welt", "de"), ("hello nice world", "en"))]
    docs = documents(spark, rows)
    model = language.train(docs)
    assert len(model.languages) == many + 2 and model.weights.nbytes <= language.MODEL_BYTES
    asked = documents(spark, ["hallo welt", "hello world", "hello nice world " * 60_000])
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(asked, model).collect()}
    assert got == {0: "de", 1: "en", 2: "en"}
