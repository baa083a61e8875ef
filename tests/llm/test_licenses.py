import random
import re
import textwrap

import pytest
from pyspark.sql import functions as F

from scdflow.llm import license_texts, licenses
from scdflow.llm.queries import ORACLE_SQL, op7_license_scans

from .helpers import LOWER, documents, table, write_tables


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def templates_of(listed=license_texts.TEMPLATES, threshold=0.8):
    for label, text, name, must in listed:
        own = words(text)
        reach = 8
        while reach < round(len(own) / threshold, 9):
            reach *= 2
        yield label, set(own), words(name), set(words(must)), reach, threshold


def brute(text, phrases=licenses.PHRASES, templates=tuple(templates_of())):
    own = words(text)
    places, base = [], set()
    for i in range(len(own)):
        for phrase, label in phrases.items():
            p = phrase.split()
            if own[i : i + len(p)] == p:
                places.append(i)
                base.add(label)
    found, best = set(), 0.0
    for reach in {t[4] for t in templates}:
        for first in range(0, len(own), reach):
            window = own[first : first + 2 * reach]
            block, pairs = set(window), []
            for label, t, name, must, of, threshold in templates:
                common = t & block
                if of != reach or len(common) < round(threshold * len(t), 9) or not must <= block:
                    continue
                n = len(name)
                if n and not any(window[i : i + n] == name for i in range(len(window))):
                    continue
                pairs.append((label, common, len(common) / len(t)))
            for label, common, score in pairs:
                if not any(common < other for _, other, _ in pairs):
                    found.add(label)
                    best = max(best, score)
    first, last = (places[0], places[-1]) if places else (None, None)
    return len(own), len(places), first, last, sorted(base), sorted(base | found), best


def result(r):
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    return (*(r[n] for n in names), pytest.approx(r["score"]))


LINES = [
    "Released under the MIT License.", "released UNDER the mit-license", "under the MIT\nlicense",
    "MIT license under the", "Apache License, Version 2.0", "CC BY-NC cc by nc cc-by-nc", "cc by\tnc4", "K under the mit license",
    "licensed under cc by 4", "this work is licensed under the gnu lesser public license version 3 x y",
    "The library is licensed, GNU Lesser General Public License version 3", "under the under the mit license mit license",
    "éunder the mit license", "under the mit licensé", "Permission", "a\x00b\x7fc", "İ under the MIT License İ",
    "creative commons attribution 4 0 international license licensed", "__under__the__mit__license__",
]


def varied(n):
    """License texts with words put in, left out and moved, among words that many of them have."""
    rng = random.Random(n)
    common = "the of software license and 2 version to use public mit copy bsd in gnu 3".split()
    texts = []
    for _ in range(n):
        own = []
        for t in rng.sample(license_texts.TEMPLATES, 3):
            own += rng.choices(common, k=rng.randrange(20))
            notice = t.text.split()
            for _ in range(rng.randrange(1 + len(notice) // 6)):
                at = rng.randrange(len(notice))
                change = rng.randrange(3)
                word = notice.pop(at) if change and len(notice) > 1 else "inserted"
                if change != 1:
                    notice.insert(rng.randrange(len(notice) + 1), word)
            own += notice
        texts.append(rng.choice([" ", "\n * "]).join(own))
    return texts


def test_against_all_windows(spark):
    texts = [None, "", "\n", *LINES, "\n".join(LINES), " ".join(LINES), "x " * 200_000 + LINES[0]]
    texts += [f"{a}\r\nwords {b}\n\n{a}" for a in LINES for b in LINES[::3]]
    texts += varied(60)
    docs = documents(spark, texts).withColumns(
        {"words_": F.lit(1), "own": F.lit("l"), "label": F.lit(2), "text_hash": F.lit(0), "rank": F.lit(5)}
    )
    got = {r["doc_id"]: r for r in licenses.labelled(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert brute(text) == result(got[i]), text[:80]


@pytest.mark.parametrize("threshold", [1.0, 0.5])
def test_thresholds(spark, threshold):
    texts = [*LINES, *varied(20)]
    rows = licenses.scan(documents(spark, texts), threshold=threshold).collect()
    templates = tuple(templates_of(threshold=threshold))
    for i, text in enumerate(texts):
        want = set(brute(text, {}, templates)[5])
        assert {r["label"] for r in rows if r["doc_id"] == i} == want


def test_repeated_and_null_ids(spark):
    rows = [(None, LINES[0], "en", "a"), (None, "x", "en", "a"), (1, LINES[0], "en", None), (1, LINES[0], "en", None)]
    got = licenses.labelled(documents(spark, [*rows, (1, "y", "en", "a")])).collect()
    assert sorted(",".join(r["labels"]) for r in got) == ["", "", "mit", "mit", "mit"]
    assert licenses.labelled(documents(spark, [])).count() == 0


def test_no_python_on_executors(spark):
    plan = licenses.labelled(table(spark, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    assert "op7_license_scans" in ORACLE_SQL


NOTICES = {
    "Released under the MIT License": "mit",
    "Licensed under the Apache License, Version 2.0": "apache-2",
    "This work is licensed under the GNU General Public License, version 3": "gpl-3",
    "This work is licensed under the GNU General Public License, version 2": "gpl-2",
    "This library is licensed under the GNU Lesser General Public License, version 3": "lgpl-3",
    "Licensed under the GNU Affero General Public License, version 3": "agpl-3",
    "Licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
    "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa",
    "Licensed under CC BY-NC 4.0": "cc-by-nc",
    "Use of this source code is governed by a BSD-style license": "bsd",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0": "mpl-2",
    "The tool was licensed under the old license of 1990": "",
    "Creative Commons Attribution": "",
}


def test_each_notice_has_its_own_label(spark, tmp_path):
    texts = [f"First line\n{notice}.\nlast" for notice in NOTICES]
    folder = write_tables(tmp_path, documents=documents(spark, texts))
    got = {r["doc_id"]: r["labels"] for r in op7_license_scans(spark, folder).collect()}
    assert [got[i] for i in range(len(texts))] == list(NOTICES.values())


#: Bodies with a word changed or moved, and short forms.
SHORT = {
    license_texts.MIT_BODY.replace("free of charge", "without charge"): "mit",
    license_texts.MIT_BODY.replace("hereby granted", "granted hereby"): "mit",
    license_texts.BSD_BODY.replace("source and binary", "binary and source"): "bsd",
    "Licensed under the Apache License 2.0": "apache-2",
    "The MIT License (MIT)": "mit",
    "Apache License v2.0": "apache-2",
    "GNU General Public License v3.0": "gpl-3",
    "GPLv3": "gpl-3",
    "LGPL-3.0": "lgpl-3",
    "SPDX-License-Identifier: MIT": "mit",
    "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2",
    "SPDX-License-Identifier: Apache-2.0": "apache-2",
    "mit Lizenz, licensed under the Apache License, Version 2.0": "apache-2",
    "CC BY-SA 4.0": "cc-by-sa",
    "Creative Commons Attribution-NonCommercial 4.0 International": "cc-by-nc",
    license_texts.GNU_HEADER.format("Affero General", 3): "agpl-3",
    license_texts.GNU_HEADER.format("General", 2): "gpl-2",
    license_texts.ISC_BODY: "isc",
    license_texts.ZLIB_BODY: "zlib",
    license_texts.UNLICENSE_BODY: "unlicense",
    license_texts.MPL_HEADER: "mpl-2",
    license_texts.APACHE_HEADER: "apache-2",
}


def test_bodies_and_short_forms(spark):
    got = {r["doc_id"]: r["labels"] for r in licenses.labelled(documents(spark, list(SHORT))).collect()}
    assert [",".join(got[i]) for i in range(len(SHORT))] == list(SHORT.values())


#: As in files of source code and in license files.
WRAPPED = {
    "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If": "mpl-2",
    "under the terms of the GNU\n# Lesser General Public License as published by the Free Software Foundation; either\n"
    "# version 3 of the License, or (at your option) any later version.": "lgpl-3",
    "Creative Commons\nAttribution-\nShareAlike 4.0 International License": "cc-by-sa",
    "                    GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007": "agpl-3",
    "Apache License\n   Version 2.0, January 2004": "apache-2",
    textwrap.fill(license_texts.MIT_BODY, 40): "mit",
    textwrap.fill(license_texts.BSD_BODY, 40): "bsd",
    "permission is hereby granted, free of charge, to sit here": "",
}


@pytest.mark.parametrize("before", [0, 1, 13, 15, 31, 500])
def test_notices_over_several_lines(spark, tmp_path, before):
    texts = ["word " * before + text + " word" * before for text in WRAPPED]
    folder = write_tables(tmp_path, documents=documents(spark, texts))
    got = {r["doc_id"]: r["labels"] for r in op7_license_scans(spark, folder).collect()}
    assert [got[i] for i in range(len(texts))] == list(WRAPPED.values())
