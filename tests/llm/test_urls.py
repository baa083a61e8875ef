import random
import re

import pytest
from pyspark.sql import functions as F

from scdflow.llm import urls
from scdflow.llm.queries import URL_RULES

from .helpers import LOWER

SCHEMA = "page_id long, url string"


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(LOWER)
    fits = []
    for r in rules:
        if r.listed:
            of_host, _, of_path = r.name.partition("/")
            inside = host == of_host or host.endswith("." + of_host)
            if inside and path.startswith("/" + of_path):
                fits.append((False, -len(r.name), r.name, r))
        elif re.match(urls.regex(r.pattern).replace("(?s)", "", 1).replace("\\z", "\\Z"), host + path, re.S):
            fits.append((True, -len(r.pattern.strip("|*")), r.name, r))
    best = min(fits, key=lambda f: f[:3])[3] if fits else None
    rule = best.name if best and best.listed else None
    return host, path, rule, best.action if best else "allow"


ODD = [
    None, "", "no scheme", "://", "http://", "a://b://c/de/", "HTTPS://WWW.Example.NET/en/", "http://net",
    "http://net/", "http://xnet/", "http://a.net/x", "http://example.net", "http://example.net/EN/",
    "http://example.net/en/?q=/fr/", "http://example.com/de/a#b", "http://myexample.com/de/", "http://org/fr/",
    "http://example.org/fr/\n", "http://example.com?x=/de/", "http://example.com:80/de/", "http://é.net/ü",
    "http://SPAM-farm.example.net/en/1", "http://spam-farm.a/b", "http://xspam-farm.a/b",
    "http://a.free-bets.org/fr/", "http://a.b/path/track.gif", "http://K.ads.x/", "http://x/Ken/ads/1",
    "http://h/ads", "http://h/ads/", "http://h/zzz/banner_1.png",
]
MORE = (
    urls.Rule("block", "*/ads/*", "ads", False),
    urls.Rule("block", "*/ads^", "ads end", False),
    urls.Rule("block", "*banner*", "banner", False),
    urls.Rule("block", "*.gif", "gif", False),
    urls.Rule("allow", "||h/zzz/banner_*", "h banner", False),
)


@pytest.mark.parametrize("rules", [URL_RULES, URL_RULES + MORE])
def test_against_all_rules(spark, rules):
    rng = random.Random(8)
    parts = ["a", "net", "example", "com", "org", "de", "en", "fr", "spam-farm", "free-bets", "ads", "banner1"]
    made = [
        "http://" + ".".join(rng.choices(parts, k=rng.randrange(1, 4))) + rng.choice(["", "/", "/"])
        + "/".join(rng.choices(parts, k=rng.randrange(4))) + rng.choice(["", "/", "?x", "#y", ".gif"])
        for _ in range(400)
    ]
    rows = list(enumerate(ODD + made + ODD)) + [(None, "http://a.net/"), (3, "http://a.net/")]
    pages = spark.createDataFrame(rows, SCHEMA).withColumns({"token": F.lit(1), "host": F.lit("x"), "best": F.lit(0)})
    judged = urls.judged(pages, rules)
    assert judged.columns == ["page_id", "url", "token", "best", "host", "path", "rule", "verdict"]
    got = sorted((str(tuple(r)) for r in judged.select("page_id", "url", "host", "path", "rule", "verdict").collect()))
    assert got == sorted(str((i, u, *brute(u, rules))) for i, u in rows)


def test_tokens():
    assert urls.tokens("||example.net/en/*") == ["en", "example", "net"]
    assert urls.tokens("*/ads/ban*") == ["ads"]
    assert urls.tokens("*x*") == []
    with pytest.raises(ValueError, match="wild"):
        urls.listed("block", "a*", "/")


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert urls.judged(none, URL_RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a/b")], SCHEMA)
    assert [r["verdict"] for r in urls.judged(one, ()).collect()] == ["allow"]
