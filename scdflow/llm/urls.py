r"""URL filters: rules found by their rarest literal token, regular expressions run on those only.

A rule has a pattern for the host and path of a URL: `||` at its begin stands for the begin of
the host or one of its labels, `*` for anything, `^` for a character that is no letter, digit,
`_`, `-`, `.` or `%`, or the end; all else stands for itself. The longest rule that fits decides,
of the longest the first in code points; without one the verdict is `allow`.

A token is a run of ASCII letters and digits. A rule's tokens are the runs that its pattern
bounds on both sides, so every URL it fits holds them as whole tokens. Each rule is filed under
the one of them that the fewest URLs hold; one without tokens is filed under the empty token,
which every URL holds. Rules meet distinct URLs by that token, in a join that Spark broadcasts if
the rules are small and splits if a token is hot.

A null URL and one without `://` have an empty host and path. Pages of the same URL are judged
once and all get the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdflow.sources.shared import staged


ALLOW, BLOCK = "allow", "block"
TOKEN = "[0-9A-Za-z]+"


class Rule(NamedTuple):
    """`name` is what a result shows; `listed` says that it shows it as the deciding rule."""

    action: str
    pattern: str
    name: str
    listed: bool


def listed(action: str, host: str, path: str) -> Rule:
    """A rule for a host, its subdomains and paths that begin so."""
    if re.search(r"[*^|]", host + path):
        raise ValueError("a listed rule has no wild cards")
    return Rule(action, f"||{host}{path}*", f"{host}{path}", True)


def regex(pattern: str) -> str:
    """Regular expression of a pattern, for the host and path of a URL."""
    begin = "(?s)^"
    if pattern.startswith("||"):
        pattern, begin = pattern[2:], "(?s)^(?:[^/]*\\.)?"
    parts = {"*": ".*", "^": "(?:[^0-9A-Za-z_.%-]|\\z)"}
    return begin + "".join(parts.get(c) or re.escape(c) for c in pattern) + "\\z"


def tokens(pattern: str) -> list[str]:
    """Tokens that each URL which the pattern fits holds, in lower case."""
    body = pattern.removeprefix("||")
    # What a wild card may go on with is not a whole token; the begin and the end are bounds.
    inner = re.sub(r"[0-9A-Za-z]*\*[0-9A-Za-z]*", "*", body)
    return sorted({t.lower() for t in re.findall(TOKEN, inner)})


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.coalesce(ascii_lower(host), empty), F.coalesce(path, empty)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def judged(pages: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """`pages` with `host`, `path`, `rule` (a listed one that decides, else null), `verdict`.

    Columns of these names are replaced.
    """
    spark = pages.sparkSession
    made = ("host", "path", "rule", "verdict")
    rest = [c for c in pages.columns if c not in made]
    host, path = host_and_path(F.col("url"))
    urls = staged(
        pages.select("url").filter("url IS NOT NULL").distinct().select("url", host.alias("host"), path.alias("path")), "urls"
    )
    held = F.array_distinct(
        F.regexp_extract_all(ascii_lower(F.concat("host", F.lit("/"), "path")), F.lit(f"({TOKEN})"))
    )
    each = urls.select("url", "host", "path", F.explode(F.concat(held, F.array(F.lit("")))).alias("token"))
    rows = [
        (i, r.action, r.name, r.listed, regex(r.pattern), len(r.pattern.strip("|*")), t)
        for i, r in enumerate(rules)
        for t in tokens(r.pattern) or [""]
    ]
    names = "id int, action string, name string, listed boolean, regex string, length int, token string"
    terms = spark.createDataFrame(rows, names)
    often = each.join(terms.select("token").distinct(), "token").groupBy("token").count()
    rare = F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token")
    index = staged(
        terms.join(often, "token", "left")
        .groupBy("id", "action", "name", "listed", "regex", "length")
        .agg(F.min(rare)["token"].alias("token")),
        "rules",
    )
    # A listed rule decides over all others; else the longest, else the first.
    rank = F.struct(~F.col("listed"), -F.col("length"), F.col("name"), F.col("id"))
    fits = each.join(index, "token").filter(F.expr("concat(host, path) rlike regex"))
    best = fits.groupBy("url").agg(F.min_by(F.struct("name", "listed", "action"), rank).alias("best"))
    decided = urls.join(best, "url", "left").select(
        F.col("url").alias("of_url"),
        "host",
        "path",
        F.when(F.col("best.listed"), F.col("best.name")).alias("rule"),
        F.coalesce("best.action", F.lit(ALLOW)).alias("verdict"),
    )
    # Null URLs need no join; in it, they would all meet in one task.
    known = pages.select(rest).filter("url IS NOT NULL")
    known = known.join(decided, F.col("url") == F.col("of_url"), "left")
    unknown = pages.select(rest).filter("url IS NULL")
    rows = known.drop("of_url").unionByName(unknown, allowMissingColumns=True)
    return rows.select(
        *rest,
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"),
    )
