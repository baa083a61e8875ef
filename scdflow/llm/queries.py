"""The operators with production parameters over whole tables, and SQL for some of them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scdflow.sources.shared import new_folder, staged

from . import (
    decontaminate,
    fingerprint,
    language,
    licenses,
    mixture,
    ngrams,
    oracles,
    phrases,
    simhash,
    sketches,
    tokens,
    trie,
    urls,
    warc,
)

#: Tokenizer file, the id that ends a document, and that the tokenizer lower-cases.
TOKENIZER, END_ID, LOWER = public_tokenizers.path("word_bpe_49k.json"), 2, True
URL_RULES = (
    urls.listed("block", "net", "/"),
    urls.listed("allow", "example.net", "/en/"),
    urls.listed("block", "example.com", "/de/"),
    urls.listed("allow", "org", "/fr/"),
    urls.Rule("block", "||spam-farm.*", "spam-farm", False),
    urls.Rule("block", "||cheap-pills.*", "cheap-pills", False),
    urls.Rule("block", "||free-bets.*", "free-bets", False),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.leaks(docs, items)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judged(pages, URL_RULES).drop("url")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return ngrams.score(docs, language.remainder(10) != 0, order=3, mu=None)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), folder)
    return warc.records(spark, folder).select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compared(_table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = staged(simhash.fingerprints(docs).drop("text"), "prints")
    return prints.join(simhash.groups(prints), "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.labelled(_table(spark, sf_dir, "documents"))
    joined = {c: F.array_join(c, ",") for c in ("base_labels", "labels")}
    return found.withColumns(joined)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture.mixed(_table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        F.round("target", 6).alias("target"),
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    tokens.write(_table(spark, sf_dir, "documents"), TOKENIZER, END_ID, folder, LOWER)
    return tokens.digests(spark, folder)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = language.remainder(4) == 2
    model = language.train(docs.filter(~held_out))
    judged = language.predict(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.near_duplicates(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(_table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_url_filters,
        op3_lm_scoring,
        op4_warc,
        op5_fingerprints,
        op6_simhash,
        op7_license_scans,
        op8_mixing,
        op9_token_ids,
        op10_language_id,
        op11_near_duplicates,
        op12_prefix_trie,
        op13_collocations,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _listed(words: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words.split()) + "]"


def _url_sql() -> str:
    return rf"""
    WITH rest AS (
        SELECT page_id, CASE WHEN contains(url, '://')
            THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ), parts AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM rest
    ), rules(action, on_host, on_path) AS (
        VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
            ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
    ), best AS (
        SELECT page_id, max_by({{'rule': on_host || on_path, 'action': action}},
            length(on_host || on_path)) AS best
        FROM parts JOIN rules
        ON (host = on_host OR ends_with(host, '.' || on_host)) AND starts_with(path, on_path)
        GROUP BY page_id
    )
    SELECT p.page_id, host, path, best.rule AS rule, coalesce(best.action,
        CASE WHEN regexp_matches(host, '(^|\.)(spam-farm|cheap-pills|free-bets)\.')
        THEN 'block' ELSE 'allow' END) AS verdict
    FROM parts p LEFT JOIN best b ON p.page_id = b.page_id
    """


_WARC_SQL = f"""
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes
        FROM pages
    ), w AS (
        SELECT *, CASE WHEN payload_bytes >= {warc.LEAST}
            THEN max(page_id) OVER (PARTITION BY html) END AS response_id
        FROM p
    )
    SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
        CASE WHEN response_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN response_id <> page_id THEN response_id END AS refers_to
    FROM w
"""


def _license_sql() -> str:
    def place(phrase: str) -> str:
        own = phrase.split()
        return " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(own))

    places = " OR ".join(f"({place(p)})" for p in licenses.PHRASES)
    base = ", ".join(
        f"CASE WHEN len(list_filter(range(1, len(w) + 1), lambda i: {place(p)})) > 0 THEN '{label}' END"
        for p, label in licenses.PHRASES.items()
    )
    rows = ", ".join(
        f"({x.template}, '{x.label}', {x.reach}, {x.o}, {list(x.t)}, {list(x.must)}::VARCHAR[], ' {' '.join(x.name)} ')"
        for x in licenses.sought()
    )
    vocabulary = sorted({w for x in licenses.sought() for w in (*x.t, *x.must, *x.name)})

    def words(text: str) -> str:
        lower = f"translate({text}, '{_UPPER}', '{_LOWER}')"
        between = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
        return f"list_filter(string_split_regex({lower}, '{between}'), lambda x: x <> '')"

    return f"""
    WITH d AS (SELECT doc_id, {words("coalesce(text, '')")} AS w FROM documents),
    b AS (
        SELECT doc_id, w, list_filter(range(1, len(w) + 1), lambda i: {places}) AS places,
            list_filter([{base}], lambda x: x IS NOT NULL) AS base_labels
        FROM d
    ), templates(template, label, reach, o, t, must, name) AS (VALUES {rows}),
    windows AS (
        SELECT *, list_intersect(b, {vocabulary}) AS v FROM (
            SELECT doc_id, reach, nth, w[nth * reach + 1:(nth + 2) * reach] AS b FROM (
                SELECT doc_id, w, reach, unnest(range(0, (len(w) - 1) // reach + 1)) AS nth
                FROM d, (SELECT DISTINCT reach FROM templates) WHERE len(w) > 0
            )
        )
    ), pairs AS (
        SELECT doc_id, x.reach, nth, label, list_sort(list_intersect(t, v)) AS common, len(t) AS size
        FROM windows x JOIN templates y ON x.reach = y.reach AND len(v) >= o
        WHERE len(list_intersect(t, v)) >= o AND len(list_intersect(must, v)) = len(must)
            AND (name = '  ' OR contains(' ' || array_to_string(b, ' ') || ' ', name))
    ), found AS (
        SELECT doc_id, label, len(common) / size AS score FROM pairs p WHERE NOT EXISTS (
            SELECT 1 FROM pairs q WHERE q.doc_id = p.doc_id AND q.reach = p.reach AND q.nth = p.nth
                AND len(q.common) > len(p.common)
                AND len(list_intersect(p.common, q.common)) = len(p.common))
    ), labels AS (
        SELECT doc_id, list(DISTINCT label) AS found, max(score) AS score FROM found GROUP BY doc_id
    )
    SELECT b.doc_id, len(w)::BIGINT AS n_words, len(places)::BIGINT AS n_base,
        places[1] - 1 AS first_word, places[-1] - 1 AS last_word,
        array_to_string(list_sort(list_distinct(base_labels)), ',') AS base_labels,
        array_to_string(list_sort(list_distinct(list_concat(base_labels, coalesce(found, [])))), ',')
            AS labels,
        coalesce(score, 0.0) AS score
    FROM b LEFT JOIN labels l ON b.doc_id = l.doc_id
    """


_MIX_SQL = rf"""
    WITH d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))
            AS size,
            (('0x' || substr(md5('{mixture.SEED}:' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5)
            / {float(1 << 52)} AS u
        FROM documents
    ), s AS (
        SELECT source, sum(size)::DOUBLE AS source_size, CASE WHEN sum(size) > 0
            THEN sum(size * size)::DOUBLE / sum(size) ELSE 1.0 END AS even, {mixture.MOST} * sum(size)::DOUBLE AS stop,
            [1.0, 2.0, 3.0][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::DOUBLE
            AS weight
        FROM d GROUP BY source
    ), levels AS (
        SELECT *, (sum(source_size) OVER () - coalesce(sum(stop) OVER (ORDER BY stop / weight,
            source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY stop / weight, source IS NULL, source
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM s
    ), first AS (
        SELECT level FROM levels WHERE level * weight <= stop
        ORDER BY stop / weight, source IS NULL, source LIMIT 1
    ), plans AS (
        SELECT source, source_size, even, least(stop, (SELECT level FROM first) * weight) AS target,
            CASE WHEN source_size > 0 THEN least(stop, (SELECT level FROM first) * weight)
            / source_size ELSE 0 END AS ratio
        FROM levels
    ), odds AS (
        SELECT d.*, p.source_size, p.target, floor(ratio) AS copies, ratio - floor(ratio) AS share,
            target - floor(ratio) * p.source_size AS wanted,
            least((ratio - floor(ratio)) * size::DOUBLE / even, {mixture.CERTAIN}) AS p
        FROM d JOIN plans p ON d.source IS NOT DISTINCT FROM p.source
    ), ranked AS (
        SELECT *, u * (1 - p) / (u * (1 - p) + (1 - u) * p) AS rank FROM odds
    ), ended AS (
        SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id) AS ended FROM ranked
    ), off AS (
        SELECT *, abs(ended - wanted) AS off,
            min(abs(ended - wanted)) OVER (PARTITION BY source) AS least FROM ended
    ), cut AS (
        SELECT *, min(CASE WHEN off = least AND least < wanted THEN ended END)
            OVER (PARTITION BY source) AS cut FROM off
    )
    SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size,
        round(target, 6) AS target,
        ((copies + CASE WHEN share > 0 AND size > 0 AND ended <= cut THEN 1 ELSE 0 END) * size)::BIGINT AS taken
    FROM cut
"""

ORACLE_SQL = {
    "op2_url_filters": _url_sql(),
    "op4_warc": _WARC_SQL,
    "op7_license_scans": _license_sql(),
    "op8_mixing": _MIX_SQL,
    "op11_near_duplicates": oracles.NEAR,
    "op12_prefix_trie": oracles.TRIE,
    "op13_collocations": oracles.PHRASES,
}
