"""DuckDB SQL for the rows of the near-duplicate, trie and phrase queries."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"[^\x20\x09-\x0D]+"

NEAR = rf"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
            '{_WORDS}') AS w
        FROM documents
    ), s AS (
        SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 4
            THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
        FROM w
    ), sets AS (
        SELECT s, row_number() OVER () AS node, len(s) AS size FROM (SELECT DISTINCT s FROM s WHERE len(s) > 0)
    ), e AS (SELECT node, size, unnest(s) AS e FROM sets),
    links AS (
        SELECT a.node AS a, b.node AS b FROM e a JOIN e b ON a.e = b.e AND a.node <> b.node
        GROUP BY a.node, b.node, a.size, b.size
        HAVING 100 * count(*) >= 80 * (a.size + b.size - count(*))
    ), reach(node, met) AS (
        SELECT node, node FROM sets UNION SELECT node, b FROM reach JOIN links ON met = a
    ), ids AS (SELECT node, min(doc_id) AS first_id FROM s JOIN sets ON s.s = sets.s GROUP BY node),
    least AS (SELECT r.node, min(first_id) AS component_id FROM reach r JOIN ids ON met = ids.node GROUP BY r.node)
    SELECT doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
        doc_id = coalesce(component_id, doc_id) AS kept
    FROM s LEFT JOIN sets ON s.s = sets.s LEFT JOIN least ON sets.node = least.node
"""

#: CRC-32 bit by bit over the digits of the id.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda v, z: xor(v >> 1, (v & 1) * 3988292384))))"""

TRIE = rf"""
    WITH own AS (
        SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
            ORDER BY turn NULLS FIRST, role, text) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
    ), h AS (SELECT *, ({_CRC} % 4)::BIGINT AS h FROM own),
    paths AS (
        SELECT h.conv_id, list_concat(coalesce(b.turns, [])[1:h.h], h.turns[h.h + 1:]) AS path
        FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20
    ), prefixes AS (
        SELECT conv_id, d, path[1:d] AS node, len(path) = d AS ends
        FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM paths)
    ), nodes AS (
        SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM prefixes GROUP BY node, d
    ), children AS (
        SELECT node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
    ), family AS (
        SELECT n.*, coalesce(c.n_children, 0) AS n_children, p.conv_id AS parent_conv_id,
            CASE WHEN n.d > 0 THEN (n.n_convs - 1) * len(regexp_extract_all(n.node[n.d].t, '{_WORDS}'))
            ELSE 0 END AS saved
        FROM nodes n LEFT JOIN children c ON n.node = c.node
        LEFT JOIN nodes p ON n.d > 0 AND p.node = n.node[1:n.d - 1]
    ), below AS (
        SELECT node[1:up] AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
            sum(saved) AS saved_tokens
        FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM family) GROUP BY 1
    )
    SELECT f.conv_id, f.d::BIGINT AS depth, f.parent_conv_id, f.n_convs::BIGINT AS n_convs,
        f.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves,
        b.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
    FROM family f JOIN below b ON f.node = b.node
"""

PHRASES = rf"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    every AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
    grams AS (
        SELECT lang, unnest(flatten(list_transform(range(1, 5), lambda k:
            list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))))) AS phrase
        FROM w
    ), f AS (
        SELECT lang, phrase, string_split(phrase, ' ') AS w, count(*) AS f
        FROM grams GROUP BY lang, phrase HAVING count(*) >= 30
    ), cuts AS (SELECT lang, phrase, w, f AS a, unnest(range(1, len(w))) AS k FROM f),
    scored AS (
        SELECT c.lang, c.phrase, c.a, l.f AS l, r.f AS r, k,
            (2000000::HUGEINT * c.a // (l.f + r.f))::BIGINT AS score
        FROM cuts c
        JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
    ), worst AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), parts AS (
        SELECT lang, f, unnest(flatten(list_transform(range(2, len(w)), lambda k:
            list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))))) AS phrase
        FROM f
    ), longer AS (SELECT lang, phrase, max(f) AS f FROM parts GROUP BY lang, phrase),
    ranked AS (
        SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
        FROM worst s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase
        WHERE g.f IS NULL OR 100 * g.f < 80 * a
    )
    SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN every e ON e.lang = r.lang
    WHERE rank <= 2000
"""
