"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH located AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
),
rules(verdict, host, path) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
        ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
),
best AS (
    SELECT l.host, l.path,
        max_by(r.host || r.path, length(r.host || r.path)) AS rule,
        max_by(r.verdict, length(r.host || r.path)) AS verdict
    FROM (SELECT DISTINCT host, path FROM located) l
    JOIN rules r ON starts_with(l.path, r.path)
        AND (l.host = r.host OR ends_with(l.host, '.' || r.host))
    GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM located LEFT JOIN best USING (host, path)
"""

OP2 = r"""
WITH item_words AS (
    SELECT DISTINCT cast(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
),
windows AS (
    SELECT item, least(13, len(w)) AS size,
        unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
            lambda i: array_to_string(w[i : i + least(13, len(w)) - 1], ' '))) AS body
    FROM item_words WHERE len(w) > 0
),
doc_words AS (
    SELECT doc_id, coalesce(list_filter(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> ''), []) AS w
    FROM documents
),
places AS (
    SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w
    FROM doc_words, (SELECT DISTINCT size FROM windows)
    WHERE len(w) >= size
),
found AS (
    SELECT p.doc_id, p.i, p.size, v.item
    FROM (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS body FROM places) p
    JOIN windows v ON p.size = v.size AND p.body = v.body
),
hit AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found) GROUP BY 1
),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1
)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP6 = r"""
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, d.vec_id,
        cast(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM whole q JOIN whole d ON q.vec_id <> d.vec_id
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank, vec_id, score
FROM scored
QUALIFY rank <= 10
"""


OP11 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
places AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS c FROM places GROUP BY ALL HAVING count(DISTINCT id) >= 10),
langs AS (
    SELECT lang, count(term) AS v, coalesce(sum(c), 0) AS n
    FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang
),
seen AS (
    SELECT lang, source, term, count(*) AS c FROM places JOIN kept k USING (lang, term) GROUP BY ALL
),
groups AS (
    SELECT lang, source, v, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs)
    JOIN (SELECT lang, v FROM langs) USING (lang)
    LEFT JOIN (SELECT lang, source, sum(c) AS n FROM seen GROUP BY ALL) USING (lang, source)
),
shares AS (
    SELECT g.lang, g.source, k.term, coalesce(s.c, 0) AS c,
        cast(1 + 1000000000 * (coalesce(s.c, 0) + 2) // (g.n + 2 * g.v) AS BIGINT) AS p,
        cast(1 + 1000000000 * (k.c + 2) // (l.n + 2 * l.v) AS BIGINT) AS q
    FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
    LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
        coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY ALL
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, cast(value AS BIGINT) AS value, cast(row_number() OVER
    (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 10
"""

OP12 = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
),
windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS body
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM docs WHERE len(w) >= 8)
),
repeated AS (
    SELECT doc_id, count(DISTINCT k) AS n FROM (
        SELECT doc_id, unnest(range(i, i + 8)) AS k FROM (
            SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, body) > 1))
    GROUP BY 1
),
frequent AS (
    SELECT doc_id, max(n) AS n
    FROM (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(w) AS x FROM docs) GROUP BY doc_id, x)
    GROUP BY 1
),
counted AS (
    SELECT doc_id, cast(len(w) AS BIGINT) AS n_words,
        coalesce(cast(list_sum(list_transform(w, lambda x: length(x))) AS BIGINT), 0) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        length(text) - length(regexp_replace(text,
            '[\x00-\x08\x0E-\x1F\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS n_signs,
        len(lines) AS n_lines, cast(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words, coalesce(f.n, 0) AS n_most,
        len(list_filter(w, lambda x: regexp_matches(x, '^[\x00-\x40\x5B-\x60\x7B-\x7F]+$'))) AS n_bare,
        len(list_filter(w, lambda x: strlen(x) > 1 AND regexp_matches(x, '[A-Z]')
            AND NOT regexp_matches(x, '[a-z]'))) AS n_loud
    FROM docs LEFT JOIN repeated r USING (doc_id) LEFT JOIN frequent f USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words
        AND word_chars BETWEEN 2 * n_words AND 20 * n_words AND 10 * n_symbols <= n_words
        AND 2 * n_signs <= word_chars AND 100 * n_dup_lines <= 30 * n_lines
        AND 10 * n_bare <= 3 * n_words AND 10 * n_most <= 3 * n_words AND 2 * n_loud <= n_words AS kept
FROM counted
"""


def _canonical(text: str) -> str:
    from wattframe.llm.licenses import SPELLINGS

    words = rf"regexp_replace({text}, '^[ \t]*(copyright\b|\(c\)|©).*$', ' ', 'gin')"
    words = rf"trim(regexp_replace(lower({words}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    for old, new in SPELLINGS.items():
        words = rf"regexp_replace({words}, '\b{old}\b', '{new}', 'g')"
    return words


def _op10() -> str:
    from wattframe.llm.licenses import KNOWN

    known = ", ".join(
        "('{}', '{}')".format(name, body.replace("'", "''")) for name, body in KNOWN
    )
    return rf"""
WITH known AS (
    SELECT min(license) AS license, sha256({_canonical("body")}) AS digest
    FROM (VALUES {known}) t(license, body) GROUP BY 2
),
lines AS (
    SELECT doc_id, unnest(regexp_split_to_array(text, '\r\n|\n|\r')) AS line FROM documents
),
found AS (
    SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
    FROM (SELECT doc_id, sha256({_canonical("line")}) AS digest FROM lines) JOIN known USING (digest)
    GROUP BY 1
)
SELECT doc_id, license, coalesce(n, 0) AS n_license_lines, coalesce(names, '') AS line_licenses
FROM (SELECT doc_id, sha256({_canonical("text")}) AS digest FROM documents)
LEFT JOIN known USING (digest) LEFT JOIN found USING (doc_id)
"""


OP7 = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, coalesce(list_filter(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> ''), []) AS w
    FROM documents
),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split),
shingles AS (
    SELECT DISTINCT doc_id, concat_ws(' ', word, second, third, fourth, fifth) AS shingle
    FROM (
        SELECT doc_id, i, word, lead(word, 1) OVER o AS second, lead(word, 2) OVER o AS third,
            lead(word, 3) OVER o AS fourth, lead(word, 4) OVER o AS fifth
        FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
    )
    WHERE fifth IS NOT NULL OR i = 1
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY 1, 2
),
links AS (
    SELECT p.a, p.b FROM pairs p JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b
    WHERE 100 * p.both >= 75 * (x.n + y.n - p.both)
),
sides AS (SELECT a AS node, b AS other FROM links UNION ALL SELECT b, a FROM links),
reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, s.other FROM reached r JOIN sides s ON s.node = r.other
),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least l ON l.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

OP8 = r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
numbered AS (
    SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS number FROM split
),
lines AS (
    SELECT doc_id, number, list_sort(list_distinct(list_filter(regexp_split_to_array(
        translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS words
    FROM numbered
),
sets AS (
    SELECT words, len(words) AS n, row_number() OVER () AS id,
        min({'doc_id': doc_id, 'number': number}) AS place
    FROM lines WHERE len(words) > 0 GROUP BY words
),
entries AS (SELECT id, n, unnest(words) AS word FROM sets),
ordered AS (
    SELECT id, n, word, row_number() OVER (PARTITION BY id ORDER BY often, word) AS rank
    FROM entries JOIN (SELECT word, count(*) AS often FROM entries GROUP BY 1) USING (word)
),
prefixes AS (SELECT id, word FROM ordered WHERE rank <= n - (3 * n + 3) // 4 + 1),
candidates AS (
    SELECT DISTINCT a.id AS a, b.id AS b FROM prefixes a JOIN prefixes b USING (word)
),
matches AS (
    SELECT c.a AS id, min(y.place) AS earliest
    FROM candidates c JOIN sets x ON x.id = c.a JOIN sets y ON y.id = c.b
    WHERE 7 * len(list_intersect(x.words, y.words)) >= 3 * (x.n + y.n)
    GROUP BY 1
),
gone AS (
    SELECT l.doc_id, list(l.number::INT ORDER BY l.number) AS removed
    FROM lines l JOIN sets s ON s.words = l.words JOIN matches m ON m.id = s.id
    WHERE m.earliest < {'doc_id': l.doc_id, 'number': l.number}
    GROUP BY 1
)
SELECT s.doc_id, coalesce(len(s.parts), 0) AS n_lines, coalesce(len(g.removed), 0) AS n_removed,
    coalesce(g.removed, []::INT[]) AS removed
FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id
"""

OP9 = r"""
WITH bodies AS (
    SELECT doc_id, encode(coalesce(text, '')) AS body,
        octet_length(encode(coalesce(text, ''))) AS n FROM documents
),
places AS (SELECT doc_id, body, unnest(range(1, n - 48)) AS i FROM bodies WHERE n >= 50),
strings AS (SELECT doc_id, i, body[i : i + 49] AS string FROM places),
covering AS (
    SELECT doc_id, i
    FROM strings JOIN (SELECT string, min(doc_id) AS first FROM strings GROUP BY 1) USING (string)
    WHERE first < doc_id
),
marked AS (
    SELECT doc_id, i, coalesce(i - lag(i) OVER o > 50, true) AS opens
    FROM covering WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
runs AS (
    SELECT doc_id, min(i) AS start, max(i) + 50 AS stop
    FROM (
        SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked
    )
    GROUP BY doc_id, run
),
gaps AS (
    SELECT doc_id, start, stop,
        coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 1) AS since
    FROM runs
),
kept AS (
    SELECT doc_id, sum(stop - start) AS n_removed, count(*) AS n_spans, max(stop) AS stop,
        string_agg(CASE WHEN start > since THEN hex(body[since : start - 1]) ELSE '' END, ''
            ORDER BY start) AS begun
    FROM gaps JOIN bodies USING (doc_id) GROUP BY 1
)
SELECT b.doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(n_spans, 0) AS n_spans,
    sha256(CASE WHEN k.doc_id IS NULL THEN body
        WHEN k.stop > n THEN unhex(begun)
        ELSE unhex(begun || hex(body[k.stop : n])) END) AS kept_sha256
FROM bodies b LEFT JOIN kept k ON k.doc_id = b.doc_id
"""

ORACLE = {
    "op1_url_filter": OP1,
    "op2_decontamination": OP2,
    "op6_top_k": OP6,
    "op7_near_dedup": OP7,
    "op8_line_dedup": OP8,
    "op9_suffix_array": OP9,
    "op10_licenses": _op10(),
    "op11_source_divergence": OP11,
    "op12_quality_rules": OP12,
}
