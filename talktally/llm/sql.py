"""The same results in plain SQL, where it can express them."""

from __future__ import annotations

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Components of a relation links(a, b) over a relation nodes(id): the smallest id reachable.
_REACH = """
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (
    SELECT id, id FROM nodes
    UNION
    SELECT reach.id, edges.b FROM reach JOIN edges ON reach.other = edges.a
),
comp AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""

JACCARD_JOIN = f"""
WITH RECURSIVE words AS (
    SELECT doc_id,
        regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
    END AS s
    FROM words
),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS c
    FROM one AS x JOIN one AS y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
    GROUP BY ALL
),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 75 * (na + nb - c)),
nodes AS (SELECT doc_id AS id FROM documents),{_REACH}
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id
FROM sets JOIN comp ON doc_id = id
"""

WARC_INDEX = r"""
WITH payloads AS (
    SELECT page_id, url, coalesce(html, '') AS payload,
        strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS digest
    FROM pages
),
last AS (SELECT digest, max(page_id) AS last FROM payloads WHERE size >= 1000 GROUP BY digest),
keyed AS (
    SELECT page_id, size, digest, last,
        coalesce(array_to_string(list_reverse(string_split(lower(
            regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1)), '.')), ',') || ')' ||
            regexp_replace(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*|#.*$', '', 'g'), '') AS url_key
    FROM payloads LEFT JOIN last USING (digest)
)
SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
    CASE WHEN size < 1000 OR page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN size >= 1000 AND page_id <> last THEN last END AS refers_to,
    row_number() OVER (ORDER BY url_key, page_id) - 1 AS position
FROM keyed
"""

LATTICE_DEDUP = f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id FROM embeddings),
good AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b
    FROM good AS x JOIN good AS y ON x.vec_id < y.vec_id AND len(x.v) = len(y.v)
    WHERE list_dot_product(x.v, y.v)
        / sqrt(list_dot_product(x.v, x.v) * list_dot_product(y.v, y.v)) >= 0.95
),{_REACH}
SELECT id AS vec_id, component_id, id = component_id AS kept,
    (SELECT count(*) FROM edges WHERE edges.a = comp.id) AS n_links
FROM comp
"""

WINNOWING = f"""
WITH items AS (
    SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '{_WORD}') AS w
    FROM benchmark WHERE item_id IS NOT NULL
),
known AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM known),
docs AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w
    FROM documents
),
places AS (
    SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)
),
met AS (SELECT r, n, i, g FROM places SEMI JOIN (SELECT DISTINCT n, g FROM known) USING (n, g)),
hit AS (
    SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(range(i, i + n)) AS p FROM met) GROUP BY r
),
held AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (
        SELECT DISTINCT r, item_id::VARCHAR AS item
        FROM (SELECT DISTINCT r, n, g FROM met) JOIN known USING (n, g)
    ) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN held USING (r)
"""

HARD_NEGATIVES = """
WITH rows_ AS (
    SELECT row_number() OVER () AS r, vec_id,
        (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
        [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
),
scored AS (
    SELECT a.r, a.vec_id AS anchor_id, b.r AS other, b.vec_id, a.label = b.label AS same,
        coalesce(list_dot_product(a.e, b.e), 0)::BIGINT AS s
    FROM rows_ AS a JOIN rows_ AS b
        ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.e) = len(b.e)
),
best AS (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY s DESC, vec_id, other)::INTEGER AS rank
    FROM scored WHERE same QUALIFY rank <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.s AS positive_score,
    n.s AS negative_score, p.rank AS positive_rank,
    row_number() OVER (PARTITION BY p.r, p.other ORDER BY n.s DESC, n.vec_id)::INTEGER AS rank
FROM best AS p JOIN scored AS n
    ON p.r = n.r AND NOT n.same AND 50 * p.s <= 100 * n.s AND 100 * n.s <= 95 * p.s
QUALIFY row_number() OVER (PARTITION BY p.r, p.other ORDER BY n.s DESC, n.vec_id) <= 3
"""

COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
    FROM (
        SELECT lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")},
            '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents
    )
),
grams AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM pieces, range(1, 5) AS sizes(size) WHERE len(w) >= size)
),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
cuts AS (
    SELECT c.lang, c.size, c.phrase, c.f AS a, k, x.f AS l, y.f AS r,
        (2000000::HUGEINT * c.f // (x.f + y.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM cand) AS c
    JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(w[:k], ' ')
    JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
),
inside AS (
    SELECT lang, array_to_string(w[i:i + part - 1], ' ') AS phrase, max(f) AS most
    FROM (SELECT *, unnest(range(1, size - part + 2)) AS i
        FROM (SELECT *, unnest(range(2, size)) AS part FROM cand))
    GROUP BY ALL
),
ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
        phrase, a, l, r, score
    FROM cuts LEFT JOIN inside USING (lang, phrase)
    WHERE coalesce(100::HUGEINT * most < 80::HUGEINT * a, true)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def all_sql() -> dict[str, str]:
    return {
        "op2_warc_index_merge": WARC_INDEX,
        "op7_lattice_dedup": LATTICE_DEDUP,
        "op10_jaccard_join": JACCARD_JOIN,
        "op11_hard_negatives": HARD_NEGATIVES,
        "op12_son_collocations": COLLOCATIONS,
        "op13_winnowing": WINNOWING,
    }
