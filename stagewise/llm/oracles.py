"""The same rows as some of the queries, in DuckDB's SQL, each by the plainest way it can be written."""

from __future__ import annotations

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_SPACED = r"'[^\x20\x09-\x0D]+'"


def _words(pattern: str, lower: bool = True) -> str:
    text = "coalesce(text, '')"
    return f"regexp_extract_all({f'translate({text}, {_AZ})' if lower else text}, {pattern})"


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words(_LETTERS)} AS ws FROM documents),
b AS (SELECT item_id, {_words(_LETTERS)} AS ws FROM benchmark),
iw AS (
    SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[p:p + 9], ' ') AS win
    FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM b WHERE len(ws) > 0)
),
dw AS (
    SELECT doc_id, p, size, array_to_string(ws[p:p + size - 1], ' ') AS win
    FROM (
        SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS p
        FROM d, (SELECT DISTINCT size FROM iw) WHERE len(ws) >= size
    )
),
hit AS (SELECT DISTINCT doc_id, p, size, item_id FROM dw JOIN iw USING (win, size)),
covered AS (
    SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hit) GROUP BY doc_id
),
found AS (
    SELECT doc_id, count(DISTINCT item_id) AS n,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM hit GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(found.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

LINE_DEDUP = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (
    SELECT doc_id, p, ls[p] AS a, ls[p + 1] AS b, ls[p + 2] AS c
    FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS p FROM d WHERE len(ls) >= 3)
),
ranked AS (
    SELECT doc_id, p, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p) AS n
    FROM w WHERE regexp_replace(a || b || c, '\\s', '', 'g') <> ''
),
gone AS (SELECT doc_id, list(DISTINCT q) AS qs FROM
    (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM ranked WHERE n > 1) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(qs), 0) AS BIGINT) AS n_removed,
    sha256(CASE WHEN qs IS NULL THEN coalesce(text, '')
        ELSE array_to_string([ls[i] for i in range(1, len(ls) + 1) if not list_contains(qs, i)], chr(10)) END)
        AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, h, strlen(h) >= 1000 AND page_id <> max(page_id) OVER (PARTITION BY h) AS again,
    max(page_id) OVER (PARTITION BY h) AS original FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
    CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN original END AS refers_to
FROM q
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
lowest AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(y, vec_id)) AS component_id,
    least(vec_id, coalesce(y, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN degree ON vec_id = degree.x LEFT JOIN lowest ON vec_id = lowest.x
"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_words(_SPACED, False)} AS ws FROM documents),
w AS (
    SELECT doc_id, p, hash(win) AS a, md5(win) AS b FROM (
        SELECT doc_id, p, array_to_string(ws[p:p + 49], ' ') AS win
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM d WHERE len(ws) >= 50)
    )
),
later AS (
    SELECT doc_id, p FROM w JOIN (SELECT a, b, min(doc_id) AS lowest FROM w GROUP BY a, b) USING (a, b)
    WHERE doc_id > lowest
),
gone AS (
    SELECT doc_id, list(DISTINCT q) AS qs FROM (SELECT doc_id, unnest(range(p, p + 50)) AS q FROM later) GROUP BY doc_id
),
stays AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM (
        SELECT d.doc_id, ws[i] AS word, i FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d) AS d
        LEFT JOIN (SELECT doc_id, unnest(qs) AS q FROM gone) AS g ON g.doc_id = d.doc_id AND g.q = i WHERE q IS NULL
    ) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(qs), 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN stays USING (doc_id)
"""

JACCARD_JOIN = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(_SPACED)} AS ws FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(ws[p:p + 2], ' ') AS g
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS p FROM d WHERE len(ws) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id),
links AS (
    SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)
),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
lowest AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON lowest.x = doc_id
"""

FILTER_AUDIT = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
cut AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS lowest FROM texts),
tags AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
fails AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * list_unique(ws) < 50 * len(ws) THEN 'B' ELSE '' END
        || CASE WHEN 100 * strlen(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > lowest THEN 'E' ELSE '' END AS failed
    FROM cut LEFT JOIN tags USING (doc_id)
),
kinds AS (SELECT part, failed, good, toxic, count(*) AS n FROM fails GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
    JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
),
steps AS (
    SELECT filter_order, step, filter_order[step] AS f, filter_order[1:step - 1] AS earlier
    FROM orders, (SELECT unnest(range(1, 6)) AS step)
),
met AS (
    SELECT part, filter_order, step, f, good, toxic, n, contains(failed, f) AS fails_it,
        translate(earlier, failed, '') <> earlier AS gone, failed = f AS only_it FROM kinds, steps
),
sums AS (
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, f,
        sum(CASE WHEN NOT gone AND NOT fails_it THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN NOT gone AND fails_it THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN gone AND fails_it THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN only_it THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN NOT gone AND fails_it AND good THEN n ELSE 0 END) AS good_lost,
        sum(CASE WHEN NOT gone AND fails_it AND toxic THEN n ELSE 0 END) AS toxic_lost
    FROM met GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM sums
"""
