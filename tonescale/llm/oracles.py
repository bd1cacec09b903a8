"""DuckDB statements of the numbered operators that SQL can express."""

from __future__ import annotations

FILTER_AUDIT = r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), judged AS (
    SELECT d.part,
           CASE WHEN len(words) < 100 THEN 1 ELSE 0 END AS a,
           CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 1 ELSE 0 END AS b,
           CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 1 ELSE 0 END AS c,
           CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 1 ELSE 0 END AS d,
           CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE) THEN 1 ELSE 0 END AS e,
           CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) THEN 1 ELSE 0 END AS good,
           CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) THEN 1 ELSE 0 END AS toxic
    FROM words d
), counters AS (
    SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
    FROM letters p JOIN letters q ON q.x <> p.x JOIN letters r ON r.x NOT IN (p.x, q.x)
    JOIN letters s ON s.x NOT IN (p.x, q.x, r.x) JOIN letters t ON t.x NOT IN (p.x, q.x, r.x, s.x)
), steps AS (
    SELECT filter_order, step, filter_order[step:step] AS x, filter_order[1:step - 1] AS earlier
    FROM orders, unnest([1, 2, 3, 4, 5]) u(step)
), met AS (
    SELECT part, filter_order, step, x, n, good, toxic,
           CASE x WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END = 1 AS fails,
           (contains(earlier, 'A') AND a = 1) OR (contains(earlier, 'B') AND b = 1) OR (contains(earlier, 'C') AND c = 1)
               OR (contains(earlier, 'D') AND d = 1) OR (contains(earlier, 'E') AND e = 1) AS gone,
           a + b + c + d + e AS failed
    FROM counters, steps
), found AS (
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, x,
           sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN fails AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
    FROM met GROUP BY part, filter_order, step, x
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM found
"""

HARD_NEGATIVES = """
WITH moved AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS vec_id, r.label = a.label AS same,
           CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM moved a JOIN moved r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v)
    WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id, n.score AS negative_score,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

# All pairs, which the operator finds with the recall that its passes are made for.
EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), able AS (
    SELECT vec_id, label, e FROM v
    WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM v
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN least ON least.vec_id = v.vec_id
"""

JACCARD_JOIN = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                        WHEN len(w) < 5 THEN ['short ' || array_to_string(w, ' ')]
                        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM words
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM sets
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, (SELECT min(b) FROM reach r WHERE r.a = s.doc_id) AS component_id
FROM sets s
"""

ORACLES: dict[str, str] = {
    "op10_jaccard_join": JACCARD_JOIN,
    "op11_filter_audit": FILTER_AUDIT,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_embedding_dedup": EMBEDDING_DEDUP,
}
