"""The queries that SQL can express, in SQL of another engine (DuckDB)."""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
windows AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS phrase
            FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
spots AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, spots.n, item FROM spots JOIN windows USING (phrase)),
covered AS (SELECT doc_id, count(DISTINCT spot) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_RULE_PHRASES = (
    "javascript|cookie policy|privacy policy|terms of use|terms of service|all rights reserved|"
    "sign in|log in|click here|read more|subscribe|share this|back to top|lorem ipsum|"
    "datenschutzerklärung|nutzungsbedingungen|alle rechte vorbehalten|hier klicken|weiterlesen|"
    "nach oben|newsletter abonnieren|impressum|"
    "politique de confidentialité|conditions d''utilisation|tous droits réservés|cliquez ici|lire la suite|"
    "haut de page|s''abonner|mentions légales|"
    "política de privacidad|política de cookies|términos de uso|todos los derechos reservados|"
    "haga clic aquí|leer más|iniciar sesión|aviso legal"
)
_SPACE = r"[\x20\x09-\x0D]"

RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
triples AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS t
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) > 2)),
twice AS (SELECT doc_id, t FROM triples GROUP BY doc_id, t HAVING count(*) > 1),
repeats AS (SELECT doc_id, count(DISTINCT spot) AS n
            FROM (SELECT doc_id, unnest(range(i, i + 3)) AS spot FROM triples JOIN twice USING (doc_id, t)) GROUP BY doc_id),
tested AS (SELECT doc_id, line, len(regexp_replace(line, '{_SPACE}', '', 'g')) AS visible,
                  len(regexp_replace(line, '[^#*$%&<>{{}}\\^~=_]', '', 'g')) AS symbols,
                  regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w
           FROM (SELECT doc_id, unnest(lines) AS line FROM words)),
passed AS (SELECT doc_id, sum(visible) AS good FROM (
             SELECT *, len(w) AS n, len(list_filter(w, lambda x: regexp_matches(right(x, 2), '[!?]{{2}}|[#*$%&]{{2}}'))) AS marked,
                    len(list_filter(w, lambda x: x IN ('|', '»', '›', '•', '>', '>>', '/'))) AS bars FROM tested)
           WHERE NOT (10 * symbols > visible OR 4 * marked > n OR (bars >= 3 AND n <= 4 * bars)
                      OR (n >= 12 AND 4 * len(list_distinct(w)) < n)
                      OR (n >= 8 AND line = upper(line) AND line <> lower(line))
                      OR (n <= 25 AND regexp_matches(lower(line), '{_RULE_PHRASES}')))
           GROUP BY doc_id),
counted AS (SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
                   CAST(len(text) - len(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   coalesce(n, 0) AS n_repeat_words, coalesce(good, 0) AS good
            FROM words LEFT JOIN repeats USING (doc_id) LEFT JOIN passed USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND good >= 0.75 * word_chars AS kept
FROM judged
"""

NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
             CAST(list_dot_product(a.e, r.e) AS BIGINT) AS score
      FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id, score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
                   AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

ORACLES = {
    "op7_quality_rules": RULES,
    "op10_benchmark_decontamination": DECONTAMINATION,
    "op11_hard_negative_mining": NEGATIVES,
}
