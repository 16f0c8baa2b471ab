"""DuckDB SQL of the queries that SQL can express."""

from rolecall.llm.license_scan import TEMPLATES

ORACLE: dict[str, str] = {}

_LINE_PASSES = r"""(w = 0 OR NOT (
    (w < 20 AND NOT regexp_matches(line, '[.!?…:;。！？।]+["''”’»)\]]*[\x20\x09-\x0D]*\z'))
    OR (length(line) - length(regexp_replace(line, '[|•·»›]', '', 'g')) >= 3
        AND (length(line) - length(regexp_replace(line, '[|•·»›]', '', 'g'))) * 4 >= w)
    OR (length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) >= 3
        AND (length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g'))) * 4 > w)
    OR (w >= 5 AND upper(line) = line AND lower(line) <> line)
    OR (w < 20 AND regexp_matches(line, '(?i)lorem ipsum|enable javascript|cookie policy|privacy policy|terms of use|terms of service|all rights reserved|click here|read more|sign up|log in|subscribe'))
))"""

ORACLE["op7_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), split_words AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), words AS (
  SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM split_words
), threes AS (
  SELECT r, i, w || ' ' || lead(w, 1) OVER of_text || ' ' || lead(w, 2) OVER of_text AS three FROM words WINDOW of_text AS (PARTITION BY r ORDER BY i)
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, three) AS c FROM threes WHERE three IS NOT NULL
), repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE c > 1) GROUP BY r
), split_lines AS (
  SELECT r, unnest(string_split(t, chr(10))) AS line FROM d
), lines AS (
  SELECT r, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w,
    length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars FROM split_lines
), by_line AS (
  SELECT r, count(*) FILTER (w > 0) - count(DISTINCT line) FILTER (w > 0) AS n_dup_lines,
    coalesce(sum(chars) FILTER ({_LINE_PASSES}), 0)::BIGINT AS kept_chars
  FROM lines GROUP BY r
), counts AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, kept_chars
  FROM split_words JOIN by_line USING (r) LEFT JOIN repeated USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, kept_chars,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * kept_chars >= word_chars AS kept
FROM counts"""

# the templates are fixed values of the operator
_TEMPLATES = ", ".join("('{}', '{}')".format(label, body.replace("'", "''")) for label, body in TEMPLATES)

ORACLE["op10_license_scan"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), words AS MATERIALIZED (
  SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM d
), followed AS (
  SELECT r, i, word, lead(word, 1) OVER t AS w1, lead(word, 2) OVER t AS w2, lead(word, 3) OVER t AS w3 FROM words WINDOW t AS (PARTITION BY r ORDER BY i)
), places AS (
  SELECT r, i AS place, CASE
    WHEN word = 'gnu' AND w1 = 'general' AND w2 = 'public' AND w3 = 'license' THEN 'gpl' WHEN word = 'apache' AND w1 = 'license' THEN 'apache'
    WHEN word = 'cc' AND w1 = 'by' THEN 'cc-by' WHEN word = 'mit' AND w1 = 'license' THEN 'mit' END AS label
  FROM followed
), base AS (
  SELECT r, count(*) AS n, min(place) AS a, max(place) AS z FROM places WHERE label IS NOT NULL GROUP BY r
), bodies AS (
  SELECT row_number() OVER () AS t, label, regexp_extract_all(lower(body), '[a-z0-9]+') AS ws FROM (VALUES {_TEMPLATES}) AS v(label, body)
), templates AS (
  SELECT t, label, list_distinct(ws) AS words, CASE WHEN len(ws) <= 8 THEN 8 WHEN len(ws) <= 32 THEN 32 WHEN len(ws) <= 128 THEN 128 ELSE 512 END AS size FROM bodies
), template_words AS (
  SELECT t, label, size, len(words) AS n, unnest(words) AS word FROM templates
), blocks AS (
  SELECT DISTINCT r, t, label, n, word, unnest([i // size, i // size - 1]) AS block FROM words JOIN template_words USING (word)
), matches AS (
  SELECT r, label, count(*) / max(n) AS containment FROM blocks WHERE block >= 0 GROUP BY r, t, label, block HAVING 5 * count(*) >= 4 * max(n)
), labels AS (
  SELECT r, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT r, label FROM places WHERE label IS NOT NULL) GROUP BY r
), all_labels AS (
  SELECT r, string_agg(label, ',' ORDER BY label) AS labels FROM (
    SELECT r, label FROM places WHERE label IS NOT NULL UNION SELECT r, label FROM matches) GROUP BY r
), scores AS (SELECT r, max(containment) AS score FROM matches GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(coalesce(score, 0), 6) AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN labels USING (r) LEFT JOIN all_labels USING (r) LEFT JOIN scores USING (r)"""


def _vector_codes(parts=8, entries=16, rounds=6):
    """Every round as two tables: the codes by the last codebook, and the next codebook."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""codes{n} AS MATERIALIZED (
  SELECT r, p, min(d * {entries} + e) AS k FROM (
    SELECT r, p, e, sum((x - c) * (x - c)) AS d FROM places JOIN book{n} USING (p, j) GROUP BY r, p, e) GROUP BY r, p
)""")
        if n < rounds:
            steps.append(f"""book{n + 1} AS MATERIALIZED (
  SELECT p, e, j, coalesce(((s - ((s % n) + n) % n) // n)::BIGINT, c) AS c FROM book{n} LEFT JOIN (
    SELECT p, (k % {entries})::BIGINT AS e, j, sum(x) AS s, count(*) AS n FROM places JOIN codes{n} USING (r, p) GROUP BY ALL
  ) USING (p, e, j)
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: floor({4096} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), places AS MATERIALIZED (
  SELECT r, (i // size)::BIGINT AS p, (i % size)::BIGINT AS j, x FROM (
    SELECT r, len(v) // {parts} AS size, unnest(range(len(v))) AS i, unnest(v) AS x FROM kept)
), book0 AS MATERIALIZED (
  SELECT p, r - 1 AS e, j, x AS c FROM places WHERE r <= {entries}
), {", ".join(steps)}, coded AS (
  SELECT r, string_agg(printf('%02x', (k % {entries})::INTEGER), '' ORDER BY p) AS code, sum(k // {entries})::BIGINT AS error
  FROM codes{rounds} GROUP BY r
), errors AS (
  SELECT vec_id, label, code, error FROM coded JOIN kept USING (r)
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, j)) FROM book{rounds}) AS codebooks_sha256
FROM errors"""


ORACLE["op11_vector_codes"] = _vector_codes()

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE["op12_ranked_search"] = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS terms FROM documents
), sizes AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0
), tfs AS (
  SELECT d, doc_id, n, term, count(*) AS tf FROM (SELECT d, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM docs) GROUP BY ALL
), dfs AS (
  SELECT term, count(*) AS df FROM tfs GROUP BY term
), asked AS (
  SELECT DISTINCT q, item_id, term FROM (SELECT q, item_id, unnest(terms) AS term FROM (
    SELECT row_number() OVER () AS q, item_id, {_TERMS} AS terms FROM benchmark))
), scored AS (
  SELECT q, item_id, d, doc_id, sum(
    floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))
  )::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN dfs USING (term) CROSS JOIN sizes GROUP BY q, item_id, d, doc_id
)
SELECT item_id, (row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10"""
