"""DuckDB SQL of the registered queries that SQL can express, over the whole tables."""

from __future__ import annotations

# One row per word, in order; a word holds no blank, so words joined by blanks tell
# their sequence.
OP1_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         [l for l in string_split(text, chr(10)) if regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines FROM docs
), word AS (
  SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split
), windows AS (
  SELECT rid, i, count(*) OVER whole - i + 1 AS ahead,
         concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o,
                   lead(w, 5) OVER o, lead(w, 6) OVER o, lead(w, 7) OVER o) AS g
  FROM word WINDOW o AS (PARTITION BY rid ORDER BY i), whole AS (PARTITION BY rid)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows WHERE ahead >= 8) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(8) AS r(k) GROUP BY rid
), measured AS (
  SELECT doc_id, text, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN covered USING (rid)
), failed AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 25 * n_words OR 5 * n_symbols > n_words
            OR (n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines)
            OR length(regexp_replace(text, '[^A-Z]', '', 'g')) * 100 > 40 * word_chars
            OR length(regexp_replace(text, '\p{L}', '', 'g')) * 100 > 60 * length(text)
            OR 10 * len(regexp_extract_all(text, '[.][.][.][ \t]*(\n|$)')) > 4 * n_lines) AS kept
FROM failed"""

# Per turn: its mark (of a role that has none, the escaped role between "### =" and ": "),
# the text with a backslash before each backslash, # and <, and the end mark.
OP2_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15
                 ELSE 7 + length(regexp_replace(role, '[\\#<:]', '..', 'g')) END
            + length(regexp_replace(text, '[\\#<]', '..', 'g')) + 8 AS formatted FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""

OP4_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents
), word AS (
  SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i, len(words) AS n FROM docs
), grams AS (
  SELECT doc_id, i, n, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS g
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, g FROM grams WHERE i + 4 <= n OR (n < 5 AND i = 1)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), ways AS MATERIALIZED (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a
), least_of AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(least(l.b, d.doc_id), d.doc_id) AS component_id
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least_of l ON l.a = d.doc_id"""

# A piece is a word with the white space before it, so running lengths give places.
OP10_SQL = r"""
WITH pieces AS (
  SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) - 1 AS pos, len(p) AS n
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+') AS p FROM documents)
), word AS (
  SELECT *, regexp_replace(piece, '^[\x20\x09-\x0D]+', '') AS w,
         sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM pieces
), stretches AS (
  SELECT doc_id, pos, n, upto - length(w) AS low, last_value(upto) OVER o AS high, md5(string_agg(w, ' ') OVER o) AS g
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
), met AS (
  SELECT * FROM (
    SELECT doc_id, pos, low, high, count(*) OVER (PARTITION BY g) AS times,
           row_number() OVER (PARTITION BY g ORDER BY doc_id, pos) > 1 AS again
    FROM stretches WHERE pos + 50 <= n) WHERE times > 1
), cut AS (
  SELECT *, coalesce(pos - lag(pos) OVER d > 50, true) AS new, coalesce(again AND pos - max(pos) FILTER (again) OVER e > 50, again) AS new_drop
  FROM met WINDOW d AS (PARTITION BY doc_id ORDER BY pos),
                  e AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), numbered AS (
  SELECT *, count(*) FILTER (new) OVER d AS island, count(*) FILTER (new_drop) OVER d AS part
  FROM cut WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), drops AS (
  SELECT doc_id, island, sum(n) AS n FROM (
    SELECT doc_id, island, part, max(pos) + 50 - min(pos) AS n FROM numbered WHERE again GROUP BY ALL) GROUP BY ALL
)
SELECT doc_id, min(pos) AS start_word, max(pos) + 50 - min(pos) AS n_words, CAST(min(low) AS BIGINT) AS start_char,
       CAST(max(high) AS BIGINT) AS end_char, CAST(coalesce(any_value(d.n), 0) AS BIGINT) AS n_dropped
FROM numbered LEFT JOIN drops d USING (doc_id, island) GROUP BY doc_id, island"""


OP11_SQL = r"""
WITH rows AS MATERIALIZED (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id,
       positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 3"""

OP12_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), word AS (
  SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i, len(words) AS n FROM docs
), windows AS (
  SELECT doc_id, i, n, md5(concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o,
         lead(w, 5) OVER o, lead(w, 6) OVER o, lead(w, 7) OVER o, lead(w, 8) OVER o, lead(w, 9) OVER o,
         lead(w, 10) OVER o, lead(w, 11) OVER o, lead(w, 12) OVER o)) AS g
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), copies AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM windows WHERE i + 12 <= n)
  WHERE least < doc_id
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM copies, range(13) AS r(k)
), kept AS (
  SELECT word.doc_id, string_agg(w, ' ' ORDER BY word.i) FILTER (gone.i IS NULL) AS text, count(gone.i) AS n_removed
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY word.doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""
