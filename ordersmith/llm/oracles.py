"""DuckDB SQL of the queries that SQL can express, written from the contracts alone."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words
), rows_ AS (SELECT doc_id, unnest(s) AS g FROM sets),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM rows_ a JOIN rows_ b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach AS (
  SELECT x, y FROM links
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT s.doc_id, s.n AS n_shingles, least(s.doc_id, coalesce(min(r.y), s.doc_id)) AS component_id
FROM sizes s LEFT JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, s.n
"""

# formatted_chars: per turn 22 code points of markup; a turn that cannot be parsed as it is
# grows by one for every backslash and control string in it.
OP4 = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sizes AS (
  SELECT *, list_sum([(length(x) - length(replace(x, c, ''))) // length(c) FOR c IN
    ['<s>', '</s>', '[INST]', '[/INST]', chr(92)]]) * CAST(
      contains(x, '</s>') OR contains(role, '[INST] ') OR regexp_matches(role, '(?s)\\.')
      OR regexp_matches(text, '(?s)\\.') AS INT) AS grown
  FROM (SELECT *, role || ' ' || text AS x FROM rows_)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(22 + length(role) + length(text) + grown) AS BIGINT) AS formatted_chars
FROM sizes GROUP BY conv_id
"""

# The last repeated start before a byte (or word) says whether a repeated string covers it.
OP6 = r"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT doc_id, h, unnest(range(length(h) // 2)) AS p FROM docs),
bytes AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS b,
    CASE WHEN 2 * p + 200 <= length(h) THEN md5(substr(h, 2 * p + 1, 200)) END AS k FROM places
), marked AS (
  SELECT doc_id, p, b, k IS NOT NULL AND row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1 AS again
  FROM bytes
), covered AS (
  SELECT doc_id, p, b, coalesce(p - max(CASE WHEN again THEN p END)
    OVER (PARTITION BY doc_id ORDER BY p) < 100, false) AS gone FROM marked
), edges AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens
  FROM covered
), sums AS (
  SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
    string_agg(b, '' ORDER BY p) FILTER (NOT gone) AS kept FROM edges GROUP BY doc_id
)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM docs LEFT JOIN sums USING (doc_id)
"""

OP8 = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
  SELECT doc_id, unnest(range(len(w))) AS p, unnest(w) AS word,
    unnest([CASE WHEN i + 50 <= len(w) THEN md5(array_to_string(w[i + 1:i + 50], ' ')) END
            FOR i IN range(len(w))]) AS k FROM docs
), marked AS (
  SELECT doc_id, p, word, k IS NOT NULL AND min(doc_id) OVER (PARTITION BY k) < doc_id AS again FROM words
), covered AS (
  SELECT doc_id, p, word, coalesce(p - max(CASE WHEN again THEN p END)
    OVER (PARTITION BY doc_id ORDER BY p) < 50, false) AS gone FROM marked
), sums AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
    string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept FROM covered GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN sums USING (doc_id)
"""

OP9 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL
    OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.93
), reach AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), low AS (SELECT x, min(y) AS m FROM reach GROUP BY x),
direct AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN low ON low.x = vec_id LEFT JOIN direct ON direct.x = vec_id
"""

# crc32 is written out (reflected, polynomial 0xEDB88320): DuckDB has none.
_CRC = """
  SELECT d AS crc_id, xor(list_reduce([CAST(ascii(substr(d, i, 1)) AS BIGINT) FOR i IN range(1, len(d) + 1)],
    lambda c, b: list_reduce(range(1, 9), lambda x, k: CASE WHEN x % 2 = 1
      THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(c, b)), 4294967295), 4294967295) AS h
  FROM (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS d FROM documents)
"""

OP11 = rf"""
WITH crc AS ({_CRC}),
plain AS (
  SELECT doc_id, h % 10 = 0 AS planted, h // 10 AS g,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents JOIN crc ON crc_id = CAST(doc_id AS VARCHAR)
), shaped AS (
  SELECT *, CASE WHEN planted AND len(w) > 0 THEN g % len(w) END AS a FROM plain
), texts AS (
  SELECT doc_id, CASE WHEN a IS NULL THEN w ELSE [CASE WHEN i < a THEN w[i + 1]
      ELSE w[a + (i - a) % (1 + (len(w) - a) // (3 + g % 8)) + 1] END FOR i IN range(len(w))] END AS w
  FROM shaped
), places AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS six
  FROM (SELECT doc_id, w, unnest(range(len(w) - 5)) AS i FROM texts WHERE len(w) >= 12)
), pairs AS (
  SELECT doc_id, x.i AS i, y.i - x.i AS q, x.i - row_number() OVER (PARTITION BY doc_id, y.i - x.i ORDER BY x.i) AS isle
  FROM places x JOIN places y USING (doc_id, six) WHERE x.i < y.i
), runs AS (
  SELECT doc_id, s, size, min(q) AS q FROM (
    SELECT doc_id, q, min(i) AS s, count(*) + 5 + q AS size FROM pairs GROUP BY doc_id, q, isle)
  WHERE size >= greatest(12, 2 * q) GROUP BY doc_id, s, size
), summary AS (
  SELECT doc_id, count(*) AS n_runs, max((size, -s, -q)) AS best,
    sha256(string_agg(s || ',' || size || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256
  FROM runs GROUP BY doc_id
), dropped AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + size)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM texts)
  ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -best[2] AS start, best[1] AS length, -best[3] AS period,
  (1000 * best[1]) // -best[3] AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
  sha256(coalesce(t, '')) AS collapsed_sha256
FROM texts LEFT JOIN summary USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP12 = r"""
WITH draws AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS d,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), h AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n,
    CAST('0x' || substr(d, 1, 8) AS BIGINT) % (len(u) + 1) AS x,
    CAST('0x' || substr(d, 9, 8) AS BIGINT) % (len(u) + 1) AS y,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
      OR CAST('0x' || substr(d, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
      WHEN CAST('0x' || substr(d, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM draws
), cut AS (
  SELECT *, array_to_string(u[1:least(x, y)], '') AS pre,
    array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS mid,
    array_to_string(u[greatest(x, y) + 1:], '') AS suf FROM h
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM cut
"""

OP13 = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""

ORACLES: dict[str, str] = {"op3_ngram_jaccard_join": OP3, "op4_chat_formatting": OP4,
                           "op6_suffix_array_dedup": OP6, "op8_substring_dedup": OP8,
                           "op9_embedding_near_dedup": OP9,
                           "op11_periodic_runs": OP11, "op12_fill_in_middle": OP12,
                           "op13_exact_dedup": OP13}
