"""DuckDB SQL for the queries that SQL can express over whole tables.

Token files and packing (a tokenizer file), language ID and the URL filter
(trained models) and the license scan are tested against brute force and
round trips instead.
"""

from __future__ import annotations

import string

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct(CASE
    WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s
  FROM w),
t AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM s),
both_ AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, min(a.n) AS na, min(b.n) AS nb
  FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM both_ WHERE 100 * c >= 90 * (na + nb - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id,
       CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE min(s.doc_id) OVER (PARTITION BY s.s) END AS class_id
FROM s JOIN (SELECT doc_id, min(c) AS component_id FROM r GROUP BY 1) m USING (doc_id)
"""

OP5 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT vec_id, label, v FROM v WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
      AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label
      AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      AND list_cosine_similarity(a.v, b.v) >= 0.93),
r AS (SELECT vec_id, vec_id AS c FROM v UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.vec_id)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, m.component_id, v.vec_id = m.component_id AS kept
FROM v LEFT JOIN (SELECT x, count(*) AS n FROM l GROUP BY 1) n ON n.x = v.vec_id
JOIN (SELECT vec_id, min(c) AS component_id FROM r GROUP BY 1) m ON m.vec_id = v.vec_id
"""

OP7 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '{_WORD}')) AS l
  FROM documents),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep WHERE c > 1) GROUP BY 1),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
    CAST(length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS BIGINT) AS n_letters
  FROM d LEFT JOIN cov USING (doc_id)),
b AS (
  SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
    | (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    | (CASE WHEN n_symbols > n_words THEN 4 ELSE 0 END)
    | (CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END)
    | (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END)
    | (CASE WHEN 2 * n_letters < word_chars THEN 32 ELSE 0 END) AS BIGINT) AS fail_bits
  FROM m)
SELECT *, fail_bits & 3 <> 0 AS base_failed, fail_bits & 63 = 0 AS kept FROM b
"""

OP8 = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) AS source_no FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][CAST((source_no - 1) % 3 + 1 AS INT)] AS BIGINT) AS w,
             2 * source_size AS lim FROM s),
o AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) * 150
         - 100 * CAST(coalesce(sum(lim) OVER (ORDER BY lim / w, source_no
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS left_,
         CAST(sum(w) OVER (ORDER BY lim / w, source_no
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS weights
  FROM w),
f AS (SELECT *, 100 * lim * weights <= w * left_ AS is_full FROM o),
q AS (SELECT left_, weights FROM f WHERE NOT is_full ORDER BY lim / w, source_no LIMIT 1),
g AS (
  SELECT f.source, f.source_size, CASE WHEN is_full THEN CAST(lim AS DOUBLE)
         ELSE CAST(w * q.left_ AS DOUBLE) / CAST(100 * q.weights AS DOUBLE) END AS target
  FROM f LEFT JOIN q ON TRUE),
r AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, CAST(floor(g.target) AS BIGINT) AS budget,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before_
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
x AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS whole FROM r)
SELECT doc_id, size, source_size, target, CAST(whole * size
       + greatest(0, least(budget - whole * source_size - before_, size)) AS BIGINT) AS taken
FROM x
"""

_EXTRA = r"'\### Assistant: </turn> ok'"

OP9 = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {_EXTRA} UNION ALL SELECT -7, 1, 'assistant', {_EXTRA}),
n AS (
  SELECT *, row_number() OVER w AS pos,
    count(*) OVER (PARTITION BY conv_id) AS turns,
    CAST(sum(14 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g'))
      + length(regexp_replace(text, '([\\#<])', '\\\1', 'g'))) OVER w AS BIGINT) AS end_
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(coalesce(sum(end_) FILTER (role = 'assistant' OR pos = turns), 0) AS BIGINT) AS formatted_chars,
  CAST(count(*) FILTER (role = 'assistant' OR pos = turns) AS BIGINT) AS n_examples
FROM n GROUP BY conv_id
"""


#: CTEs ``crc(t)`` and an expression over it: the CRC-32 of a string's UTF-8
#: bytes, by the usual table of 256 remainders made from its polynomial.
_CRC_TABLE = """
crc AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
    CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i)))
"""


def _crc(text: str, table: str) -> str:
    return f"""xor(4294967295, list_reduce(
      list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(octet_length(encode({text}))),
        lambda k: CAST('0x' || substr(hex(encode({text})), 2 * k + 1, 2) AS BIGINT))),
      lambda x, y: xor(x >> 8, {table}[CAST(xor(x, y) & 255 AS BIGINT) + 1])))"""


OP11 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS t
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
         FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY t) AS a FROM win) WHERE a < doc_id),
cut AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(CASE WHEN g IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
         list_transform(list_filter(range(1, len(w) + 1), lambda k: NOT list_contains(g, k)),
                        lambda k: w[k]), ' ') END, '')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""


OP12 = rf"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
             {_crc("CAST(doc_id AS VARCHAR)", "t")} AS h FROM documents, crc),
e AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g,
             CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
f AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM e),
u AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i:
        CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) END AS w FROM f),
q AS (SELECT doc_id, n, w, unnest(range(1, n // 4 + 1)) AS q FROM u),
m AS (SELECT doc_id, n, q, list_concat([-1], list_filter(range(n - q), lambda i: w[i + 1] <> w[i + q + 1]),
                                       [n - q]) AS x FROM q),
s AS (SELECT doc_id, q, unnest(x[:-2]) + 1 AS i, unnest(x[2:]) + q AS j FROM m),
r AS (SELECT doc_id, i AS start, j - i AS length, min(q) AS period FROM s
      WHERE j - i >= greatest(6, 4 * q) GROUP BY 1, 2, 3),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC,
                                   start, period) AS k FROM r),
t AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), ''
                                                    ORDER BY start, period) AS lines FROM r GROUP BY 1),
gone AS (SELECT doc_id, list(DISTINCT i) AS g FROM (
  SELECT doc_id, unnest(range(start + period, start + length)) AS i FROM r) GROUP BY 1)
SELECT u.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
       1000 * length // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(CASE WHEN g IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
         list_transform(list_filter(range(n), lambda k: NOT list_contains(g, k)), lambda k: w[k + 1]),
         ' ') END, '')) AS collapsed_sha256
FROM u LEFT JOIN t USING (doc_id) LEFT JOIN (SELECT * FROM b WHERE k = 1) USING (doc_id)
LEFT JOIN gone USING (doc_id)
"""


_LETTERS = "[A-Za-z\u00c0-\u00ff]+"

OP13 = rf"""
WITH RECURSIVE {_CRC_TABLE},
r AS (SELECT doc_id, w, count(*) AS c FROM (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                           '{_LETTERS}')) AS w FROM documents) GROUP BY 1, 2),
h AS (SELECT w, c, {_crc("doc_id || ':' || w", "t")} AS h FROM r, crc),
e AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2)
             ELSE w END AS word, c FROM h),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM e WHERE length(word) >= 6 GROUP BY 1
      HAVING sum(c) >= 5),
x AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS k
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT a.word, b.word AS near, b.n FROM x a JOIN x b ON a.k = b.k AND a.i = b.i AND a.word <> b.word
      UNION SELECT x.word, v.word, v.n FROM x JOIN v ON x.k = v.word
      UNION SELECT v.word, x.word, x.n FROM x JOIN v ON x.k = v.word),
b AS (SELECT word, count(*) AS n_near, max(n) AS top FROM p GROUP BY 1),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
             CASE WHEN top >= 5 * v.n THEN top END AS form_n,
             (SELECT min(near) FROM p WHERE p.word = v.word AND p.n = top AND top >= 5 * v.n) AS form
      FROM v LEFT JOIN b USING (word)),
walk AS (SELECT word, word AS there, 0 AS k FROM f
         UNION ALL SELECT walk.word, f.form, k + 1 FROM walk JOIN f ON f.word = walk.there
         WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n
FROM f JOIN (SELECT word, arg_max(there, k) AS root FROM walk GROUP BY 1) USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard": OP1, "op5_embedding_dedup": OP5, "op7_quality_rules": OP7,
            "op8_source_mixing": OP8, "op9_chat_format": OP9,
            "op11_substring_dedup": OP11, "op12_periodic_runs": OP12,
            "op13_spelling_variants": OP13}
