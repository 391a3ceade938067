"""DuckDB SQL for the queries that SQL can express, written apart from the Spark code."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce('0' || source, '1') AS host, {_WORDS} AS w
  FROM documents),
base AS (
  SELECT rid, doc_id, t, host, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols
  FROM d),
raw_lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
dups AS (
  SELECT rid, (count(*) - count(DISTINCT line))::BIGINT AS n FROM raw_lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
wins AS (
  SELECT rid, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM wins) WHERE c > 1),
reps AS (
  SELECT rid, count(*)::BIGINT AS n
  FROM (SELECT DISTINCT rid, i + k AS p FROM twice, (SELECT unnest([0, 1, 2]) AS k)) GROUP BY rid),
lines AS (
  SELECT DISTINCT b.host, b.t, array_to_string(regexp_extract_all(
      regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g'),
      '[^\x20\x09-\x0D]+'), ' ') AS key
  FROM raw_lines r JOIN base b USING (rid) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
sizes AS (SELECT host, count(DISTINCT t) AS docs FROM base GROUP BY host),
frequent AS (
  SELECT host, key FROM lines JOIN sizes USING (host) GROUP BY host, key, docs HAVING count(*) > 5 AND count(*) > 0.005 * docs),
lost AS (
  SELECT r.rid, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')))::BIGINT AS n
  FROM raw_lines r JOIN base b USING (rid) JOIN frequent f ON f.host = b.host AND f.key = array_to_string(regexp_extract_all(
      regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g'),
      '[^\x20\x09-\x0D]+'), ' ')
  GROUP BY r.rid),
f AS (
  SELECT doc_id, n_words, word_chars, n_symbols, coalesce(dups.n, 0) AS n_dup_lines, coalesce(reps.n, 0) AS n_repeat_words,
    coalesce(lost.n, 0) AS n_removed_words
  FROM base LEFT JOIN dups USING (rid) LEFT JOIN reps USING (rid) LEFT JOIN lost USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND NOT (n_words - n_removed_words < 50 OR n_removed_words > 0.5 * n_words) AS kept,
  n_removed_words
FROM f
"""

OP3 = """
WITH m AS (
  SELECT coalesce('0' || conv_id, '1') AS key, conv_id, turn, role, coalesce(text, '') AS text,
    floor(turn / 256)::BIGINT AS block,
    ('0x' || substr(md5(coalesce('0' || role, '1') || chr(10) || coalesce(text, '')), 1, 2))::BIGINT AS slice FROM conversations),
r AS (SELECT *, row_number() OVER (PARTITION BY key, block ORDER BY turn NULLS FIRST, slice, role NULLS LAST, text) - 1 AS n FROM m),
p AS (SELECT DISTINCT key, role AS participant FROM m WHERE role IS NOT NULL AND role <> 'system'),
s AS (
  SELECT r.key, conv_id, participant, block, n // 256 AS sub_block, n, coalesce(role = participant, false) AS own, text,
    '<|im_start|>' || CASE WHEN role = participant THEN 'assistant' WHEN role = 'system' THEN 'system'
      ELSE 'user name=' || coalesce(role, 'unknown') END || chr(10) AS head
  FROM r JOIN p USING (key)),
o AS (
  SELECT *, sum(length(head) + length(text) + 11) OVER (PARTITION BY key, participant, block, sub_block ORDER BY n) AS stop FROM s)
SELECT any_value(conv_id) AS conv_id, participant, block, sub_block, count(*)::BIGINT AS n_messages,
  (count(*) FILTER (WHERE own))::BIGINT AS n_assistant,
  string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY n) AS rendered,
  coalesce(string_agg((stop - 11 - length(text))::BIGINT || ':' || stop::BIGINT, ',' ORDER BY n) FILTER (WHERE own), '') AS mask_spans
FROM o GROUP BY key, participant, block, sub_block
"""

OP5 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM (SELECT * FROM v WHERE vec_id % 20 = 0 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY v) = 1) q
  JOIN v c ON q.vec_id <> c.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

OP6 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('0' || source, '1') AS key, len({_WORDS})::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2))::BIGINT AS slice FROM documents),
b AS (SELECT *, length(size::VARCHAR) * 100 + substr(rpad(size::VARCHAR, 2, '0'), 1, 2)::INT AS band FROM d),
z AS (
  SELECT key, sum(size)::BIGINT AS source_size, 2 * sum(size)::DOUBLE AS cap,
    CASE (row_number() OVER (ORDER BY key) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM d GROUP BY key),
g AS (
  SELECT *, 1.5 * sum(source_size::DOUBLE) OVER () AS total,
    sum(cap) OVER (ORDER BY cap / w, key ROWS UNBOUNDED PRECEDING) - cap AS caps_before,
    sum(w) OVER (ORDER BY cap / w, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_from FROM z),
h AS (SELECT *, cap * w_from <= (total - caps_before) * w AS full_ FROM g),
a AS (
  SELECT key, source_size, CASE WHEN full_ THEN cap ELSE least(cap, w * ((total - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER ())
    / sum(CASE WHEN full_ THEN 0 ELSE w END) OVER ())) END AS target,
    ('0x' || substr(md5('mix-1:' || key), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start FROM h),
p AS (
  SELECT b.*, a.source_size, a.target, a.start, CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0 END AS rate,
    (row_number() OVER (PARTITION BY key ORDER BY band, slice, size, doc_id) - 1)::DOUBLE AS place
  FROM b JOIN a USING (key)),
c AS (SELECT *, least(2, floor((place + 1) * rate + start) - floor(place * rate + start))::BIGINT AS copies FROM p)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM c
"""

OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha1 FROM pages),
f AS (SELECT sha1, min(page_id) AS first FROM p GROUP BY sha1),
g AS (SELECT p.*, f.first, page_id IS NOT DISTINCT FROM first OR first IS NULL AS own FROM p JOIN f USING (sha1))
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(sha1, ((i // 4) * 5 + 1)::INT, 5))::BIGINT >> ((3 - i % 4) * 5)::INT) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN own THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN own THEN NULL ELSE first END AS refers_to
FROM g
"""

OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (
  SELECT rid, i, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l),
f AS (SELECT key FROM (SELECT DISTINCT rid, key FROM k WHERE length(key) >= 1) GROUP BY key HAVING count(*) >= 10),
s AS (
  SELECT rid, string_agg(line, chr(10) ORDER BY i) AS kept, count(*)::BIGINT AS n
  FROM k WHERE key NOT IN (SELECT key FROM f) GROUP BY rid)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (rid)
"""

OP12 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, 1 AS words, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM w)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
c AS (SELECT lang, words, phrase, count(*)::BIGINT AS f FROM g GROUP BY lang, words, phrase HAVING count(*) >= 10),
x AS (SELECT lang, words, phrase, f AS a, unnest(range(1, words)) AS k, string_split(phrase, ' ') AS q FROM c WHERE words > 1),
y AS (
  SELECT x.lang, x.words, x.phrase, a, k, l.f AS l, r.f AS r, ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM x JOIN c l ON l.lang = x.lang AND l.phrase = array_to_string(q[1:k], ' ')
  JOIN c r ON r.lang = x.lang AND r.phrase = array_to_string(q[k + 1:x.words], ' ')),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
u AS (
  SELECT lang, q[1] || ' ' || q[2] AS phrase, a FROM x WHERE words = 3 UNION ALL
  SELECT lang, q[2] || ' ' || q[3], a FROM x WHERE words = 3),
v AS (SELECT lang, phrase, max(a) AS longer FROM u GROUP BY lang, phrase),
s AS (SELECT z.* FROM z LEFT JOIN v USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * z.a)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM s) JOIN t USING (lang)
WHERE rank <= 2000
"""

OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM v WHERE vec_id % 100 = 0 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM a JOIN v c ON c.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same QUALIFY place <= 5)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.*, vec_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, place ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
WHERE rank <= 5
"""

ORACLES = {
    "op1_line_frequency": OP1,
    "op3_perspectives": OP3,
    "op5_norm_buckets": OP5,
    "op6_systematic_mix": OP6,
    "op7_warc_index": OP7,
    "op11_line_runs": OP11,
    "op12_collocations": OP12,
    "op13_hard_negatives": OP13,
}
