"""DuckDB SQL giving the same rows as the queries that SQL can express."""

from __future__ import annotations

OP6 = """
WITH bits AS (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k:
         CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(i)),
     steps AS (SELECT list(v ORDER BY i) AS t FROM bits),
     docs AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k, coalesce(text, '') AS text FROM documents),
     draws AS (SELECT doc_id, k, text, s,
         -ln((('0x' || substr(md5(k || ':' || s), 1, 13))::BIGINT + 0.5::DOUBLE) / (16.0::DOUBLE ** 13)) AS drawn
         FROM docs, range(41) AS r(s)),
     won AS (SELECT doc_id, k, any_value(text) AS text,
         arg_min(s, drawn) FILTER (s < 40) AS shard, arg_min(s, drawn) AS grown_shard FROM draws GROUP BY doc_id, k),
     sized AS (SELECT doc_id, k, strlen(text) + 16 AS size, shard, grown_shard,
         list_transform(range(strlen(text)),
         lambda j: ('0x' || substr(hex(encode(text)), 2 * j + 1, 2))::BIGINT) AS bytes FROM won),
     summed AS (SELECT doc_id, k, size, shard, grown_shard,
         xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
             lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8)), 4294967295) AS text_crc32 FROM sized, steps)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard
           ORDER BY substr(md5(k || ':' || size || ':' || text_crc32), 1, 3), k, size, text_crc32) - 1 AS slot,
       grown_shard::INTEGER AS grown_shard
FROM summed
"""

ORACLE: dict[str, str] = {"op6_rendezvous_shards": OP6}

OP4 = r"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
     keyed AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12)
         || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
     firsts AS (SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10 GROUP BY k
         HAVING count(DISTINCT doc_id) > 1),
     marked AS (SELECT doc_id, pos, line, first_doc IS NOT NULL AND doc_id > first_doc AS gone
         FROM keyed LEFT JOIN firsts USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
ORACLE["op4_line_dedup"] = OP4

OP9 = """
WITH texts AS (SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
     windows AS (SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS w
         FROM (SELECT doc_id, h, unnest(range(greatest(n - 99, 0))) AS p FROM texts)),
     later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS k
         FROM windows) WHERE k > 1),
     edges AS (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM later),
     runs AS (SELECT doc_id, p, sum(CASE WHEN gap IS NULL OR gap > 100 THEN 1 ELSE 0 END)
         OVER (PARTITION BY doc_id ORDER BY p) AS run FROM edges),
     spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b FROM runs GROUP BY doc_id, run),
     cut AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS kept_from FROM spans),
     gone AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
         list({'a': kept_from, 'b': a} ORDER BY a) AS kept FROM cut GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE list_aggregate(list_transform(kept,
           lambda x: substr(h, 2 * x.a + 1, 2 * (x.b - x.a))), 'string_agg', '') || substr(h, 2 * last + 1) END))
       AS kept_sha256
FROM texts LEFT JOIN gone USING (doc_id)
"""
ORACLE["op9_repeated_strings"] = OP9

OP12 = """
WITH RECURSIVE bits AS (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k:
         CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(i)),
     steps AS (SELECT list(v ORDER BY i) AS t FROM bits),
     runs AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
     lowered AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k,
         translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
         FROM runs GROUP BY ALL),
     coded AS (SELECT w, n, hex(encode(k || ':' || w)) AS code FROM lowered),
     hashed AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
         range(length(code) // 2), lambda j: ('0x' || substr(code, 2 * j + 1, 2))::BIGINT)),
         lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8)), 4294967295) AS h FROM coded, steps),
     typed AS (SELECT n, CASE WHEN h % 97 = 0
         THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM hashed),
     words AS (SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
     places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
     shorter AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS left_over FROM places),
     pairs AS (SELECT s.word, v.word AS other, v.n FROM shorter s JOIN words v ON s.left_over = v.word
         UNION SELECT v.word, s.word AS other, s.n FROM shorter s JOIN words v ON s.left_over = v.word
         UNION SELECT a.word, b.word AS other, b.n FROM shorter a JOIN shorter b
             ON a.left_over = b.left_over AND a.i = b.i AND a.word <> b.word),
     best AS (SELECT word, other, n AS other_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS rank FROM pairs),
     tied AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form,
         CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
         FROM words w LEFT JOIN best b ON b.word = w.word AND b.rank = 1),
     paths AS (SELECT word, word AS reached FROM tied
         UNION ALL SELECT p.word, t.form FROM paths p JOIN tied t ON t.word = p.reached WHERE t.form IS NOT NULL),
     ends AS (SELECT p.word, p.reached AS root FROM paths p JOIN tied t ON t.word = p.reached WHERE t.form IS NULL)
SELECT t.word, t.form, e.root, t.n, t.n_near, t.form_n FROM tied t JOIN ends e ON e.word = t.word
"""
ORACLE["op12_spelling_variants"] = OP12

OP5 = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
     windows AS (SELECT rid, i, ws[i:i + 4] AS w FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 3, 1))) AS i FROM docs)),
     often AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS times FROM windows) WHERE times > 1),
     again AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM often) GROUP BY rid),
     lines AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT rid,
         unnest(string_split(t, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
     measured AS (SELECT rid, doc_id, lang, source, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
         coalesce(again.n, 0)::BIGINT AS n_repeat_words
         FROM docs LEFT JOIN lines USING (rid) LEFT JOIN again USING (rid)),
     based AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured),
     ratios AS (SELECT rid, lang, source, base_failed, unnest([
         {'rule': 'symbols', 'least': 0.05::DOUBLE, 'low': false, 'a': n_symbols, 'b': n_words},
         {'rule': 'word_length', 'least': 0.5::DOUBLE, 'low': true, 'a': word_chars, 'b': n_words},
         {'rule': 'dup_lines', 'least': 0.15::DOUBLE, 'low': false, 'a': n_dup_lines, 'b': n_lines}], recursive := true)
         FROM based),
     valued AS (SELECT *, CASE WHEN b > 0 THEN a::DOUBLE / b ELSE 0.0::DOUBLE END AS ratio FROM ratios),
     sketch AS (SELECT lang, source, rule, ceil(ln(ratio / 0.001::DOUBLE + 1) / ln(1.02::DOUBLE))::INTEGER AS bucket,
         count(*) AS n FROM valued WHERE NOT base_failed GROUP BY ALL),
     wide AS (SELECT lang, rule, bucket, sum(n) AS wide FROM sketch GROUP BY ALL),
     units AS (SELECT lang, rule, sum(wide) AS unit FROM wide GROUP BY ALL),
     parts AS (SELECT lang, source, rule, bucket, n, 0 AS wide FROM sketch
         UNION ALL SELECT g.lang, g.source, w.rule, w.bucket, 0, w.wide
         FROM (SELECT DISTINCT lang, source FROM sketch) g JOIN wide w ON g.lang IS NOT DISTINCT FROM w.lang),
     weights AS (SELECT p.lang, p.source, p.rule, p.bucket, sum(p.n * u.unit + 50 * p.wide) AS n
         FROM parts p JOIN units u ON p.lang IS NOT DISTINCT FROM u.lang AND p.rule = u.rule GROUP BY ALL),
     ranked AS (SELECT lang, source, rule, (pow(1.02::DOUBLE, bucket) - 1) * 0.001::DOUBLE AS value,
         sum(n) OVER (PARTITION BY lang, source, rule ORDER BY bucket) AS upto,
         sum(n) OVER (PARTITION BY lang, source, rule) AS size FROM weights),
     quarters AS (SELECT lang, source, rule, min(value) FILTER (4 * upto >= size) AS q1,
         min(value) FILTER (4 * upto >= 3 * size) AS q3 FROM ranked GROUP BY ALL),
     failed AS (SELECT DISTINCT rid FROM valued v JOIN quarters q ON v.rule = q.rule
         AND v.lang IS NOT DISTINCT FROM q.lang AND v.source IS NOT DISTINCT FROM q.source
         WHERE ratio > q3 + 3 * greatest(q3 - q1, least)
         OR ratio < CASE WHEN low THEN q1 - 3 * greatest(q3 - q1, least) ELSE -1 END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed.rid IS NULL AS kept
FROM based LEFT JOIN failed USING (rid)
"""
ORACLE["op5_adaptive_quality"] = OP5
