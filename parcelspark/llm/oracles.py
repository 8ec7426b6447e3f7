"""DuckDB statements for the queries that SQL can express, worded independently of the operators."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY = rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {WORDS} AS ws FROM documents),
windows AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM w, unnest(range(1, len(ws) - 1)) AS u(i)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) AS r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS xs FROM w),
c AS (
  SELECT doc_id, lang, source, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, len(xs)::BIGINT AS n_lines,
         (len(xs) - len(list_distinct(xs)))::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words
  FROM w JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
measures AS (
  SELECT doc_id, lang, source, base_failed, unnest([0, 1, 2, 3]) AS rule,
         unnest([word_chars * 100 // n_words, n_symbols * 1000 // word_chars, greatest(n_dup_lines - 1, 0) * 1000 // n_lines,
                 n_repeat_words * 1000 // n_words]) AS v
  FROM judged WHERE n_words > 0),
binned AS (SELECT *, if(v < 64, v, v - v % (1 << (length(bin(v)) - 6))) AS b FROM measures WHERE NOT base_failed),
own AS (
  SELECT lang, source, rule, count(*) AS n, min(b) FILTER (4 * upto >= total) AS q1, min(b) FILTER (4 * upto >= 3 * total) AS q3
  FROM (SELECT *, count(*) OVER (PARTITION BY lang, source, rule ORDER BY b) AS upto,
               count(*) OVER (PARTITION BY lang, source, rule) AS total FROM binned) GROUP BY ALL),
merged AS (
  SELECT lang, rule, count(*) AS n, min(b) FILTER (4 * upto >= total) AS q1, min(b) FILTER (4 * upto >= 3 * total) AS q3
  FROM (SELECT *, count(*) OVER (PARTITION BY lang, rule ORDER BY b) AS upto,
               count(*) OVER (PARTITION BY lang, rule) AS total FROM binned) GROUP BY ALL),
whole AS (
  SELECT rule, min(b) FILTER (4 * upto >= total) AS q1, min(b) FILTER (4 * upto >= 3 * total) AS q3
  FROM (SELECT *, count(*) OVER (PARTITION BY rule ORDER BY b) AS upto,
               count(*) OVER (PARTITION BY rule) AS total FROM binned) GROUP BY ALL),
chosen AS (
  SELECT own.lang, own.source, rule, [50, 10, 30, 50][rule + 1] AS least, [NULL, NULL, 100, 100][rule + 1] AS most,
         CASE WHEN own.n >= 100 THEN own.q1 WHEN merged.n >= 100 THEN merged.q1 ELSE whole.q1 END AS q1,
         CASE WHEN own.n >= 100 THEN own.q3 WHEN merged.n >= 100 THEN merged.q3 ELSE whole.q3 END AS q3,
         merged.q3 + 3 * greatest(merged.q3 - merged.q1, most) AS of_lang, whole.q3 + 3 * greatest(whole.q3 - whole.q1, most) AS of_all
  FROM own JOIN merged USING (rule) JOIN whole USING (rule) WHERE own.lang IS NOT DISTINCT FROM merged.lang),
quartiles AS (
  SELECT *, q1 - 3 * greatest(q3 - q1, least) AS low,
         CASE WHEN most IS NULL THEN q3 + 3 * greatest(q3 - q1, least)
              ELSE least(q3 + 3 * greatest(q3 - q1, least), of_lang, of_all) END AS high
  FROM chosen),
within AS (
  SELECT doc_id, bool_and(v <= high AND (m.rule > 0 OR v >= low)) AS ok
  FROM measures m JOIN quartiles q ON m.rule = q.rule AND m.lang IS NOT DISTINCT FROM q.lang AND m.source IS NOT DISTINCT FROM q.source
  GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(ok, FALSE) AS kept
FROM judged LEFT JOIN within USING (doc_id)"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y),
component AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE link.x = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN component c ON c.x = e.vec_id"""

CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(t) + length(t) - length(replace(t, '\', ''))
            + len(regexp_extract_all(t, '</?s>|\[/?(?:SYS|INST|ANS|ROLE|TEXT)\]'))
            + length(CASE role WHEN 'system' THEN '<s>[SYS]  [/SYS]</s>' WHEN 'user' THEN '<s>[INST]  [/INST]'
                               WHEN 'assistant' THEN '<s>[ANS]  [/ANS]</s>' END) AS chars
  FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars,
       regexp_full_match(string_agg(role, ',' ORDER BY turn), '(system,)?user,assistant(,user,assistant)*') AS valid
FROM sized GROUP BY conv_id"""

# Host labels from the right, without user, "www." and usual ports; then path and query. Without a host the address itself.
_URL_PARTS = r"""regexp_extract(low, '^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^?#]*)(\?[^#]*)?', ['host', 'path', 'query'])"""

WARC = rf"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS best,
         lower(regexp_replace(coalesce(url, 'urn:x-none'), '[\x00-\x20\x7f]+', '%20', 'g')) AS low
  FROM pages),
parts AS (SELECT *, {_URL_PARTS} AS u FROM p),
hosts AS (SELECT *, regexp_replace(regexp_replace(u.host, '^.*@', ''), '^www\.', '') AS host FROM parts),
keyed AS (
  SELECT *, CASE WHEN u.host = '' THEN low ELSE
           array_to_string(list_reverse(string_split(regexp_replace(host, ':.*$', ''), '.')), ',')
           || regexp_replace(regexp_extract(host, ':.*$'), '^:(80|443)?$', '') || ')' || if(u.path = '', '/', u.path)
           || if(u.query = '?', '', u.query) END AS url_key
  FROM hosts)
SELECT page_id, octet_length(encode(body)) AS payload_bytes,
       translate(list_aggregate(list_transform(range(8), lambda i:
         to_base(CAST('0x' || substr(sha1(body), CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT), 32, 4)), 'string_agg', ''),
         '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       if(page_id = best, 'response', 'revisit') AS record_type, if(page_id = best, NULL, best) AS refers_to,
       row_number() OVER (ORDER BY encode(url_key), page_id % 1000000000, page_id) - 1 AS position
FROM keyed"""

SUBSTRINGS = rf"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS g FROM w, unnest(range(1, len(ws) - 48)) AS u(i)),
hit AS (SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM hit, range(50) AS r(k)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w) ANTI JOIN gone USING (doc_id, p)
  GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

NEGATIVES = """
WITH rows AS (
  SELECT vec_id, if(vec_id % 7 = 0, (label + 1) % 10, label) AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER fit)::INTEGER AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW fit AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER fit <= 3"""
