"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": r"""
WITH folded AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
                FROM documents),
tests AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS key
            FROM tests, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s(p) WHERE len(w) > 0),
docs AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM folded),
places AS (SELECT doc_id, p, k, array_to_string(w[p:p + k - 1], ' ') AS key
           FROM docs, (SELECT DISTINCT k FROM windows) AS sizes, unnest(generate_series(1, len(w) - k + 1)) AS s(p) WHERE len(w) >= k),
found AS (SELECT doc_id, p, k, item_id FROM places JOIN windows USING (k, key)),
hits AS (SELECT doc_id, count(DISTINCT p + o) AS n_hit FROM (SELECT DISTINCT doc_id, p, k FROM found), unnest(generate_series(0, k - 1)) AS s(o)
         GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS listed
          FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id),
runs AS (SELECT doc_id, item_id, p, q, p - q AS diagonal FROM (
             SELECT DISTINCT d.doc_id, i.item_id, d.p, i.q, d.k FROM places AS d JOIN (
                 SELECT item_id, q, least(len(w), 10) AS k, array_to_string(w[q:q + least(len(w), 10) - 1], ' ') AS key
                 FROM tests, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s(q) WHERE len(w) > 0) AS i USING (k, key))),
longest AS (SELECT doc_id, max(n) AS longest_match FROM (
                SELECT doc_id, count(*) - 1 + any_value(size) AS n FROM (
                    SELECT r.*, least(len(t.w), 10) AS size,
                           r.p - row_number() OVER (PARTITION BY r.doc_id, r.item_id, r.diagonal ORDER BY r.p) AS island
                    FROM runs AS r JOIN (SELECT DISTINCT item_id, w FROM tests) AS t USING (item_id))
                GROUP BY doc_id, item_id, diagonal, island) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       CAST(coalesce(longest_match, 0) AS BIGINT) AS longest_match
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN longest USING (doc_id)
""",
    "op2_warc_revisits": r"""
WITH base AS (SELECT page_id AS p, url, html, '"' || substr(md5(html), 1, 16) || '"' AS tag, 1700000000 + page_id * 60 AS ts FROM pages),
revisits AS (SELECT p, CASE WHEN p % 4 = 0 THEN regexp_replace(url, '^https?://', 'http://www.') WHEN p % 4 = 1 THEN url || '#again'
                            WHEN p % 4 = 2 THEN regexp_replace(url, '^https:', 'http:') ELSE url END AS url,
                    ts + CASE WHEN p % 11 = 0 THEN -3600 ELSE 86400 END AS ts,
                    CASE WHEN p % 13 = 0 THEN '"stale"' ELSE tag END AS etag, CASE WHEN p % 2 <> 0 THEN 't' || p END AS changed FROM base),
responses AS (SELECT p, url, ts, html, CASE WHEN p % 7 = 0 THEN NULL WHEN p % 5 = 0 THEN 'W/' || tag ELSE tag END AS etag,
                     CASE WHEN p % 3 <> 0 THEN 't' || p END AS changed FROM base),
both_kinds AS (SELECT p, 1 AS kind, url FROM revisits UNION ALL SELECT p, 0, url FROM responses),
cut AS (SELECT p, kind, lower(split_part(split_part(regexp_replace(split_part(url, '#', 1), '^[a-z]+://', ''), '/', 1), '?', 1)) AS host,
               substr(regexp_replace(split_part(url, '#', 1), '^[a-z]+://', ''),
                      length(split_part(split_part(regexp_replace(split_part(url, '#', 1), '^[a-z]+://', ''), '/', 1), '?', 1)) + 1) AS rest
        FROM both_kinds),
canon AS (SELECT p, kind, CASE WHEN starts_with(host, 'www.') THEN substr(host, 5) ELSE host END || rtrim(split_part(rest, '?', 1), '/')
                 || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(split_part(rest, '?', 2), '&'),
                        lambda x: x <> '' AND NOT starts_with(x, 'utm_') AND NOT starts_with(x, 'ref='))), '&'), ''), '') AS key FROM cut),
r AS (SELECT revisits.*, key FROM revisits JOIN canon USING (p) WHERE kind = 1),
f AS (SELECT key, ts, max(p) AS fp FROM responses JOIN canon USING (p) WHERE kind = 0 GROUP BY key, ts),
met AS (SELECT r.*, f.fp FROM r ASOF LEFT JOIN f ON r.key = f.key AND r.ts > f.ts),
judged AS (SELECT met.*, s.html, s.etag AS own_tag, s.changed AS own_changed,
                  CASE WHEN fp IS NULL THEN 'no_earlier_response'
                       WHEN coalesce(met.etag = replace(s.etag, 'W/', ''), met.changed = s.changed) IS NULL THEN 'no_validator'
                       WHEN coalesce(met.etag = replace(s.etag, 'W/', ''), met.changed = s.changed) THEN 'resolved'
                       ELSE 'validator_mismatch' END AS outcome
           FROM met LEFT JOIN responses AS s ON met.fp = s.p)
SELECT p AS page_id, key AS canonical_url, outcome, fp AS response_page_id, CASE WHEN outcome = 'resolved' THEN 200 END AS status,
       CASE WHEN outcome = 'resolved' THEN 'cache-control=max-age=3600;content-length=' || strlen(html) || ';content-type=text/html;date=d' || p
            || ';etag=' || etag || coalesce(';last-modified=' || coalesce(changed, own_changed), '') END AS headers,
       CASE WHEN outcome = 'resolved' THEN CAST(strlen(html) AS BIGINT) END AS payload_bytes,
       CASE WHEN outcome = 'resolved' THEN md5(html) END AS payload_md5
FROM judged
""",
    "op9_suffix_dedup": r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
windows AS (SELECT doc_id, s, md5(array_to_string(w[s + 1:s + 50], ' ')) AS key
            FROM docs, unnest(generate_series(0, len(w) - 50)) AS g(s) WHERE len(w) >= 50),
again AS (SELECT doc_id, s FROM windows WHERE key IN (SELECT key FROM windows GROUP BY key HAVING count(*) > 1)),
islands AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS island FROM (
                SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50 THEN 0 ELSE 1 END AS new FROM again))
SELECT doc_id, CAST(min(s) AS BIGINT) AS start_word, CAST(max(s) + 50 - min(s) AS BIGINT) AS n_words FROM islands GROUP BY doc_id, island
""",
    "op11_divergence": r"""
WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT id, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
sources AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL),
rates AS (SELECT s.lang, s.source, k.term, coalesce(c.c, 0) AS c,
                 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 1)) // (coalesce(n.n, 0) + z.v) AS p
          FROM sources AS s JOIN kept AS k USING (lang) JOIN sizes AS z USING (lang)
          LEFT JOIN n ON n.lang = s.lang AND n.source = s.source
          LEFT JOIN counts AS c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
langs AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (sum(c) + 1)) // (sum(sum(c)) OVER (PARTITION BY lang) + any_value(v)) AS q
          FROM rates JOIN sizes USING (lang) GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
          FROM rates AS a JOIN rates AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every_pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
               FROM sources AS a JOIN sources AS b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN pairs AS p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
          FROM rates JOIN langs USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
           FROM (SELECT * FROM every_pair UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= 200
""",
    "op13_collocations": r"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang,
                     string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
parts AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM docs)),
grams AS (SELECT lang, k, array_to_string(w[p:p + k - 1], ' ') AS phrase
          FROM parts, (VALUES (1), (2), (3), (4)) AS sizes(k), unnest(generate_series(1, len(w) - k + 1)) AS s(p) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
cuts AS (SELECT c.lang, c.k, c.phrase, c.a, c.w, cut, l.f AS l, r.f AS r, (CAST(2000000 AS HUGEINT) * c.a) // (l.f + r.f) AS score
         FROM (SELECT *, unnest(generate_series(1, k - 1)) AS cut FROM candidates) AS c
         JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
         JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:c.k], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, array_to_string(w[p:p + s - 1], ' ') AS phrase, max(a) AS most
           FROM (SELECT *, unnest(generate_series(1, k - s + 1)) AS p FROM (SELECT *, unnest(generate_series(2, k - 1)) AS s FROM candidates WHERE k > 2))
           GROUP BY ALL),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
           FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE most IS NULL OR 100 * most < 80 * a)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
""",
}
