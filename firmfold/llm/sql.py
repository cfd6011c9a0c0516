"""SQL (DuckDB) counterparts of queries that SQL can express, with constants of their own."""

WARC_SQL = """WITH
payload AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
digested AS (SELECT page_id, body, sha1(body) AS sha, max(page_id) OVER (PARTITION BY body) AS largest FROM payload)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((((('0x' || sha[(k // 8) * 10 + 1:(k // 8) * 10 + 10])::BIGINT) >> (35 - 5 * (k % 8))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM digested"""

_STOP = """the of and to in a is that for it was with be by on are as from at this
der die und den das von zu mit ist im ein eine sich des nicht auf
le la les et de du un une est que dans en pour qui pas il elle
el los las y del se por con una al lo su para mi""".split()

QUALITY_SQL = f"""WITH
split AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
win AS (SELECT doc_id, k, array_to_string(w[k:k + 7], ' ') AS x FROM split, LATERAL (SELECT unnest(range(1, len(w) - 6)) AS k)),
again AS (SELECT doc_id, k FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, x) AS n FROM win) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM again, LATERAL (SELECT unnest(range(k, k + 8)) AS p) GROUP BY doc_id),
counted AS (SELECT s.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  len(list_filter(w, lambda x: list_contains([{', '.join(f"'{s}'" for s in _STOP)}], lower(x)))) AS n_stop_words,
  coalesce(c.n, 0) AS n_repeat_words, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols FROM split s LEFT JOIN covered c ON c.doc_id = s.doc_id),
tested AS (SELECT *, n_words < 20 AS b1, 100 * n_repeat_words > 30 * n_words AS b2,
  word_chars / greatest(n_words, 1) < 2 OR word_chars / greatest(n_words, 1) > 20 AS r1,
  n_symbols / greatest(n_words, 1) > 0.1 AS r2, n_stop_words / greatest(n_words, 1) < 0.02 AS r3,
  n_dup_lines / greatest(n_lines, 1) > 0.5 AS r4 FROM counted)
SELECT * EXCLUDE (b1, b2, r1, r2, r3, r4), b1 OR b2 AS base_failed,
  concat_ws(',', CASE WHEN b1 THEN 'too_short' END, CASE WHEN b2 THEN 'repeats' END, CASE WHEN r1 THEN 'word_length' END,
    CASE WHEN r2 THEN 'symbols' END, CASE WHEN r3 THEN 'stop_words' END, CASE WHEN r4 THEN 'dup_lines' END) AS failed,
  NOT (b1 OR b2 OR r1 OR r2 OR r3 OR r4) AS kept FROM tested"""

JACCARD_SQL = """WITH RECURSIVE
split AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingle AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS x FROM split,
  LATERAL (SELECT unnest(range(1, greatest(2, len(w) - 3))) AS k) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT c.a, c.b FROM common c JOIN size s ON s.doc_id = c.a JOIN size t ON t.doc_id = c.b
  WHERE 100 * c.n >= 80 * (s.n + t.n - c.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN size s ON s.doc_id = d.doc_id
  JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id"""

AUDIT_SQL = r"""WITH
doc AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
label AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
first AS (SELECT t, min(doc_id) AS least FROM doc GROUP BY t),
judged AS (SELECT d.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic, [
  len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
  100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 2 * length(d.t),
  regexp_matches(d.t, '[#$%&*|]'), d.doc_id > f.least] AS fails
  FROM doc d JOIN first f ON f.t = d.t LEFT JOIN label l ON l.doc_id = d.doc_id),
grouped AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM judged GROUP BY part, fails),
one AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM one a JOIN one b ON b.x <> a.x JOIN one c ON c.x NOT IN (a.x, b.x)
  JOIN one d ON d.x NOT IN (a.x, b.x, c.x) JOIN one e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (SELECT o, s::INTEGER AS s, list_transform(range(1, s::BIGINT), lambda i: ascii(substr(o, i, 1)) - 64) AS earlier,
  ascii(substr(o, s, 1)) - 64 AS mine FROM orders, LATERAL (SELECT unnest(range(1, 6)) AS s)),
met AS (SELECT g.*, o, s, mine, fails[mine] AS now, len(list_filter(earlier, lambda k: fails[k])) > 0 AS gone,
  len(list_filter(fails, lambda x: x)) AS n_fails FROM grouped g, steps),
counted AS (SELECT part, o AS filter_order, s AS step, mine, coalesce(sum(n) FILTER (NOT gone AND NOT now), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (NOT gone AND now), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (gone AND now), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (now AND n_fails = 1), 0)::BIGINT AS unique_fails,
  coalesce(sum(n_good) FILTER (NOT gone AND now), 0)::BIGINT AS good_lost,
  coalesce(sum(n_toxic) FILTER (NOT gone AND now), 0)::BIGINT AS toxic_lost FROM met GROUP BY part, o, s, mine)
SELECT * EXCLUDE (mine), (sum(removed) OVER (PARTITION BY part, mine))::BIGINT AS shapley FROM counted"""
