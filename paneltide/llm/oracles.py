"""DuckDB SQL for the operators that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op7_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
win AS (
  SELECT doc_id, unnest(range(1, greatest(len(ws) - 18, 1))) AS s, ws FROM w),
seq AS (SELECT doc_id, s, array_to_string(ws[s : s + 19], ' ') AS k FROM win),
late AS (
  SELECT doc_id, s FROM seq
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM late),
lists AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
word AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
kept AS (
  SELECT word.doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY word.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

ORACLE["op8_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body))::BIGINT AS n, sha1(body) AS h FROM p),
b AS (
  SELECT page_id, n, list_reduce([
    list_reduce([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, 1 + 10 * g, 10))::BIGINT) >> (35 - 5 * j)) & 31)::INT + 1, 1)
                 for j in range(8)], lambda x, y: x || y)
    for g in range(4)], lambda x, y: x || y) AS digest
  FROM d),
r AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS head FROM b)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = head THEN NULL ELSE head END AS refers_to
FROM r
"""

ORACLE["op9_decontamination"] = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
bs AS (SELECT item_id, ws, least(len(ws), 13) AS m FROM bw WHERE len(ws) > 0),
bwin AS (SELECT item_id, m, unnest(range(1, len(ws) - m + 2)) AS s, ws FROM bs),
keys AS (SELECT DISTINCT item_id, m, array_to_string(ws[s : s + m - 1], ' ') AS k FROM bwin),
sizes AS (SELECT DISTINCT m FROM keys),
dwin AS (SELECT doc_id, m, unnest(range(1, len(ws) - m + 2)) AS s, ws FROM dw, sizes WHERE len(ws) >= m),
hits AS (
  SELECT doc_id, s, dwin.m, item_id FROM (SELECT doc_id, m, s, array_to_string(ws[s : s + m - 1], ' ') AS k FROM dwin) dwin
  JOIN keys ON keys.k = dwin.k AND keys.m = dwin.m),
nh AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS i FROM hits) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
       FROM hits GROUP BY doc_id)
SELECT dw.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN nh USING (doc_id) LEFT JOIN it USING (doc_id)
"""

# crc32 byte by byte from the decimal digits, as DuckDB has no function for it.
# A run is an island of matches on one lag that no run of a shorter period holds.
ORACLE["op12_periodic_runs"] = r"""
WITH base AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: ascii(c)::BIGINT)),
      lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda c, z: xor(c >> 1, 3988292384::BIGINT * (c & 1)))), 4294967295::BIGINT) AS h
  FROM documents),
par AS (SELECT doc_id, ws, h, len(ws)::BIGINT AS n, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM base),
per AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM par),
seq AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: ws[(CASE WHEN i < a THEN i ELSE a + (i - a) % p END) + 1]) ELSE ws END AS ws
  FROM per),
w AS (SELECT doc_id, n, unnest(ws) AS x, generate_subscripts(ws, 1)::BIGINT - 1 AS i FROM seq),
m AS (
  SELECT b.doc_id, b.i, b.i - a.i AS d FROM w a JOIN w b ON a.doc_id = b.doc_id AND a.x = b.x AND b.i > a.i AND 4 * (b.i - a.i) <= b.n),
isl AS (SELECT doc_id, d, i, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS g FROM m),
cand AS (
  SELECT doc_id, min(i) - d AS s, count(*) + d AS l, d AS q FROM isl GROUP BY doc_id, d, g HAVING count(*) >= greatest(6 - d, 3 * d)),
runs AS (
  SELECT * FROM cand c WHERE NOT EXISTS (
    SELECT 1 FROM cand o WHERE o.doc_id = c.doc_id AND o.q < c.q AND o.s <= c.s AND o.s + o.l >= c.s + c.l)),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY l DESC, s, q) = 1),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT w.doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY w.doc_id)
SELECT seq.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS "start", l::BIGINT AS length, q::BIGINT AS period,
       (1000 * l // q)::BIGINT AS exponent_milli, sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM seq LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# Bytes as pairs of hexadecimal digits.  A byte is gone if the last late window at
# or before it began less than 100 bytes ago.
ORACLE["op13_suffix_dedup"] = r"""
WITH base AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
byte AS (SELECT doc_id, unnest(range(len(hx) // 2)) AS s, len(hx) // 2 AS n, hx FROM base),
win AS (SELECT doc_id, s, substr(hx, 2 * s + 1, 2) AS b, CASE WHEN s + 100 <= n THEN md5(substr(hx, 2 * s + 1, 200)) END AS k FROM byte),
late AS (SELECT doc_id, s, b, k IS NOT NULL AND row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1 AS late FROM win),
gone AS (
  SELECT doc_id, s, b, coalesce(s - max(CASE WHEN late THEN s END) OVER (PARTITION BY doc_id ORDER BY s ROWS UNBOUNDED PRECEDING) < 100, false) AS gone
  FROM late),
edge AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY s), false) AS opens FROM gone),
done AS (
  SELECT doc_id, count(*) AS n, sum(gone::BIGINT) AS m, sum(opens::BIGINT) AS spans, string_agg(b, '' ORDER BY s) FILTER (WHERE NOT gone) AS kept
  FROM edge GROUP BY doc_id)
SELECT base.doc_id, coalesce(n, 0)::BIGINT AS n_bytes, coalesce(m, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM base LEFT JOIN done USING (doc_id)
"""
