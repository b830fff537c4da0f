"""DuckDB SQL for the operators that SQL can express."""

OP1 = r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 'a' || source END AS src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s0 AS (
  SELECT src, sum(size)::BIGINT AS source_size, count(*) AS n_rows,
         (row_number() OVER (ORDER BY src) - 1) % 3 + 1 AS w
  FROM sized GROUP BY src),
s1 AS (
  SELECT *, 3 * source_size AS cap, (3 * source_size)::DOUBLE / w AS ratio, sum(source_size) OVER ()::BIGINT AS total
  FROM s0),
s2 AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(w) OVER (ORDER BY ratio, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lvl
  FROM s1),
s3 AS (
  SELECT *, least(w * (SELECT arg_min(lvl, (ratio, src)) FROM s2 WHERE lvl <= ratio), cap::DOUBLE) AS target FROM s2),
p AS (
  SELECT src, source_size, n_rows, target, ceil(3 * source_size / 32)::BIGINT AS cap_blocks,
         floor((total + 16) / 32)::BIGINT AS seats, sum(target) OVER () AS all_votes
  FROM s3),
q AS (SELECT p.*, unnest(generate_series(1, cap_blocks)) AS j FROM p WHERE cap_blocks > 0),
won AS (
  SELECT src, count(*) AS quota FROM (
    SELECT src, seats, row_number() OVER (ORDER BY target / (2 * j - 1) DESC, src) AS place FROM q)
  WHERE place <= seats GROUP BY src),
sources AS (
  SELECT p.src, source_size, target, coalesce(quota, 0) AS quota,
         greatest(1, ceil((source_size + n_rows) / 1000000))::BIGINT AS n_shards
  FROM p LEFT JOIN won USING (src)),
placed AS (
  SELECT *, ('0x' || substr(draw, 1, 8))::BIGINT % n_shards AS shard FROM (
    SELECT *, md5('mix-1|' || coalesce(doc_id::VARCHAR, 'null') || '|' || size) AS draw
    FROM sized JOIN sources USING (src))),
sh AS (
  SELECT src, shard, sum(size)::BIGINT AS words, any_value(quota) AS seats,
         ceil(3 * sum(size) / 32)::BIGINT AS cap_blocks
  FROM placed GROUP BY src, shard),
shq AS (SELECT *, unnest(generate_series(1, cap_blocks)) AS j FROM sh WHERE cap_blocks > 0),
shwon AS (
  SELECT src, shard, count(*) AS shard_quota FROM (
    SELECT src, shard, seats, row_number() OVER (PARTITION BY src ORDER BY words::DOUBLE / (2 * j - 1) DESC, shard) AS place
    FROM shq) WHERE place <= seats GROUP BY src, shard),
give AS (
  SELECT src, shard, words, least(coalesce(shard_quota, 0) * 32, 3 * words)::BIGINT AS give,
         CASE WHEN words > 0 THEN
           ('0x' || substr(md5('mix-1|' || src || '|' || shard), 1, 8))::BIGINT % ceil(words / 32)::BIGINT * 32
           ELSE 0 END AS first
  FROM sh LEFT JOIN shwon USING (src, shard)),
rows_ AS (
  SELECT doc_id, source, size, source_size, target, words, first,
         CASE WHEN words > 0 THEN give // words ELSE 0 END AS passes,
         CASE WHEN words > 0 THEN give % words ELSE 0 END + first AS last,
         sum(size) OVER (PARTITION BY src, shard ORDER BY draw, doc_id NULLS FIRST, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto
  FROM placed JOIN give USING (src, shard))
SELECT doc_id, source, size, source_size::BIGINT AS source_size, target, passes::BIGINT AS passes,
       (passes * size + greatest(0, least(upto, last, words) - greatest(upto - size, first))
        + greatest(0, least(upto, last - words) - (upto - size)))::BIGINT AS taken
FROM rows_
"""

OP10 = r"""
WITH RECURSIVE pg AS (SELECT page_id, url, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id, html, rest,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(regexp_extract(rest, '^[^/?#]*([^#]*)', 1), '') AS tail FROM pg),
tags AS (SELECT host, path, tail, unnest(regexp_extract_all(coalesce(html, ''), '(?i)<(?:link|meta)\s[^<>]*>')) AS tag FROM p WHERE host <> ''),
found AS (
  SELECT host, path, tail, replace(CASE
      WHEN regexp_matches(tag, '(?i)^<link\s') AND regexp_matches(tag, '(?i)\srel\s*=\s*["'']?canonical["''\s/>]')
        THEN regexp_extract(tag, '(?i)\shref\s*=\s*["'']?([^"''\s>]+)', 1)
      WHEN regexp_matches(tag, '(?i)^<meta\s') AND regexp_matches(tag, '(?i)\shttp-equiv\s*=\s*["'']?refresh["''\s/>]')
        THEN regexp_extract(tag, '(?i)[\s;,]url\s*=\s*''?([^"''\s>]+)', 1) ELSE '' END, '&amp;', '&') AS target FROM tags),
absolute AS (
  SELECT 'http://' || host || tail AS a, CASE
      WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN substr(target, instr(target, '://') + 3)
      WHEN starts_with(target, '//') THEN substr(target, 3)
      WHEN starts_with(target, '/') THEN host || target
      WHEN starts_with(target, '?') THEN host || path || target
      WHEN regexp_matches(target, '^(#|[A-Za-z][A-Za-z0-9+.-]*:)') THEN NULL
      ELSE host || CASE WHEN regexp_extract(path, '^(.*/)?') = '' THEN '/' ELSE regexp_extract(path, '^(.*/)?') END || target
    END AS t FROM found WHERE target <> ''),
edges AS (
  SELECT a, 'http://' || translate(regexp_extract(t, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
            || regexp_extract(t, '^[^/?#]*([^#]*)', 1) AS b FROM absolute WHERE regexp_extract(t, '^[^/?#]*') <> ''),
reach(x, y) AS (
  SELECT a, b FROM (SELECT a, b FROM edges UNION SELECT b, a FROM edges UNION SELECT a, a FROM edges UNION SELECT b, b FROM edges)
  UNION SELECT r.x, e.b FROM reach r JOIN (SELECT a, b FROM edges UNION SELECT b, a FROM edges) e ON r.y = e.a),
rules(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                      ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
node_rules AS (
  SELECT n.x, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT x, regexp_extract(x, '^http://([^/?#]*)', 1) AS h, regexp_extract(x, '^http://[^/?#]*([^?#]*)', 1) AS pa FROM reach) n
  JOIN rules r ON (n.h = r.host OR ends_with(n.h, '.' || r.host)) AND starts_with(n.pa, r.path) GROUP BY n.x),
inherited AS (SELECT reach.x, min(v.verdict) AS verdict FROM reach JOIN node_rules v ON reach.y = v.x GROUP BY reach.x),
best AS (
  SELECT p.*, (SELECT max(struct_pack(n := length(r.host || r.path), rule := r.host || r.path, verdict := r.verdict))
               FROM rules r WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS r
  FROM p)
SELECT page_id, best.host, best.path, r.rule AS rule, coalesce(r.verdict, i.verdict, 'allow') AS verdict
FROM best LEFT JOIN inherited i ON best.host <> '' AND i.x = 'http://' || best.host || best.tail
"""

OP6 = r"""
WITH v AS (
  SELECT vec_id, min(embedding)::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
  GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_reduce(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]), lambda s, x: s + x) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs)
WHERE rank <= 20
"""

OP7 = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
l AS (SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN last IS NULL OR page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM p LEFT JOIN l ON p.payload_digest = l.payload_digest
"""

OP2 = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i,
         len(string_split(text, chr(10))) AS n FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM l),
r AS (SELECT *, (h + 131 * lag(h) OVER (PARTITION BY doc_id ORDER BY i)) % 2147483647 AS r FROM h),
c AS (
  SELECT *, CASE WHEN i BETWEEN 2 AND n - 2 AND r < lag(r) OVER w AND r < lead(r) OVER w THEN 1 ELSE 0 END AS cut
  FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id ORDER BY i) AS chunk FROM c),
ch AS (
  SELECT doc_id, chunk, min(i) AS s, count(*) AS k, string_agg(line, chr(10) ORDER BY i) AS body
  FROM g GROUP BY doc_id, chunk),
marked AS (
  SELECT *, k >= 2 AND regexp_matches(body, '[^\x20\x09-\x0D]')
            AND row_number() OVER (PARTITION BY body, k >= 2 ORDER BY doc_id, s) > 1 AS gone FROM ch),
texts AS (
  SELECT doc_id, sum(k)::INT AS n_lines, coalesce(sum(k) FILTER (WHERE gone), 0)::INT AS n_removed,
         coalesce(string_agg(body, chr(10) ORDER BY s) FILTER (WHERE NOT gone), '') AS text
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN t.text END AS text
FROM documents d LEFT JOIN texts t ON d.doc_id = t.doc_id
"""

OP12 = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
d AS (
  SELECT doc_id, text, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, coalesce(array_to_string(u[1:i], ''), '') AS prefix, coalesce(array_to_string(u[i + 1:j], ''), '') AS middle,
         coalesce(array_to_string(u[j + 1:n], ''), '') AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p"""

OP13 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
q AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, m, unnest(list_transform(generate_series(1, len(w) - m + 1), lambda i: w[i:i + m - 1])) AS words
  FROM q, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(w) >= m),
n AS (SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang),
f AS (SELECT lang, m, words, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
longer AS (
  SELECT lang, words, max(a) AS a FROM (SELECT lang, words[1:m - 1] AS words, a FROM f WHERE m > 2 UNION ALL SELECT lang, words[2:m], a FROM f WHERE m > 2)
  GROUP BY ALL),
c AS (
  SELECT f.lang, f.words, f.a, l.a AS l, r.a AS r, l.m AS k, n.n, (1000::HUGEINT * f.a * n.n) // (l.a::HUGEINT * r.a) AS score
  FROM f JOIN n USING (lang) JOIN f l ON l.lang = f.lang AND l.m < f.m AND l.words = f.words[1:l.m]
  JOIN f r ON r.lang = f.lang AND r.m = f.m - l.m AND r.words = f.words[l.m + 1:f.m]
  WHERE f.m > 1),
best AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
kept AS (
  SELECT b.lang, array_to_string(b.words, ' ') AS phrase, b.a, b.l, b.r, b.n, b.score
  FROM best b LEFT JOIN longer ON longer.lang = b.lang AND longer.words = b.words WHERE longer.a IS NULL OR longer.a < b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000"""
