"""DuckDB SQL for the queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS ws
  FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS ws
  FROM benchmark),
item_at AS (
  SELECT item, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS p
  FROM item WHERE len(ws) > 0),
win AS (
  SELECT DISTINCT item, n, array_to_string(ws[p:p + n - 1], ' ') AS g FROM item_at),
size AS (SELECT DISTINCT n FROM win),
doc_at AS (
  SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM doc CROSS JOIN size WHERE len(ws) >= n),
hit AS (
  SELECT doc_id, item, p, n FROM (SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS g FROM doc_at) d
  JOIN win USING (n, g)),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hit)) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

QUALITY = r"""
WITH doc AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         [l for l in string_split(coalesce(text, ''), chr(10)) if regexp_matches(l, '[^\x20\x09-\x0D]')] AS ls
  FROM documents),
place AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS p FROM doc WHERE len(ws) >= 8),
win AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[p:p + 7], ' ')) AS k FROM place),
rep AS (SELECT doc_id, count(DISTINCT q) AS n FROM (
          SELECT doc_id, unnest(range(p, p + 8)) AS q FROM win WHERE k > 1) GROUP BY doc_id),
m AS (
  SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines
  FROM doc LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
v AS (
  SELECT doc_id, lang, source, base_failed, unnest([
    {'s': 1, 'least': 5, 'v': 1000 * n_symbols // greatest(word_chars, 1)},
    {'s': 2, 'least': 30, 'v': 1000 * n_dup_lines // greatest(n_lines, 1)},
    {'s': 3, 'least': 20, 'v': 1000 * n_repeat_words // greatest(n_words, 1)},
    {'s': 4, 'least': 10, 'v': 100 * word_chars // greatest(n_words, 1)}], recursive := true) FROM f),
b AS (
  SELECT lang, source, s, least, sh, v >> sh AS m, count(*) AS n
  FROM (SELECT *, CAST(greatest(0, length(bin(v)) - 7) AS BIGINT) AS sh FROM v WHERE NOT base_failed)
  GROUP BY ALL),
c AS (
  SELECT lang, source, s, least, m << sh AS low,
         sum(n) OVER (PARTITION BY lang, source, s ORDER BY sh, m) AS upto,
         sum(n) OVER (PARTITION BY lang, source, s) AS total FROM b),
q AS (
  SELECT lang, source, s, any_value(least) AS least, min(low) FILTER (10 * upto >= total) AS q10,
         min(low) FILTER (2 * upto >= total) AS q50, min(low) FILTER (10 * upto >= 9 * total) AS q90
  FROM c GROUP BY ALL),
bad AS (
  SELECT DISTINCT doc_id FROM v JOIN q ON v.s = q.s AND v.lang IS NOT DISTINCT FROM q.lang
    AND v.source IS NOT DISTINCT FROM q.source
  WHERE v.v NOT BETWEEN q10 - 3 * greatest(q50 - q10, q.least) AND q90 + 3 * greatest(q90 - q50, q.least))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND bad.doc_id IS NULL AS kept
FROM f LEFT JOIN bad USING (doc_id)
"""

LINE_DEDUP = r"""
WITH line AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS p, unnest(ls) AS l
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
seq AS (
  SELECT doc_id, p, l, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS j
  FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
run AS (
  SELECT doc_id, j, l, lead(l, 1) OVER w AS l2, lead(l, 2) OVER w AS l3,
         len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS w1,
         lead(len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')), 1) OVER w AS w2
  FROM seq WINDOW w AS (PARTITION BY doc_id ORDER BY j)),
ranked AS (
  SELECT doc_id, j, 3 AS size, row_number() OVER (PARTITION BY l, l2, l3 ORDER BY doc_id, j) AS k
  FROM run WHERE l3 IS NOT NULL
  UNION ALL
  SELECT doc_id, j, 2, row_number() OVER (PARTITION BY l, l2 ORDER BY doc_id, j)
  FROM run WHERE l2 IS NOT NULL AND w1 + w2 >= 50
  UNION ALL
  SELECT doc_id, j, 1, row_number() OVER (PARTITION BY l ORDER BY doc_id, j) FROM run WHERE w1 >= 50),
gone AS (SELECT DISTINCT doc_id, unnest(range(j, j + size)) AS j FROM ranked WHERE k > 1),
out AS (SELECT doc_id, p FROM gone JOIN seq USING (doc_id, j)),
rest AS (
  SELECT doc_id, string_agg(l, chr(10) ORDER BY p) AS t FROM line ANTI JOIN out USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM seq GROUP BY doc_id),
r AS (SELECT doc_id, count(*) AS r FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_lines, CAST(coalesce(r, 0) AS BIGINT) AS n_removed,
       NOT (coalesce(r, 0) > 0 AND r = n) AS kept, sha256(coalesce(t, '')) AS text_sha256
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN rest USING (doc_id)
"""

PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
grams AS (
  SELECT lang, k, w[i:i + k - 1] AS p
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM lists, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
found AS (SELECT lang, k, p, count(*) AS f FROM grams GROUP BY lang, k, p HAVING count(*) >= 30),
covered AS (
  SELECT lang, p[i:i + size - 1] AS p, max(f) AS longer
  FROM (SELECT lang, p, f, k, size, unnest(range(1, k - size + 2)) AS i
        FROM found, (SELECT unnest([2, 3]) AS size) WHERE k > size)
  GROUP BY 1, 2),
free AS (
  SELECT c.* FROM found c LEFT JOIN covered v ON c.lang = v.lang AND c.p = v.p
  WHERE c.k > 1 AND (v.longer IS NULL OR 100 * v.longer::HUGEINT < 80 * c.f::HUGEINT)),
cuts AS (
  SELECT c.lang, c.p, c.f AS a, cut, x.f AS l, y.f AS r, ((2000000 * c.f::HUGEINT) // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM (SELECT lang, p, f, k, unnest(range(1, k)) AS cut FROM free) c
  JOIN found x ON x.lang = c.lang AND x.p = c.p[1:cut]
  JOIN found y ON y.lang = c.lang AND y.p = c.p[cut + 1:k]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank
  FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

VECTOR_DEDUP = """
WITH RECURSIVE numbered AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usual AS (SELECT len(e) AS size FROM numbered WHERE len(e) > 0 GROUP BY 1 ORDER BY count(*) DESC, size DESC LIMIT 1),
proper AS (
  SELECT r, vec_id, e FROM numbered, usual
  WHERE len(e) = size AND len(list_filter(e, x -> x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, x -> x <> 0)) > 0),
linked AS (SELECT a.r AS a, b.r AS b FROM proper a JOIN proper b ON a.r <> b.r AND list_cosine_similarity(a.e, b.e) >= 0.95),
reached(r, other) AS (
  SELECT r, r FROM numbered
  UNION
  SELECT reached.r, linked.b FROM reached JOIN linked ON reached.other = linked.a),
class AS (
  SELECT reached.r, min(o.vec_id) AS component_id FROM reached JOIN numbered o ON o.r = reached.other GROUP BY 1),
degree AS (SELECT a AS r, count(*) AS n_links FROM linked GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM numbered JOIN class USING (r) LEFT JOIN degree USING (r)
"""
