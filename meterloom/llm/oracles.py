"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

OP10 = rf"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, row_number() OVER o AS k,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS lvl
  FROM sources WINDOW o AS (ORDER BY 3 * source_size / w, source IS NULL, encode(source))),
level AS (SELECT arg_min(lvl, k) AS lvl FROM levels WHERE lvl * w <= 3 * source_size),
targets AS (
  SELECT s.source, s.source_size, coalesce(least((3 * s.source_size)::DOUBLE, s.w * level.lvl), 0)::DOUBLE AS target
  FROM sources s CROSS JOIN level),
needs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies
  FROM targets),
running AS (
  SELECT d.doc_id, d.size, n.source_size, n.target, n.copies, n.target - n.copies * n.source_size AS need,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS inside
  FROM sized d JOIN needs n ON d.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN need > 0 AND upto - inside + inside / 2 <= need THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running
"""

BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP8 = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, {BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id <> r.largest, false) AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

#: Exact for the table sizes of the correctness check; pairs are listed through shared shingles.
OP7 = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), []) AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM worded),
cells AS (SELECT doc_id, unnest(s) AS sh, len(s) AS n FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o, any_value(a.n) AS nx, any_value(b.n) AS ny
  FROM cells a JOIN cells b ON a.sh = b.sh AND a.doc_id < b.doc_id
   AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM shared WHERE 100 * o >= 90 * (nx + ny - o)
  UNION ALL SELECT y, x FROM shared WHERE 100 * o >= 90 * (nx + ny - o)),
reach AS (
  SELECT doc_id, doc_id AS component FROM sets
  UNION SELECT l.x, r.component FROM reach r JOIN links l ON l.y = r.doc_id AND r.component < l.x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id
FROM sets s JOIN (SELECT doc_id, min(component) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""

OP6 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP11 = rf"""
WITH terms AS (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM documents),
wanted AS (
  SELECT item_id, term, count(*)::BIGINT AS times
  FROM (SELECT item_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM benchmark WHERE item_id IS NOT NULL)
  GROUP BY item_id, term),
sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM terms GROUP BY doc_id),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM sizes),
tf AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM terms
  WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term), corpus),
parts AS (
  SELECT tf.doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total))) AS part
  FROM tf JOIN sizes USING (doc_id) JOIN weights USING (term), corpus),
scored AS (
  SELECT item_id, doc_id, sum(times * part)::BIGINT AS score
  FROM parts JOIN wanted USING (term) WHERE doc_id IS NOT NULL GROUP BY item_id, doc_id),
placed AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 20
"""

OP12 = rf"""
WITH worded AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '{TERM}'), []) AS w FROM documents),
items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({LOWER}, '{TERM}') AS w FROM benchmark
  WHERE item_id IS NOT NULL AND text IS NOT NULL),
sized AS (SELECT item, w, least(10, len(w)) AS k FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT item, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
met AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i
        FROM worded CROSS JOIN (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, k, item FROM met JOIN windows USING (k, phrase)),
hit AS (
  SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
held AS (
  SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS listed
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM worded LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)
"""

#: The checksum is the usual bytewise one, its table made by its rule.
OP13 = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*)::BIGINT AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run),
polynomial AS (
  SELECT [list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
          for i in range(256)] AS tb),
named AS (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || run AS line FROM runs),
summed AS (
  SELECT run, times, xor(list_reduce([4294967295::BIGINT]
           || [('0x' || substr(hex(encode(line)), 2 * i + 1, 2))::BIGINT for i in range(strlen(line))],
           lambda c, b: xor(c >> 8, tb[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM named, polynomial),
spoilt AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
              ELSE run END AS word, times FROM summed),
words AS (
  SELECT word, sum(times)::BIGINT AS n FROM spoilt WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
short AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n
  FROM short a JOIN short b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM short a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM short a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, other, other_n, count(*) OVER (PARTITION BY word)::BIGINT AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS place FROM pairs),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN other_n >= 10 * w.n THEN other END AS form, CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word AND place = 1),
followed AS (
  SELECT word, word AS root, form AS ahead FROM formed
  UNION ALL SELECT f.word, f.ahead, n.form FROM followed f JOIN formed n ON n.word = f.ahead)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, r.root
FROM formed f JOIN followed r ON r.word = f.word AND r.ahead IS NULL
"""

ORACLES = {
    "op6_top_products": OP6,
    "op7_shingle_components": OP7,
    "op8_repeated_lines": OP8,
    "op10_source_mix": OP10,
    "op11_ranked_documents": OP11,
    "op12_benchmark_hits": OP12,
    "op13_spelling_variants": OP13,
}
