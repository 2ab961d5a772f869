"""DuckDB SQL for the operators that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = r"[^\x20\x09-\x0D]+"

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, l, array_to_string(list_slice(w, i, i + l - 1), ' ') AS g FROM (SELECT item_id, w, least(len(w), 10) AS l, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
ls AS (SELECT DISTINCT l FROM bw),
dw AS (SELECT doc_id, l, i, array_to_string(list_slice(w, i, i + l - 1), ' ') AS g FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, ls WHERE len(w) >= l)),
m AS (SELECT doc_id, i, dw.l, item_id FROM dw JOIN bw ON dw.l = bw.l AND dw.g = bw.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT doc_id, i, l FROM m)) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(x, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN s ON d.doc_id = s.doc_id
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_BLANK}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS doc_id, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON r.doc_id = e.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(c.root, d.doc_id) AS component_id, coalesce(c.root, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) c ON d.doc_id = c.doc_id
"""

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce('h' || source, '-') AS host, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_BLANK}') AS w FROM documents),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 2), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2))),
rep AS (SELECT doc_id, count(DISTINCT p) AS k FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, host, line, regexp_extract_all(lower(line), '{_BLANK}') AS lw FROM (SELECT doc_id, host, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_BLANK}')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS k FROM l GROUP BY doc_id),
hn AS (SELECT host, count(*) AS size FROM d GROUP BY host),
f AS (SELECT x.host, line FROM (SELECT host, array_to_string(lw, ' ') AS line, count(DISTINCT doc_id) AS n FROM l GROUP BY 1, 2) x JOIN hn ON x.host = hn.host WHERE n > 10 AND 100 * n > 5 * size),
gone AS (SELECT doc_id, sum(len(lw)) AS k FROM l JOIN f ON l.host = f.host AND array_to_string(l.lw, ' ') = f.line GROUP BY doc_id),
a AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(dup.k, 0) AS n_dup_lines, coalesce(rep.k, 0) AS n_repeat_words, 1 - coalesce(gone.k / nullif(len(w), 0), 0) AS left_share
  FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id LEFT JOIN dup ON d.doc_id = dup.doc_id LEFT JOIN gone ON d.doc_id = gone.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND left_share >= 0.3 AS kept, CAST(left_share AS DOUBLE) AS left_share FROM a
"""

_GROUPS = " || ".join(
    "".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(x, {5 * g + 1}, 5) AS BIGINT) >> {s}) & 31)::INT + 1, 1)" + (" || " if s else "") for s in (15, 10, 5, 0)) for g in range(8)
)

WARC = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages), k AS (SELECT h, max(page_id) AS r FROM p GROUP BY h),
a AS (SELECT page_id, url, strlen(p.h) AS n, sha1(p.h) AS x, r FROM p JOIN k ON p.h = k.h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_GROUPS} AS payload_digest, CASE WHEN page_id = r THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> r THEN r END AS refers_to, url FROM a
"""

_CRC_TABLE = "(SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i)))"
# one code point taken out at each place, the gap marked or not
_CUT = "substr(word, 1, i - 1) || {gap} || substr(word, i + 1)"

SPELLING = rf"""
WITH RECURSIVE crc AS {_CRC_TABLE},
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS w FROM documents),
o AS (SELECT d, w, count(*) AS n, hex(encode(d || ':' || w)) AS x FROM r WHERE length(w) >= 5 GROUP BY d, w),
h AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i: CAST(CAST('0x' || substr(x, 2 * i + 1, 2) AS INT) AS BIGINT))), lambda c, b: xor(c >> 8, t[xor(c % 256, b) + 1])), 4294967295) AS h FROM o, crc),
c AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM c WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
s AS (SELECT word, n, {_CUT.format(gap="'_'")} AS k FROM p),
x AS (SELECT DISTINCT word, n, {_CUT.format(gap="''")} AS k FROM p),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS m FROM s a JOIN s b ON a.k = b.k AND a.word <> b.word
  UNION ALL SELECT x.word, x.n, v.word, v.n FROM x JOIN v ON x.k = v.word UNION ALL SELECT v.word, v.n, x.word, x.n FROM x JOIN v ON x.k = v.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * v.n THEN other END AS form, CASE WHEN m >= 2 * v.n THEN m END AS form_n FROM v LEFT JOIN best ON v.word = best.word),
walk AS (SELECT word, word AS at FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON walk.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, walk.at AS root FROM f JOIN walk ON f.word = walk.word JOIN f e ON e.word = walk.at WHERE e.form IS NULL
"""

_KEPT = "SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings WHERE len(embedding) {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"

NEIGHBOURS = f"""
WITH e AS (SELECT * FROM ({_KEPT.format(size="> 0")}) WHERE vec_id IS NOT NULL AND list_max(list_transform(v, lambda x: abs(x))) > 0),
d AS (SELECT q.vec_id AS query_id, e.vec_id, sqrt(list_sum(list_transform(list_zip(q.v, e.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS score FROM e q JOIN e ON q.vec_id <> e.vec_id AND len(q.v) = len(e.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

_NEAREST = """a{r} AS (SELECT o, c FROM (SELECT o, c, row_number() OVER (PARTITION BY o ORDER BY d, c) AS r FROM (SELECT x.o, m.c, sum((x.x - m.x) * (x.x - m.x)) AS d FROM x JOIN m{r} m ON x.i = m.i GROUP BY x.o, m.c)) WHERE r = 1),
m{s} AS (SELECT m.c, m.i, coalesce(s.x, m.x) AS x FROM m{r} m LEFT JOIN (SELECT c, i, (s - ((s % n) + n) % n) // n AS x FROM (SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{r} JOIN x ON a{r}.o = x.o GROUP BY c, i)) s ON m.c = s.c AND m.i = s.i)"""

CLUSTERS = f"""
WITH e AS (SELECT vec_id, row_number() OVER () AS o, list_transform(v, lambda z: CAST(floor(256 * z) AS BIGINT)) AS v FROM ({_KEPT.format(size="= 64")})),
x AS (SELECT o, unnest(range(1, 65)) AS i, unnest(v) AS x FROM e),
m0 AS (SELECT c, unnest(range(1, 65)) AS i, unnest(v) AS x FROM (SELECT v, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM e) WHERE c < 40),
{", ".join(_NEAREST.format(r=r, s=r + 1) for r in range(5))},
l AS (SELECT o, c, d FROM (SELECT o, c, d, row_number() OVER (PARTITION BY o ORDER BY d, c) AS r FROM (SELECT x.o, m.c, sum((x.x - m.x) * (x.x - m.x)) AS d FROM x JOIN m5 m ON x.i = m.i GROUP BY x.o, m.c)) WHERE r = 1),
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS k FROM m5 GROUP BY c)
SELECT vec_id, CAST(l.c AS INT) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY l.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, k AS centroid_sha256
FROM l JOIN e ON e.o = l.o JOIN h ON h.c = l.c
"""
