"""DuckDB text of the queries that SQL can express over whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

VECTORS = """
WITH RECURSIVE typed AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
valid AS (
    SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM typed
    WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.93),
reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(any_value(c.n), 0) AS BIGINT) AS n_links, min(r.b) AS component_id, e.vec_id = min(r.b) AS kept
FROM embeddings e JOIN reach r ON r.a = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id GROUP BY e.vec_id"""

JACCARD = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
placed AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM worded WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(w) < 3 THEN w ELSE w[i:i + 2] END, ' ') AS g FROM placed),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM shingles a JOIN shingles b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
named AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN named c ON c.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""

# conv_id's CRC-32: eight shifts for each of its decimal digits
_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))"""

TRIE = f"""
WITH turns AS (
    SELECT conv_id AS c, md5(coalesce(role, '') || chr(1) || coalesce(text, '')) AS t, length(coalesce(text, '')) AS size,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS r
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id AS c, conv_id - conv_id % 100 AS donor, xor({_CRC}, 4294967295) % 6 AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
places AS (
    SELECT v.c, 0 AS own, t.r, t.t, t.size FROM convs v JOIN turns t ON t.c = v.donor AND t.r <= v.h
    UNION ALL SELECT v.c, 1, t.r, t.t, t.size FROM convs v JOIN turns t ON t.c = v.c AND t.r > v.h),
paths AS (SELECT c, list(t ORDER BY own, r) AS ts, list(size ORDER BY own, r) AS sizes FROM places GROUP BY c),
whole AS (SELECT v.c, coalesce(p.ts, []) AS ts, coalesce(p.sizes, []) AS sizes FROM convs v LEFT JOIN paths p USING (c)),
steps AS (SELECT c, ts, sizes, len(ts) AS n, unnest(range(0, len(ts) + 1)) AS depth FROM whole),
keyed AS (
    SELECT c, n, depth, array_to_string(ts[1:depth], '/') AS key, CASE WHEN depth > 0 THEN array_to_string(ts[1:depth - 1], '/') END AS up,
           CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS size, ts FROM steps),
nodes AS (
    SELECT key, any_value(depth) AS depth, any_value(up) AS up, min(c) AS conv, count(*) AS members, any_value(size) AS size, any_value(ts) AS ts,
           string_agg(CASE WHEN depth = n THEN CAST(c AS VARCHAR) END, ',' ORDER BY c) AS ends FROM keyed GROUP BY key),
kids AS (SELECT up AS key, count(*) AS children FROM nodes WHERE depth > 0 GROUP BY up),
valued AS (SELECT n.*, coalesce(k.children, 0) AS children, (members - 1) * size AS saving FROM nodes n LEFT JOIN kids k USING (key)),
spread AS (SELECT depth, ts, children, saving, unnest(range(0, depth + 1)) AS up_to FROM valued),
sums AS (SELECT array_to_string(ts[1:up_to], '/') AS key, sum(CASE WHEN children = 0 THEN 1 ELSE 0 END) AS leaves, sum(saving) AS saved FROM spread GROUP BY 1)
SELECT v.conv AS conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv AS parent_conv_id, v.members AS n_convs, CAST(v.children AS BIGINT) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM valued v JOIN sums s USING (key) LEFT JOIN nodes p ON p.key = v.up"""

# The contract's term pattern.
RANKED = f"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t, row_number() OVER () AS d FROM documents),
sized AS (SELECT d, doc_id, t, CAST(len(t) AS BIGINT) AS n FROM docs WHERE len(t) > 0),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized),
items AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
wanted AS (SELECT DISTINCT term FROM items),
placed AS (SELECT d, unnest(t) AS term FROM sized),
counted AS (SELECT d, term, count(*) AS tf FROM placed JOIN wanted USING (term) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * CAST(any_value(w.docs) AS DOUBLE) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
    FROM counted, whole w GROUP BY term),
normed AS (SELECT s.d, s.doc_id, 10 + (90 * s.n * w.docs) // w.terms AS m FROM sized s, whole w),
parts AS (
    SELECT d, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS part, doc_id FROM counted JOIN weights USING (term) JOIN normed USING (d)),
scores AS (SELECT item_id, doc_id, d, CAST(sum(part) AS BIGINT) AS score FROM items JOIN parts USING (term) GROUP BY ALL HAVING sum(part) > 0),
ranks AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, d) AS rank FROM scores)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranks WHERE rank <= 10"""
