"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: every string of 100 bytes with its place; those that are not the first of
#: their kind cover bytes, runs of which are removed
SUFFIXES = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, h, length(h) // 2 AS n FROM d),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS k FROM (SELECT doc_id, h, unnest(range(n - 99)) AS i FROM s WHERE n >= 100)),
r AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
b AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true)::INT AS fresh FROM r),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM b),
c AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS z FROM g GROUP BY doc_id, run),
-- what is kept lies between the end of one run and the beginning of the next
e AS (SELECT doc_id, 0 AS a, 0 AS z FROM s UNION ALL SELECT doc_id, a, z FROM c UNION ALL SELECT doc_id, n, n FROM s),
k AS (SELECT doc_id, z AS low, lead(a) OVER (PARTITION BY doc_id ORDER BY a, z) AS high FROM e),
t AS (SELECT k.doc_id, string_agg(substr(h, 2 * low + 1, 2 * (high - low)), '' ORDER BY low) AS kept FROM k JOIN s USING (doc_id) WHERE high > low GROUP BY 1),
m AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans FROM c GROUP BY 1)
SELECT doc_id, n AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM s LEFT JOIN m USING (doc_id) LEFT JOIN t USING (doc_id)"""

#: every window of 35 words with its place; those that occur twice cover words
SUBSTRINGS = f"""WITH d AS (SELECT doc_id, {WORDS} AS ws FROM documents),
w AS (SELECT doc_id, i, array_to_string(ws[i : i + 34], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35)),
r AS (SELECT doc_id, i FROM w QUALIFY count(*) OVER (PARTITION BY k) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM r, range(35) x(j)),
p AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
t AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.p) AS kept, count(*) AS n FROM p ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)"""

#: shingle sets, pairs by the shingles they share, and the smallest id that
#: links reach
_LINKED = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents WHERE text IS NOT NULL),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= SHARE * (p.n + q.n - o)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT r.x AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.x GROUP BY 1"""

JACCARD = _LINKED.replace("SHARE", "75")
COPIES = f"SELECT *, doc_id = component_id AS kept FROM ({_LINKED.replace('SHARE', '85')})"

TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

#: term counts of every document, weights of terms, and sums over the items' terms
RANKED = f"""WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, {TERMS}) AS ts FROM documents WHERE text IS NOT NULL),
c AS (SELECT count(*) FILTER (len(ts) > 0) AS n, sum(len(ts))::BIGINT AS l FROM d),
t AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * c.n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM t, c GROUP BY term, c.n),
q AS (SELECT item_id, term, count(*) AS r FROM (SELECT item_id, unnest(regexp_extract_all({LOWER}, {TERMS})) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, doc_id, sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * t.n * c.n) // c.l))))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN w USING (term), c GROUP BY 1, 2)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20"""

#: crc32 of a decimal number, byte by byte and bit by bit
CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""

#: rebuilt conversations, all their prefixes, and sums over the prefixes of nodes
TRIE = f"""WITH t AS (SELECT conv_id, turn, coalesce(text, '') AS text, coalesce(role, '') AS role FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT conv_id, turn, strlen(text) AS b, md5(strlen(role) || ':' || role || text) AS k FROM t),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, b, k) AS i FROM i),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {CRC32} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, o.i, o.k, o.b FROM c JOIN o ON o.conv_id = c.base AND o.i <= c.h
  UNION ALL SELECT c.conv_id, 1, o.i, o.k, o.b FROM c JOIN o ON o.conv_id = c.conv_id AND o.i > c.h),
l AS (SELECT conv_id, list(k ORDER BY part, i) AS ks, list(b ORDER BY part, i) AS bs FROM r GROUP BY 1),
s AS (SELECT conv_id, coalesce(ks, []) AS ks, bs FROM c LEFT JOIN l USING (conv_id)),
m AS (SELECT conv_id, ks, bs, unnest(range(len(ks) + 1)) AS d FROM s),
n AS (SELECT array_to_string(ks[1:d], '') AS k, any_value(array_to_string(ks[1:d - 1], '')) AS pk, d, any_value(coalesce(bs[d], 0)) AS b, min(conv_id) AS conv_id, count(*) AS n,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(ks) = d), '')) AS ends FROM m GROUP BY 1, 3),
f AS (SELECT pk, count(*) AS c FROM n WHERE d > 0 GROUP BY 1),
x AS (SELECT n.*, coalesce(f.c, 0) AS c FROM n LEFT JOIN f ON f.pk = n.k),
u AS (SELECT left(k, 32 * e) AS k, sum((n - 1) * b)::BIGINT AS saved, count(*) FILTER (c = 0) AS leaves FROM (SELECT *, unnest(range(d + 1)) AS e FROM x) GROUP BY 1)
SELECT x.conv_id, x.d AS depth, CASE WHEN x.d > 0 THEN p.conv_id END AS parent_conv_id, x.n AS n_convs, x.c AS n_children, u.leaves AS n_leaves, u.saved AS saved_tokens, x.ends AS ends_sha256
FROM x JOIN u USING (k) LEFT JOIN n p ON p.k = x.pk AND p.d = x.d - 1"""

ORACLES = {"op5_suffix_dedup": SUFFIXES, "op7_substring_dedup": SUBSTRINGS, "op8_jaccard_join": JACCARD, "op11_near_copies": COPIES, "op12_prefix_trie": TRIE, "op13_lexical_search": RANKED}
