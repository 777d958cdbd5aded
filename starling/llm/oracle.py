"""DuckDB SQL for the queries that SQL can express."""

# Lower case of A-Z only; words are runs without the six white-space bytes.
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""


def _crc32(codes: str) -> str:
    """The unsigned crc32 of a list of byte values, bit by bit."""
    return f"""xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda x, y: list_reduce(
      list_prepend(xor(x, y), range(8)::UBIGINT[]),
      lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::UBIGINT) ELSE a // 2 END)), 4294967295::UBIGINT)"""


# Characters up to U+00FF as one or two bytes of UTF-8.
def _utf8(text: str) -> str:
    return f"""flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128
      THEN [unicode(c)::UBIGINT] ELSE [(192 + unicode(c) // 64)::UBIGINT, (128 + unicode(c) % 64)::UBIGINT] END))"""


SQL: dict[str, str] = {
    "op1_minhash_near_dedup": rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n, CAST(list_sort(s) AS VARCHAR) AS whole FROM s),
rep AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY whole) AS rep FROM n WHERE n > 0),
g AS (SELECT s.doc_id, unnest(s) AS g FROM s JOIN rep ON s.doc_id = rep.doc_id AND rep.doc_id = rep.rep),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id
           GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(node, low) AS (SELECT DISTINCT a, a FROM edge UNION SELECT edge.b, reach.low FROM reach JOIN edge ON edge.a = reach.node),
comp AS (SELECT node, min(low) AS low FROM reach GROUP BY node)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, coalesce(comp.low, rep.rep, n.doc_id) AS component_id,
       n.doc_id = coalesce(comp.low, rep.rep, n.doc_id) AS kept
FROM n LEFT JOIN rep ON rep.doc_id = n.doc_id LEFT JOIN comp ON comp.node = rep.rep""",
    # Two hex digits a byte, so that SQL's substr works on bytes.
    "op6_suffix_array_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT doc_id, h, len(h) // 2 AS n FROM d),
p AS (SELECT doc_id, unnest(range(0, n - 99)) AS p, h FROM n WHERE n >= 100),
f AS (SELECT doc_id, p, row_number() OVER (PARTITION BY substr(h, 2 * p + 1, 200) ORDER BY doc_id, p) AS k FROM p),
s AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM f WHERE k > 1),
r AS (SELECT doc_id, p, sum(CASE WHEN q IS NULL OR p > q + 100 THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id ORDER BY p) AS run FROM s),
span AS (SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b FROM r GROUP BY doc_id, run),
gap AS (SELECT doc_id, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b, sum(b - a) AS removed FROM span GROUP BY doc_id)
SELECT n.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(len(a), 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN a IS NULL THEN h ELSE substr(h, 1, 2 * a[1]) || array_to_string(list_transform(
         range(1, len(a) + 1), lambda i: substr(h, 2 * b[i] + 1, 2 * ((CASE WHEN i = len(a) THEN n ELSE a[i + 1] END) - b[i]))),
         '') END)) AS kept_sha256
FROM n LEFT JOIN gap ON gap.doc_id = n.doc_id""",
    "op7_threshold_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
        list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 5""",
    "op11_spelling_variants": f"""
WITH RECURSIVE r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS r FROM documents),
g AS (SELECT doc_id, r, count(*) AS k FROM r WHERE length(r) >= 5 GROUP BY ALL),
h AS (SELECT r, k, coalesce({_crc32(_utf8("concat(doc_id, ':', r)"))}, 1) AS h FROM g WHERE doc_id IS NOT NULL
      UNION ALL SELECT r, k, 1 FROM g WHERE doc_id IS NULL),
v AS (SELECT CASE WHEN h % 97 = 0 THEN concat(substr(r, 1, CAST(h % length(r) AS BIGINT)),
        substr(r, CAST(h % length(r) AS BIGINT) + 2)) ELSE r END AS word, k FROM h),
w AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM v WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
d AS (SELECT word, i, concat(substr(word, 1, i), substr(word, i + 2)) AS rest
      FROM (SELECT word, unnest(range(length(word))) AS i FROM w)),
shorter AS (SELECT DISTINCT d.word AS a, w.word AS b FROM d JOIN w ON d.rest = w.word),
near AS (SELECT x.word AS a, y.word AS b FROM d x JOIN d y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
         UNION ALL SELECT a, b FROM shorter UNION ALL SELECT b, a FROM shorter),
best AS (SELECT a, count(*) AS n_near, min(ROW(-w.n, b)) AS best FROM near JOIN w ON w.word = b GROUP BY a),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 2 * n THEN best[2] END AS form,
        CASE WHEN -best[1] >= 2 * n THEN -best[1] END AS form_n FROM w LEFT JOIN best ON a = word),
walk(word, place, form) AS (SELECT word, word, form FROM f
      UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON f.word = walk.form)
SELECT f.word, n, n_near, f.form, CAST(form_n AS BIGINT) AS form_n, place AS root FROM f JOIN walk ON walk.word = f.word
WHERE walk.form IS NULL""",
    "op13_prefix_trie": f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, turn, role, sha256(concat(strlen(role), ':', role, text)) AS k, strlen(text) AS nb FROM t),
o AS (SELECT conv_id, k, nb, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, k) - 1 AS pos FROM k),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, CAST({_crc32(_utf8("CAST(conv_id AS VARCHAR)"))} % 9 AS BIGINT) AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
m AS (SELECT c.conv_id, h, base, least(h, coalesce(n, 0)) AS n FROM c
      LEFT JOIN (SELECT conv_id, count(*) AS n FROM o GROUP BY conv_id) s ON s.conv_id = base),
r AS (SELECT m.conv_id, pos, k, nb FROM m JOIN o ON o.conv_id = base AND pos < h
      UNION ALL SELECT m.conv_id, pos - h + n, k, nb FROM m JOIN o ON o.conv_id = m.conv_id AND pos >= h),
p AS (SELECT conv_id, pos + 1 AS depth, nb, sha256(string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY pos)) AS path FROM r
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
l AS (SELECT conv_id, max(depth) AS len FROM p GROUP BY conv_id),
node AS (SELECT path, depth, min(conv_id) AS low, count(*) AS n, any_value(nb) AS nb,
           coalesce(string_agg(CASE WHEN len = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends
         FROM p JOIN l USING (conv_id) GROUP BY path, depth),
up AS (SELECT DISTINCT path, depth, up FROM (
         SELECT path, depth, lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS up FROM p)),
child AS (SELECT up AS path, count(*) AS n FROM up WHERE depth > 0 GROUP BY up),
sub AS (SELECT a.path, sum(CASE WHEN child.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((node.n - 1) * node.nb) AS saved
        FROM node LEFT JOIN child USING (path) JOIN p a ON a.conv_id = node.low AND a.depth <= node.depth GROUP BY a.path)
SELECT node.low AS conv_id, CAST(node.depth AS BIGINT) AS depth, above.low AS parent_conv_id, node.n AS n_convs,
       coalesce(child.n, 0) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(node.ends) AS ends_sha256
FROM node JOIN up USING (path, depth) JOIN sub USING (path) LEFT JOIN child USING (path)
LEFT JOIN node above ON above.path = up.up AND node.depth > 0""",
}
