"""DuckDB SQL for the operators' queries that SQL can express."""

#: crc32 of the decimal digits of {c}: eight shifts for each character
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({c}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

CONVERSATION_TRIE = f"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % 100 AS b, {_CRC32.format(c="c")} % 6 AS h, count(*) AS n FROM own GROUP BY c),
heads AS (SELECT v.c, o.pos AS d, o.role, o.text FROM convs v JOIN own o ON o.c = v.b WHERE o.pos <= v.h),
shared AS (SELECT v.c, v.h, least(v.h, coalesce(base.n, 0)) AS k FROM convs v LEFT JOIN convs base ON base.c = v.b),
rebuilt AS (SELECT * FROM heads UNION ALL SELECT o.c, o.pos - s.h + s.k, o.role, o.text FROM own o JOIN shared s USING (c) WHERE o.pos > s.h),
paths AS (
  SELECT c, d, length(text) AS chars, list(md5(length(role) || ':' || role || text)) OVER (PARTITION BY c ORDER BY d) AS path FROM rebuilt
  UNION ALL SELECT c, 0, 0, []::VARCHAR[] FROM convs),
nodes AS (SELECT path, d, min(c) AS conv, count(*) AS n, any_value(chars) AS chars FROM paths GROUP BY path, d),
kids AS (SELECT list_slice(path, 1, d - 1) AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
own_sums AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (path)),
up AS (SELECT list_slice(path, 1, a) AS path, n, chars, n_children FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own_sums)),
sums AS (SELECT path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n - 1) * chars) AS saved FROM up GROUP BY path),
last AS (SELECT c, max(d) AS d FROM paths GROUP BY c),
ends AS (SELECT p.path, sha256(string_agg(p.c::VARCHAR, ',' ORDER BY p.c)) AS sha FROM paths p JOIN last USING (c, d) GROUP BY p.path)
SELECT o.conv AS conv_id, o.d::BIGINT AS depth, up_.conv AS parent_conv_id, o.n AS n_convs, o.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
  s.saved::BIGINT AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM own_sums o JOIN sums s USING (path) LEFT JOIN ends e USING (path)
LEFT JOIN nodes up_ ON o.d > 0 AND up_.path = list_slice(o.path, 1, o.d - 1)
"""

_LOWER = "translate(coalesce({x}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

PHRASES = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format(x="text")}, '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
lists AS (SELECT lang, list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS g
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM lists, (VALUES (1), (2), (3), (4)) AS o(m))),
f AS MATERIALIZED (SELECT lang, m, g, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a) AS n FROM f WHERE m = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT lang, m, g, a FROM f WHERE a >= 30),
cand AS (SELECT lang, m, g, a, string_split(g, ' ') AS w FROM often WHERE m > 1),
cuts AS MATERIALIZED (
  SELECT lang, g, a, k, array_to_string(list_slice(w, 1, k), ' ') AS head, array_to_string(list_slice(w, k + 1, m), ' ') AS tail
  FROM (SELECT lang, m, g, a, w, unnest(range(1, m)) AS k FROM cand)),
scored AS MATERIALIZED (
  SELECT c.lang, c.g, c.a, c.k, p.a AS l, r.a AS r, (2000000::HUGEINT * c.a // (p.a + r.a))::BIGINT AS score
  FROM cuts c JOIN often p ON p.lang = c.lang AND p.g = c.head JOIN often r ON r.lang = c.lang AND r.g = c.tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
spans AS (SELECT lang, w, a, m, j, unnest(range(1, m - j + 2)) AS i FROM (SELECT lang, w, a, m, unnest(range(2, m)) AS j FROM cand)),
inside AS MATERIALIZED (SELECT lang, array_to_string(list_slice(w, i, i + j - 1), ' ') AS g, max(a) AS longer FROM spans GROUP BY ALL),
named AS (
  SELECT b.lang, b.g AS phrase, b.a, l, r, score FROM best b LEFT JOIN inside s ON s.lang = b.lang AND s.g = b.g
  WHERE s.longer IS NULL OR 100 * s.longer < 80 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

_WORDS = """rows_ AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
lists AS (SELECT row, doc_id, list_filter(string_split_regex({lower}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM rows_),
words AS (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n FROM lists)"""

#: every document's set of n-grams, the links of distinct sets, and the smallest number reached along links
_GROUPS = """
WITH RECURSIVE {words},
runs AS (SELECT row, i, n, word || {leads} AS g, {whole} AS short FROM words WINDOW w AS (PARTITION BY row ORDER BY i)),
grams AS MATERIALIZED (SELECT DISTINCT row, coalesce(g, short) AS g FROM runs WHERE g IS NOT NULL OR (i = 1 AND n < {width})),
sets AS MATERIALIZED (SELECT row, count(*) AS n, md5(string_agg(g, '|' ORDER BY g)) AS s FROM grams GROUP BY row),
classes AS MATERIALIZED (SELECT s, any_value(sets.n) AS n, min(row) AS node, min(doc_id) AS id FROM sets JOIN rows_ USING (row) GROUP BY s),
own AS (SELECT node, n, g FROM classes JOIN grams ON grams.row = classes.node),
shared AS (SELECT a.node AS x, b.node AS y, a.n AS nx, b.n AS ny, count(*) AS c FROM own a JOIN own b ON a.g = b.g AND a.node <> b.node
  AND 100 * least(a.n, b.n) >= {least} * greatest(a.n, b.n) GROUP BY ALL),
links AS MATERIALIZED (SELECT x, y FROM shared WHERE 100 * c >= {least} * (nx + ny - c)),
reach AS (SELECT x AS node, y AS other FROM links UNION SELECT r.node, l.y FROM reach r JOIN links l ON l.x = r.other),
found AS MATERIALIZED (SELECT c.s, least(min(c.id), min(o.id)) AS component FROM classes c LEFT JOIN reach r USING (node) LEFT JOIN classes o ON o.node = r.other GROUP BY c.s)
SELECT doc_id, coalesce(sets.n, 0)::BIGINT AS n_shingles, CASE WHEN sets.n IS NULL THEN doc_id ELSE component END AS component_id{kept}
FROM rows_ LEFT JOIN sets USING (row) LEFT JOIN found USING (s)
"""


def _groups(width: int, least: int, kept: str = "") -> str:
    leads = " || ".join(f"' ' || lead(word, {k}) OVER w" for k in range(1, width))
    whole = "concat_ws(' ', word, " + ", ".join(f"lead(word, {k}) OVER w" for k in range(1, width)) + ")"
    return _GROUPS.format(words=_WORDS.format(lower=_LOWER.format(x="text")), leads=leads, whole=whole, width=width, least=least, kept=kept)


PREFIX_TREE_JOIN = _groups(4, 85)

BAYESIAN_MINHASH = _groups(5, 85, ",\n  doc_id = CASE WHEN sets.n IS NULL THEN doc_id ELSE component END AS kept")

VAFILE_TOPK = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(range(1, len(v.v) + 1), lambda i: q.v[i] * v.v[i]))::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.v) = len(v.v) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_SPLIT = "list_filter(string_split_regex({lower}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
_RUNS = ", ".join(["word", *["word || " + " || ".join(f"' ' || lead(word, {k}) OVER w" for k in range(1, n)) for n in range(2, 11)]])

DECONTAMINATION = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {_SPLIT.format(lower=_LOWER.format(x="text"))} AS w FROM documents),
words AS (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs),
runs AS (SELECT row, i, [{_RUNS}] AS g FROM words WINDOW w AS (PARTITION BY row ORDER BY i)),
found AS MATERIALIZED (SELECT row, i, unnest(g) AS g, generate_subscripts(g, 1) AS n FROM runs),
items AS (SELECT item_id::VARCHAR AS item, {_SPLIT.format(lower=_LOWER.format(x="text"))} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS MATERIALIZED (
  SELECT DISTINCT item, n, g FROM (
    SELECT item, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS g
    FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0))),
hits AS MATERIALIZED (SELECT f.row, f.i, f.n, w.item FROM found f JOIN windows w ON w.g = f.g AND w.n = f.n),
touched AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS place FROM hits) GROUP BY row),
named AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item FROM hits) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN touched USING (row) LEFT JOIN named USING (row)
"""

ORACLES = {
    "op3_vafile_topk": VAFILE_TOPK,
    "op8_suffix_decontamination": DECONTAMINATION,
    "op10_bayesian_minhash": BAYESIAN_MINHASH,
    "op11_prefix_tree_join": PREFIX_TREE_JOIN,
    "op12_phrase_streams": PHRASES,
    "op13_conversation_trie": CONVERSATION_TRIE,
}
