"""SQL of the queries that SQL can say, as brute force."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _folded(table: str, key: str) -> str:
    return rf"(SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM {table})"


ORACLES = {
    "op3_decontaminate": f"""WITH d AS {_folded('documents', 'doc_id')},
it AS (SELECT CAST(item_id AS VARCHAR) AS id, ws, least(10, len(ws)) AS m FROM {_folded('benchmark', 'item_id')} b WHERE len(ws) > 0),
pw AS (SELECT DISTINCT id, m, array_to_string(ws[i:i + m - 1], ' ') AS t FROM it, range(1, len(ws) - m + 2) r(i)),
p AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
dw AS (""" + " UNION ALL ".join(f"SELECT doc_id, i, {m} AS m, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {m - 1} FOLLOWING) AS t, n FROM p WHERE EXISTS (SELECT 1 FROM pw WHERE m = {m})" for m in range(1, 11)) + f"""),
hit AS (SELECT doc_id, i, m, id FROM dw JOIN pw USING (m, t) WHERE i + m - 1 <= n),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM hit) z GROUP BY 1), g AS (SELECT doc_id, coalesce(list_sort(list(DISTINCT id) FILTER (id IS NOT NULL)), []) AS ids FROM hit GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN g USING (doc_id)""",
    "op5_topk": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s) SELECT * FROM r WHERE rank <= 5""",
    "op9_factors": r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w),
t AS (SELECT doc_id, j, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS t FROM p),
f AS (SELECT doc_id, j, row_number() OVER (PARTITION BY t ORDER BY doc_id, j) AS k FROM t WHERE j + 19 <= n),
x AS (SELECT p.doc_id, p.j, word, coalesce(max(CASE WHEN k > 1 THEN p.j END) OVER (PARTITION BY p.doc_id ORDER BY p.j ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) > 0 AS gone FROM p LEFT JOIN f ON f.doc_id = p.doc_id AND f.j = p.j),
e AS (SELECT doc_id, count_if(gone) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS kept FROM x GROUP BY 1)
SELECT w.doc_id, len(ws) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN e ON e.doc_id = w.doc_id""",
    "op12_prefixes": r"""WITH t AS (SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM t),
o AS (SELECT conv_id, list(d ORDER BY turn NULLS FIRST, d) AS ds, list(w ORDER BY turn NULLS FIRST, d) AS ws FROM t GROUP BY 1),
h AS (SELECT conv_id, xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(s, ''), lambda x: list_concat([ascii(x)], list_transform(range(8), lambda i: -1))))),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 4 AS h FROM crc),
f AS (SELECT o.conv_id, list_concat(coalesce(b.ds, [])[1:h], o.ds[h + 1:]) AS ds, list_concat(coalesce(b.ws, [])[1:h], o.ws[h + 1:]) AS ws FROM o JOIN h USING (conv_id) LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 20),
m AS (SELECT conv_id, ds[1:d] AS path, d, coalesce(ws[d], 0) AS w, d = len(ds) AS ends FROM f, range(0, len(ds) + 1) r(d)),
n AS (SELECT path, d, array_to_string(path, ',') AS k, array_to_string(path[1:d - 1], ',') AS up, min(conv_id) AS conv_id, count(*) AS n, any_value(w) AS w, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ids FROM m GROUP BY ALL),
c AS (SELECT d - 1 AS d, up AS k, count(*) AS kids FROM n WHERE d > 0 GROUP BY ALL),
s AS (SELECT e AS d, array_to_string(path[1:e], ',') AS k, count_if(kids IS NULL) AS leaves, sum((n - 1) * w) AS saved FROM (SELECT n.*, kids FROM n LEFT JOIN c USING (d, k)) z, range(0, d + 1) r(e) GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(kids, 0) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ids, '')) AS ends_sha256
FROM n LEFT JOIN c ON c.d = n.d AND c.k = n.k LEFT JOIN n p ON p.d = n.d - 1 AND p.k = n.up JOIN s ON s.d = n.d AND s.k = n.k""",
    # the given pages mark their articles plainly, so SQL can say what the trained field must find on them
    "op11_maintext": r"""WITH a AS (SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '') AS x FROM pages),
b AS (SELECT page_id, url, list_transform(string_split_regex(replace(x, '<br>', ' '), '</?(?:p|h1)>'), lambda t:
  trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(t, '</?b>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'))) AS ts FROM a)
SELECT page_id, url, array_to_string(list_filter(ts, lambda t: t <> ''), chr(10)) AS text, length(array_to_string(list_filter(ts, lambda t: t <> ''), chr(10))) AS n_chars FROM b""",
    "op13_lexical": f"""WITH d AS (SELECT row_number() OVER () AS rid, * FROM {_folded('documents', 'doc_id')} z), i AS (SELECT row_number() OVER () AS iid, * FROM {_folded('benchmark', 'item_id')} z),
s AS (SELECT count_if(len(ws) > 0) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS total FROM d),
q AS (SELECT iid, item_id, term, count(*) AS c FROM (SELECT iid, item_id, unnest(ws) AS term FROM i) z GROUP BY ALL),
tf AS (SELECT rid, doc_id, term, n, count(*) AS tf FROM (SELECT rid, doc_id, len(ws) AS n, unnest(ws) AS term FROM d) z WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, n_docs),
r AS (SELECT iid, item_id, rid, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // total)))) AS BIGINT) AS score FROM tf JOIN q USING (term) JOIN w USING (term), s GROUP BY ALL),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10""",
}
