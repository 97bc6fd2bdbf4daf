"""DuckDB SQL of the queries that SQL can express in full."""

from __future__ import annotations

TOP_K = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

_DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, {1 + 5 * k}, 5) AS BIGINT) >> {shift}) & 31) + 1, 1)"
    for k in range(8) for shift in (15, 10, 5, 0))

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(x)) AS payload_bytes, {_DIGITS} AS payload_digest,
             max(page_id) OVER (PARTITION BY x) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to FROM d
"""

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                          ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM w),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared, any_value(a.n) AS na, any_value(b.n) AS nb
      FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY 1, 2),
l AS (SELECT a, b FROM o WHERE 100 * shared >= 90 * (na + nb - shared)),
r AS (SELECT doc_id AS x, doc_id AS y FROM s UNION SELECT r.x, l.b FROM r JOIN l ON l.a = r.y)
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id FROM s JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) c ON c.x = s.doc_id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# low two bits of crc32 need the whole sum: per byte one step that adds it (x >= 0) and eight that shift (x = -1)
_CRC = """((4294967295 - list_reduce(list_concat([4294967295], flatten([[CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]
          FOR c IN string_split(CAST(conv_id AS VARCHAR), '')])),
          lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 4)"""

TRIE = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS no,
                  {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(x ORDER BY no) AS w FROM t GROUP BY conv_id),
h AS (SELECT conv_id, w, {_CRC} AS h, conv_id - conv_id % 20 AS b FROM o),
r AS (SELECT h.conv_id, list_concat(coalesce(o.w[1:h.h], []), h.w[h.h + 1:]) AS w FROM h LEFT JOIN o ON o.conv_id = h.b),
m AS (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS depth FROM r),
p AS (SELECT conv_id, depth, w[1:depth] AS k, len(w) = depth AS ends FROM m),
n AS (SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY k, depth),
c AS (SELECT k[1:depth - 1] AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
             CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(n.k[depth].text, '[^\x20\x09-\x0D]+')) END AS saved
      FROM n LEFT JOIN c ON c.k = n.k),
u AS (SELECT k[1:d] AS k, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM v) GROUP BY 1)
SELECT v.conv_id, v.depth, q.conv_id AS parent_conv_id, v.n_convs, v.n_children, u.leaves AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN u ON u.k = v.k LEFT JOIN n q ON v.depth > 0 AND q.k = v.k[1:v.depth - 1]
"""

_LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

CONTAMINATED = f"""
WITH d AS (SELECT row_number() OVER () AS line, doc_id, regexp_extract_all({_LOWER}, {_LETTERS}) AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_LOWER}, {_LETTERS}) AS w FROM benchmark),
bw AS (SELECT item, least(len(w), 10) AS m, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS t
       FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, m, t FROM bw),
lens AS (SELECT DISTINCT m FROM win),
dw AS (SELECT line, m, unnest([{{'i': i, 't': array_to_string(w[i:i + m - 1], ' ')}} FOR i IN range(1, len(w) - m + 2)]) AS x FROM d, lens WHERE len(w) >= m),
hit AS (SELECT line, dw.m, x.i AS i, item FROM dw JOIN win ON win.m = dw.m AND win.t = dw.x.t),
pos AS (SELECT line, count(DISTINCT p) AS n_hit FROM (SELECT line, unnest(range(i, i + m)) AS p FROM hit) GROUP BY line),
its AS (SELECT line, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS s FROM (SELECT DISTINCT line, item FROM hit) GROUP BY line)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (line) LEFT JOIN its USING (line)
"""

COLLOCATIONS = f"""
WITH x AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM x),
g AS (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, a FROM f WHERE a >= 100 AND k > 1),
longer AS (SELECT lang, a, array_to_string(w[i:j], ' ') AS phrase, j - i + 1 AS k, k AS of FROM
           (SELECT *, unnest(range(i, k + 1)) AS j FROM (SELECT *, unnest(range(1, k + 1)) AS i FROM c))),
most AS (SELECT lang, phrase, max(a) AS most FROM longer WHERE k < of GROUP BY ALL),
cut AS (SELECT c.lang, c.phrase, c.a, s, l.a AS l, r.a AS r, n.n, (1000::HUGEINT * c.a * n.n) // (l.a::HUGEINT * r.a) AS score
        FROM (SELECT *, unnest(range(1, k)) AS s FROM c) c JOIN n ON n.lang = c.lang
        JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:s], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[s + 1:], ' ')),
best AS (SELECT lang, phrase, a, unnest(min({{'score': score, 's': s, 'l': l, 'r': r, 'n': n}})) FROM cut GROUP BY lang, phrase, a),
k AS (SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM best LEFT JOIN most USING (lang, phrase) WHERE most IS NULL OR most < a)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM k WHERE rank <= 2000
"""

ORACLES = {"op5_ngram_jaccard": JACCARD, "op6_topk_search": TOP_K, "op9_warc": WARC, "op11_prefix_trie": TRIE,
           "op12_decontaminate": CONTAMINATED, "op13_collocations": COLLOCATIONS}
