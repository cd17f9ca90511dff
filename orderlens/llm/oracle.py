"""DuckDB SQL for the dealt operators that SQL can express on whole tables.

Near duplicates are: sets of shingles, pairs that share one, the threshold, and
the smallest id within reach. The others are trained models, coders and floating
point schedules, which the tests hold against brute force instead.
"""

from __future__ import annotations

NEAR_DUPLICATES = r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
             ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, hash(g) AS g FROM (SELECT doc_id, unnest(sh) AS g FROM s)),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS m FROM n UNION SELECT u.b, r.m FROM r JOIN u ON u.a = r.d WHERE r.m < u.b)
SELECT n.doc_id, n.n AS n_shingles, min(r.m) AS component_id, n.doc_id = min(r.m) AS kept
FROM n JOIN r ON r.d = n.doc_id GROUP BY n.doc_id, n.n"""


FILL_IN_MIDDLE = r"""
WITH
d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS us,
             CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
             CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(us) AS n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS a, greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS b FROM u),
p AS (SELECT doc_id, t, n, array_to_string(us[1:a], '') AS pre, array_to_string(us[a + 1:b], '') AS mid, array_to_string(us[b + 1:], '') AS suf,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                  WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                          ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS out FROM p),
x AS (SELECT *, strpos(out, '<P>') AS ip, strpos(out, '<S>') AS is_, strpos(out, '<M>') AS im FROM o)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(out) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN out
                        WHEN 'psm' THEN substr(out, 4, is_ - 4) || substr(out, im + 3) || substr(out, is_ + 3, im - is_ - 3)
                        ELSE substr(out, ip + 3, im - ip - 3) || substr(out, im + 3) || substr(out, 4, ip - 4) END) AS restored_sha256
FROM x"""


WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha256(coalesce(html, '')) AS d FROM pages),
r AS (SELECT *, CASE WHEN n >= 100 THEN row_number() OVER (PARTITION BY d ORDER BY page_id NULLS LAST) ELSE 1 END AS k,
             first_value(page_id) OVER (PARTITION BY d ORDER BY page_id NULLS LAST) AS f FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN f END AS refers_to
FROM r"""


# CRC-32 of a decimal number's digits, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))))"""

PREFIX_TRIE = f"""
WITH o AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM o)),
b AS (SELECT c.conv_id, 0 AS own, o.pos, o.r, o.x FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 100 AND o.pos < c.h
      UNION ALL SELECT o.conv_id, 1, o.pos, o.r, o.x FROM o JOIN c USING (conv_id) WHERE o.pos >= c.h),
s AS (SELECT conv_id, row_number() OVER w AS d, length(x) AS chars, string_agg(md5(length(r) || ':' || r || x), '') OVER w AS pre,
             count(*) OVER (PARTITION BY conv_id) AS total FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)),
p AS (SELECT conv_id, d, chars, pre, total, CASE WHEN d = 1 THEN '' ELSE pre[1:length(pre) - 32] END AS up FROM s
      UNION ALL SELECT c.conv_id, 0, 0, '', (SELECT count(*) FROM b WHERE b.conv_id = c.conv_id), NULL FROM c),
n AS (SELECT pre, min(conv_id) AS conv_id, any_value(d) AS depth, any_value(up) AS up, any_value(chars) AS chars, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = total), '')) AS ends FROM p GROUP BY pre),
k AS (SELECT n.pre, count(m.pre) AS children FROM n LEFT JOIN n m ON m.up = n.pre GROUP BY n.pre),
t AS (SELECT p.pre, sum((n.n_convs - 1) * n.chars) AS saved, count(*) FILTER (WHERE k.children = 0) AS leaves
      FROM n JOIN k USING (pre) JOIN p ON p.conv_id = n.conv_id AND p.d <= n.depth GROUP BY p.pre)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, k.children AS n_children, t.leaves AS n_leaves,
       CAST(t.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN k USING (pre) JOIN t USING (pre) LEFT JOIN n u ON u.pre = n.up"""


def oracle_queries() -> dict[str, str]:
    return {"op4_minhash": NEAR_DUPLICATES, "op11_prefix_trie": PREFIX_TRIE, "op12_fill_in_middle": FILL_IN_MIDDLE, "op13_warc": WARC}
