"""The registered queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"list_filter(string_split_regex({text}, '[ \t\n\x0B\f\r]+'), lambda w: w <> '')"

OP1 = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
win AS (SELECT doc_id, k, md5(array_to_string(w[k + 1 : k + 35], ' ')) AS h
        FROM (SELECT doc_id, w, unnest(range(len(w) - 34)) AS k FROM d WHERE len(w) >= 35)),
dup AS (SELECT doc_id, k FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS pos FROM dup),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
         FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

OP6 = """
WITH p AS (SELECT page_id, url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
                  sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first_id FROM p)
SELECT page_id, url, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(x, (1 + 5 * (i // 4))::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
       CASE WHEN page_id = first_id THEN payload_bytes ELSE 0 END::INTEGER AS block_bytes
FROM f
"""

OP7 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP10 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[k + 1 : k + 5], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS k FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
           FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
         WHERE 100 * common.n >= 80 * (a.n + b.n - common.n)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
least AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM least LEFT JOIN size USING (doc_id)
"""

OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS w,
             list_transform(range(4), lambda k: ('0x' || substr(h, 1 + 8 * k, 8))::BIGINT) AS h FROM d),
c AS (SELECT doc_id, text, w, len(w)::BIGINT AS n, least(h[1] % (len(w) + 1), h[2] % (len(w) + 1)) AS a,
             greatest(h[1] % (len(w) + 1), h[2] % (len(w) + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                    OR h[3] % 100 >= 90 THEN 'plain'
                  WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM w),
p AS (SELECT doc_id, text, n, form, array_to_string(w[1 : a], '') AS p, array_to_string(w[a + 1 : b], '') AS m,
             array_to_string(w[b + 1 : n], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

OP13 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

SQL: dict[str, str] = {
    "op1_substring_dedup": OP1,
    "op6_warc": OP6,
    "op7_topk": OP7,
    "op10_jaccard_join": OP10,
    "op11_fim": OP11,
    "op13_hard_negatives": OP13,
}
