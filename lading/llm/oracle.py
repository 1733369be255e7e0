"""SQL counterparts of the training-data queries that SQL can express.

Those that hash with XXH64, tokenize, draw at random, train or parse markup have none; they are
tested against plain versions.
"""

from __future__ import annotations

_USABLE = """
    good AS (
        SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    )
"""

ORACLE_SQL: dict[str, str] = {
    "op1_embeddings": f"""
WITH RECURSIVE {_USABLE},
    links AS (
        SELECT a.vec_id AS src, b.vec_id AS dst
        FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        WHERE list_inner_product(a.v, b.v)
            / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) >= 0.95
    ),
    reach AS (
        SELECT vec_id, vec_id AS other FROM embeddings
        UNION
        SELECT r.vec_id, l.dst FROM reach r JOIN links l ON l.src = r.other
    )
SELECT e.vec_id,
       (SELECT count(*) FROM links l WHERE l.src = e.vec_id) AS n_links,
       r.component_id,
       e.vec_id = r.component_id AS kept
FROM embeddings e JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) r USING (vec_id)
""",
    "op3_warc": """
WITH payloads AS (
    SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT payload_digest, min(page_id) AS first_id FROM payloads WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT p.page_id, p.payload_bytes::BIGINT AS payload_bytes, p.payload_digest,
       CASE WHEN f.first_id < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id < p.page_id THEN f.first_id END AS refers_to, p.url
FROM payloads p LEFT JOIN firsts f ON f.payload_digest = p.payload_digest AND p.payload_bytes >= 100
""",
    "op5_passages": """
WITH texts AS (
    SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), places AS (
    SELECT doc_id, b, unnest(range(0, greatest(octet_length(b) - 49, 0))) AS i FROM texts
), strings AS (
    SELECT doc_id, i, md5(b[i + 1 : i + 50]) AS s FROM places
), firsts AS (
    SELECT s, min(doc_id) AS first_id FROM strings GROUP BY s
), covered AS (
    SELECT doc_id, i, i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 AS apart
    FROM strings JOIN firsts USING (s) WHERE first_id < doc_id
), numbered AS (
    SELECT doc_id, i, sum(coalesce(apart, false)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM covered
), spans AS (
    SELECT doc_id, min(i) AS first, max(i) + 50 AS last FROM numbered GROUP BY doc_id, span
), gaps AS (
    SELECT doc_id, first, last, coalesce(lag(last) OVER w, 0) AS before, lead(first) OVER w IS NULL AS ends
    FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY first)
), joined AS (
    SELECT doc_id, sum(last - first) AS n_removed, count(*) AS n_spans,
           string_agg(hex(b[before + 1 : first]) || CASE WHEN ends THEN hex(b[last + 1 :]) ELSE '' END, '' ORDER BY first)
               AS kept
    FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT t.doc_id, octet_length(t.b)::BIGINT AS n_bytes, coalesce(j.n_removed, 0)::BIGINT AS n_removed,
       coalesce(j.n_spans, 0)::BIGINT AS n_spans, sha256(coalesce(unhex(j.kept), t.b)) AS kept_sha256
FROM texts t LEFT JOIN joined j USING (doc_id)
""",
    "op9_neighbours": f"""
WITH {_USABLE},
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
        FROM good q JOIN good c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
        WHERE q.vec_id % 20 = 0
    ),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
    )
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM placed WHERE rank <= 20
""",
    "op11_sharding": """
WITH crcs AS (
    -- The table of CRC-32, by its rule.
    SELECT list(list_reduce(list_concat([b], range(8)), lambda c, _:
        CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
    FROM (SELECT unnest(range(256)) AS b)
), texts AS (
    SELECT doc_id, source, encode(coalesce(text, '')) AS b,
           ('0x' || substr(md5('23:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS draw
    FROM documents
), sized AS (
    SELECT doc_id, source, draw, octet_length(b)::BIGINT + 1 AS size,
           xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
               list_transform(regexp_extract_all(hex(b), '..'), lambda h: ('0x' || h)::BIGINT)), lambda c, x:
               xor(t[(xor(c, x) & 255) + 1], c >> 8))) AS text_crc32
    FROM texts, crcs
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY draw, doc_id NULLS FIRST, text_crc32, size) - 1 AS r,
           count(*) OVER (PARTITION BY source) AS n
    FROM sized
), placed AS (
    SELECT *, row_number() OVER (ORDER BY (2 * r + 1)::DOUBLE / (2 * n)::DOUBLE, source NULLS FIRST, draw, doc_id NULLS FIRST,
               text_crc32, size) - 1 AS p, count(*) OVER () AS total
    FROM ranked
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (p * 8 // total)::INTEGER AS shard,
       p - ((p * 8 // total) * total + 7) // 8 AS slot, NULL::INTEGER AS grown_shard, source
FROM placed
""",
    "op13_divergence": r"""
WITH found AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), groups AS (
    SELECT DISTINCT lang, source FROM found
), counted AS (
    SELECT doc, lang, source, term, count(*) AS n FROM (SELECT doc, lang, source, unnest(terms) AS term FROM found) GROUP BY ALL
), kept AS (
    SELECT lang, term, sum(n)::HUGEINT AS n FROM counted GROUP BY lang, term HAVING count(*) >= 3
), held AS (
    SELECT lang, source, term, sum(n)::HUGEINT AS n FROM counted SEMI JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
    SELECT lang, source, sum(n) AS n FROM held GROUP BY lang, source
), langs AS (
    SELECT lang, sum(n) AS n, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), rated AS (
    SELECT g.lang, g.source, k.term, coalesce(h.n, 0)::HUGEINT AS n,
           1 + 1000000000::HUGEINT * (coalesce(h.n, 0) + 1) // (coalesce(s.n, 0) + l.v) AS p,
           1 + 1000000000::HUGEINT * (k.n + 1) // (l.n + l.v) AS q
    FROM groups g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
    LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
    LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM rated a JOIN rated b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
    GROUP BY ALL
), parts AS (
    SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(p.value, 0) AS value
    FROM groups g JOIN groups o ON o.lang = g.lang AND o.source <> g.source
    LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = o.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM rated WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
""",
}
