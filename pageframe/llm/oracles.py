"""SQL of the queries that SQL can express.

Fingerprints (XXH64), token ids, learned scores and spans with checksums are beyond it; those queries
are tested against plain computations. The SQL of ``op3_url_filter`` follows canonical links that are
absolute and written plainly; other ways of writing them, which the test tables lack, have tests of their own.
"""

ORACLES: dict[str, str] = {
    "op3_url_filter": r"""
        WITH RECURSIVE rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
            ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
        u AS (SELECT row_number() OVER () AS k, page_id, html, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') AS rest FROM pages),
        s AS (SELECT *, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*([?][^#]*)', 1) AS query FROM u),
        t AS (SELECT *, regexp_extract(html, '<link rel="canonical" href="[a-z]+://([^"#]*)', 1) AS link FROM s),
        n AS (SELECT *, CASE WHEN rest = '' THEN '' ELSE host || CASE WHEN path = '' THEN '/' ELSE path END || query END AS node FROM t),
        e AS (SELECT node AS a, link AS b FROM n WHERE node <> '' AND link <> ''),
        w AS (SELECT a, b FROM e UNION SELECT b, a FROM e UNION SELECT a, a FROM e UNION SELECT b, b FROM e),
        reach AS (SELECT a, b FROM w UNION SELECT reach.a, w.b FROM reach JOIN w ON reach.b = w.a),
        v AS (SELECT b, arg_max(verdict, length(h) + length(p)) AS v FROM (SELECT DISTINCT b, regexp_extract(b, '^([^/?#]*)', 1) AS bh,
            regexp_extract(b, '^[^/?#]*([^?#]*)', 1) AS bp FROM reach) JOIN rules ON (bh = h OR ends_with(bh, '.' || h)) AND starts_with(bp, p) GROUP BY b),
        c AS (SELECT a, bool_or(v = 'block') AND NOT bool_or(v = 'allow') AS blocked FROM reach JOIN v USING (b) GROUP BY a),
        r AS (SELECT k, arg_max(h || p, length(h) + length(p)) AS rule, arg_max(verdict, length(h) + length(p)) AS verdict
            FROM n JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY k)
        SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
        FROM n LEFT JOIN r USING (k) LEFT JOIN c ON c.a = n.node""",
    "op4_warc": """
        WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha256(coalesce(html, '')) AS d FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p),
        r AS (SELECT *, n >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS again FROM f)
        SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN again THEN first END AS refers_to FROM r""",
    "op6_mixing": r"""
        WITH d AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '-' || coalesce(text, ''))) AS digest,
            CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source),
        w AS (SELECT source, n, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w FROM s),
        r AS (SELECT *, sum(n) OVER () - 3.0 * coalesce(sum(n) OVER (ORDER BY n / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
            sum(w) OVER (ORDER BY n / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM w),
        l AS (SELECT arg_min(CAST(rest / weights AS DOUBLE), n / w) AS level FROM r WHERE rest / weights <= 3.0 * n / w),
        t AS (SELECT source, n, w, least(n * CAST(3 AS DOUBLE), coalesce(level, 1e300) * w) AS target FROM w, l),
        p AS (SELECT d.*, t.n, t.w, t.target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY digest, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        c AS (SELECT *, list_filter([0, 1, 2], lambda e: start + size / CAST(2 AS DOUBLE) + e * n < target) AS epochs FROM p),
        q AS (SELECT *, list_transform(epochs, lambda e: CASE WHEN target > 0 THEN least((start + e * n) / target, 1) ELSE 0 END) AS shares FROM c),
        z AS (SELECT *, list_transform(shares, lambda x: CASE
            WHEN w = 1 THEN least(2 * x / (1.5 + sqrt(greatest(CAST(2.25 AS DOUBLE) - 2 * x, 0))), 1)
            WHEN w = 3 THEN least(2 * x / (0.5 + sqrt(CAST(0.25 AS DOUBLE) + 2 * x)), 1)
            WHEN x * CAST(1.0625 AS DOUBLE) <= 0.5625 THEN least(2 * (x * CAST(1.0625 AS DOUBLE)) / (1 + sqrt(1 + x * CAST(1.0625 AS DOUBLE))), 0.5)
            ELSE least(0.5 + 2 * (x * CAST(1.0625 AS DOUBLE) - 0.5625) / (1.25 + sqrt(greatest(CAST(1.5625 AS DOUBLE) - 2 * (x * CAST(1.0625 AS DOUBLE) - 0.5625), 0))), 1)
            END) AS places FROM q)
        SELECT doc_id, size, n AS source_size, CAST(target AS DOUBLE) AS target, CAST(size * len(epochs) AS BIGINT) AS taken,
            array_to_string(list_transform(places, lambda x: CAST(CAST(round(x * 1e9) AS BIGINT) AS VARCHAR)), ',') AS positions FROM z""",
    "op13_search": r"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
        a AS (SELECT CAST(count(*) FILTER (len(t) > 0) AS BIGINT) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM d),
        i AS (SELECT k, item_id, term, CAST(count(*) AS BIGINT) AS times FROM (SELECT row_number() OVER () AS k, item_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
        p AS (SELECT k, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT k, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM d)
            WHERE term IN (SELECT term FROM i) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), a),
        s AS (SELECT i.k, i.item_id, p.k AS dk, CAST(sum(i.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * p.n * a.docs) // a.terms)))) AS BIGINT) AS score
            FROM i JOIN p USING (term) JOIN w USING (term), a GROUP BY ALL HAVING score > 0),
        r AS (SELECT s.item_id, d.doc_id, s.score, CAST(row_number() OVER (PARTITION BY s.k ORDER BY s.score DESC, d.doc_id NULLS FIRST) AS INTEGER) AS rank
            FROM s JOIN d ON d.k = s.dk)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20""",
    "op8_quality": r"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce('=' || source, '-') AS host, coalesce(text, '') AS t,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        g AS (SELECT k, unnest(range(1, len(ws) - 6)) AS i, unnest(list_transform(range(1, len(ws) - 6), lambda i: array_to_string(ws[i:i + 7], ' '))) AS win
            FROM d WHERE len(ws) > 8),
        p AS (SELECT k, count(DISTINCT i + j) AS n FROM (SELECT k, i, count(*) OVER (PARTITION BY k, win) AS times FROM g), range(8) AS o(j)
            WHERE times > 1 GROUP BY k),
        x AS (SELECT k, unnest(list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]'))) AS line FROM d),
        y AS (SELECT k, count(*) - count(DISTINCT line) AS n FROM x GROUP BY k),
        z AS (SELECT k, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words, translate(array_to_string(
            regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line FROM x),
        h AS (SELECT host, count(DISTINCT t) AS docs FROM d GROUP BY host),
        c AS (SELECT host, line, count(DISTINCT t) AS n FROM z JOIN d USING (k) GROUP BY ALL),
        l AS (SELECT host, line FROM c JOIN h USING (host) WHERE n > least(200, greatest(5, docs * 10 / CAST(100 AS DOUBLE)))),
        r AS (SELECT k, sum(words) AS n FROM z JOIN d USING (k) JOIN l USING (host, line) GROUP BY k),
        f AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
            CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(y.n, 0) AS BIGINT) AS n_dup_lines,
            CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words, coalesce(r.n, 0) AS removed
            FROM d LEFT JOIN p USING (k) LEFT JOIN y USING (k) LEFT JOIN r USING (k))
        SELECT * EXCLUDE (removed), n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
            NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * (n_words - removed) >= 30 * n_words AS kept FROM f""",
    "op9_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
