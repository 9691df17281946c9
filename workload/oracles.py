"""The same results as the registered queries, as SQL over the base tables."""

from __future__ import annotations

HOST = "http://api.example.com"

ORDER = """o_orderkey AS id, o_custkey AS customer, o_orderstatus AS status, o_totalprice AS total,
    o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date"""
PAGE = "o_orderkey // 50 AS page_no, o_orderkey % 50 AS entry_no"
CUSTOMER_PAGE = "c_custkey // 50 AS page_no, c_custkey % 50 AS entry_no"
SLUG = "lower(replace(o_orderpriority, ' ', '-'))"
SEEDED = f"""WITH s AS (
    SELECT *, o_orderkey // 250 AS n, {SLUG} AS slug,
        row_number() OVER (PARTITION BY o_orderpriority, o_orderkey // 250 ORDER BY o_orderkey) - 1 AS entry_no
    FROM orders)"""


def _chain(where: str, seed: str = f"'{HOST}/orders/' || slug || '?page=0'") -> str:
    return f"{SEEDED} SELECT {seed} AS seed, n AS page_no, entry_no, {ORDER} FROM s WHERE {where}"


def _json_customer() -> str:
    return """'{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey
        || ',"c_acctbal":' || CAST(c_acctbal AS VARCHAR) || ',"c_mktsegment":"' || c_mktsegment || '"}'"""


def _form(joint: str, pair: str) -> str:
    return (
        f"'c_custkey{pair}' || c_custkey || '{joint}c_name{pair}' || NAME || '{joint}c_nationkey{pair}' || c_nationkey"
        f" || '{joint}c_acctbal{pair}' || CAST(c_acctbal AS VARCHAR) || '{joint}c_mktsegment{pair}' || c_mktsegment"
    )


def _batches(text: str, delimiter: str, before: str = "", after: str = "", url: str = f"'{HOST}/in'") -> str:
    return f"""SELECT url, '{before}' || string_agg(t, {delimiter} ORDER BY c_custkey) || '{after}' AS body, count(*) AS n_records
    FROM (SELECT {url} AS url, c_custkey, {text} AS t FROM customer) GROUP BY url, c_custkey // 50"""


BAD = """c_custkey % 17 = 0 AS short, c_custkey % 11 = 0 AS long, c_custkey % 13 = 0 AS word,
    CASE WHEN c_custkey % 17 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE
        c_custkey || ',' || c_name || ',' || c_nationkey || ',' ||
        CASE WHEN c_custkey % 13 = 0 THEN 'much' ELSE CAST(c_acctbal AS VARCHAR) END || ',' || c_mktsegment ||
        CASE WHEN c_custkey % 11 = 0 THEN ',more' ELSE '' END END AS line"""
STATUS = "CAST(([{0}])[page_no % {1} + 1] AS INTEGER)"


def _statuses(values: list[int]) -> str:
    return STATUS.format(", ".join(map(str, values)), len(values))


ORACLES: dict[str, str] = {
    "scan_pages": f"SELECT {PAGE}, {ORDER} FROM orders",
    "fetch_responses": f"SELECT {PAGE}, {ORDER} FROM orders",
    "ordered_records": f"SELECT '{HOST}/orders?page={{pagination.index}}' AS seed, {PAGE}, {ORDER} FROM orders",
    "response_cols": """SELECT page_id AS page_no, url, CAST(200 AS INTEGER) AS status, CAST(octet_length(encode(html)) AS BIGINT) AS n_bytes,
        html AS text, 'text/html' AS header_content_type, CAST(page_id AS VARCHAR) AS header_x_id,
        CAST(NULL AS VARCHAR) AS header_absent FROM pages""",
    "page_hash": "SELECT min(doc_id) AS first_doc, count(*) AS n_docs FROM documents GROUP BY text",
    "json_records": f"SELECT {PAGE}, o_orderkey AS id, o_custkey AS customer, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date FROM orders",
    "json_mapping": f"SELECT {PAGE}, {ORDER} FROM orders",
    "json_nested": f"SELECT {PAGE}, o_orderkey AS id, o_orderpriority AS name FROM orders",
    "json_inner_path": f"SELECT {PAGE}, o_orderstatus AS status, o_totalprice AS total, o_orderpriority AS name FROM orders",
    "json_root_array": f"SELECT {CUSTOMER_PAGE}, c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer",
    "json_single_object": "SELECT c_custkey AS page_no, CAST(0 AS BIGINT) AS entry_no, c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer",
    "json_nested_types": "SELECT l_orderkey AS id, l_linenumber AS n, l_quantity AS qty, l_returnflag AS flag FROM lineitem",
    "json_path_get": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '/' AS left_over,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_again, '/k' AS walked, '/deeper' AS not_walked,
        '/absent/x' AS absent_left_over FROM events""",
    "typed_or_error": f"""SELECT {PAGE}, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS id,
        CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS total,
        CAST(CASE WHEN o_orderkey % 7 = 0 THEN 0 END AS INTEGER) AS code,
        CASE WHEN o_orderkey % 7 = 0 THEN '{{"id":' || o_orderkey || ',"total":"n/a"}}' END AS error_body FROM orders""",
    "json_missing_required": f"""SELECT {PAGE}, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS id,
        CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS total,
        CAST(CASE WHEN o_orderkey % 7 = 0 THEN 1 END AS INTEGER) AS code,
        CASE WHEN o_orderkey % 7 = 0 THEN '{{"id":' || o_orderkey || ',"total":null}}' END AS error_body,
        o_orderkey AS kept_id FROM orders""",
    "xml_records": "SELECT p_partkey // 50 AS page_no, p_partkey % 50 AS entry_no, p_partkey AS id FROM part",
    "xml_mapping": """SELECT p_partkey // 50 AS page_no, p_partkey % 50 AS entry_no, p_partkey AS id, p_name || ' & <co>' AS name,
        p_type AS cat, p_size AS size, p_retailprice AS price, 'EUR' AS cur,
        CASE WHEN p_size % 2 <> 0 THEN '<' || p_name || '>' END AS note FROM part""",
    "xml_predicate": """SELECT p_partkey // 50 AS page_no,
        row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey) - 1 AS entry_no,
        p_partkey AS id, p_brand AS brand FROM part WHERE p_type = 'ECONOMY'""",
    "xml_conditions": """
        WITH high AS (SELECT p_partkey, row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey) AS n FROM part
            WHERE p_size >= 45 AND (starts_with(p_type, 'ST') OR p_retailprice > 1900)),
        found AS (SELECT * FROM part WHERE p_size < 10 AND NOT contains(p_type, 'ECO')
            UNION ALL SELECT * FROM part WHERE p_partkey IN (SELECT p_partkey FROM high WHERE n <= 3))
        SELECT p_partkey // 50 AS page_no, p_partkey AS id, CASE WHEN p_retailprice > 1500 THEN p_retailprice END AS dear,
            p_brand AS same, CASE WHEN p_size % 2 <> 0 THEN '<' || p_name || '>' END AS note FROM found""",
    "xml_case_names": """SELECT p_partkey // 50 AS page_no, p_partkey % 50 AS entry_no, p_partkey AS id, 'y' || p_partkey AS capital,
        p_brand AS brand FROM part""",
    "xml_node_text": """SELECT p_partkey // 50 AS page_no, p_partkey % 50 AS entry_no, p_partkey AS id,
        CASE WHEN p_size % 2 <> 0 THEN '<' || p_name || '>' END AS note, '<b>' || p_brand || '</b>' AS box FROM part""",
    "xml_walked_path": """SELECT p_partkey // 50 AS page_no, p_partkey % 50 AS entry_no, p_partkey AS id, p_retailprice AS price,
        CASE WHEN p_size % 2 <> 0 THEN '<' || p_name || '>' END AS note FROM part""",
    "bytes_errors": """SELECT page_id AS page_no, CAST(500 AS INTEGER) AS code, CAST(octet_length(encode(html)) AS BIGINT) AS n_bytes,
        md5(html) AS digest FROM pages WHERE page_id % 3 = 0""",
    "xml_next_link": f"""SELECT page_no, '{HOST}/parts?page=' || page_no AS url, count(*) AS n_entries,
        CASE WHEN page_no % 3 <> 2 THEN '{HOST}/parts?page=' || (page_no + 1) END AS next_url
        FROM (SELECT p_partkey // 50 AS page_no FROM part) GROUP BY page_no""",
    "csv_records": f"""SELECT {CUSTOMER_PAGE}, CAST(c_custkey AS VARCHAR) AS custkey, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nationkey,
        CAST(c_acctbal AS VARCHAR) AS acctbal, c_mktsegment AS segment FROM customer""",
    "csv_typed": f"""SELECT {CUSTOMER_PAGE}, c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey,
        CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS acctbal, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment
        FROM customer""",
    "csv_quoted": f"""SELECT {CUSTOMER_PAGE}, c_custkey AS custkey, c_name || ', the "first"' AS name, c_nationkey AS nationkey,
        c_acctbal AS acctbal, c_mktsegment AS segment FROM customer""",
    "csv_skip_header": f"""SELECT {CUSTOMER_PAGE}, c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey,
        c_acctbal AS acctbal, c_mktsegment AS segment FROM customer""",
    "csv_bad_rows": f"""WITH b AS (SELECT *, {BAD} FROM customer)
        SELECT {CUSTOMER_PAGE}, CASE WHEN NOT (short OR long OR word) THEN c_custkey END AS custkey,
        CASE WHEN NOT (short OR long OR word) THEN c_name END AS name, CASE WHEN NOT (short OR long OR word) THEN c_acctbal END AS acctbal,
        CASE WHEN NOT (short OR long OR word) THEN c_mktsegment END AS segment,
        CAST(CASE WHEN short OR long OR word THEN 0 END AS INTEGER) AS code,
        CASE WHEN short OR long OR word THEN line END AS error_body FROM b""",
    "tsv_records": f"""SELECT {CUSTOMER_PAGE}, c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey,
        c_acctbal AS acctbal, c_mktsegment AS segment FROM customer""",
    "csv_infer_schema": f"""WITH c AS (SELECT '{HOST}/lines/' || (c_custkey // 500) AS seed, max(CASE WHEN c_custkey % 500 < 99 AND c_custkey % 9 = 0 THEN 1 ELSE 0 END) AS gap
            FROM customer GROUP BY c_custkey // 500)
        SELECT seed, CAST(position AS INTEGER) AS position, name, type, position = 4 AND gap = 1 AS nullable FROM c,
        (VALUES (0, 'custkey', 'int'), (1, 'name', 'string'), (2, 'nationkey', 'int'), (3, 'acctbal', 'double'), (4, 'segment', 'string')) AS v(position, name, type)""",
    "text_lines": r"""WITH p AS (SELECT doc_id, string_split_regex(text, '\r\n|\r|\n') AS l FROM documents),
        q AS (SELECT doc_id, CASE WHEN l[len(l)] = '' THEN l[1:len(l) - 1] ELSE l END AS l FROM p)
        SELECT doc_id AS page_no, i - 1 AS entry_no, l[i] AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM q)""",
    "blob_records": "SELECT page_id AS page_no, CAST(octet_length(encode(html)) AS BIGINT) AS n_bytes, md5(html) AS digest FROM pages",
    "page_none": "SELECT c_custkey AS id, c_name AS name FROM customer",
    "index_urls": f"""SELECT '{HOST}/c/' || c_custkey || '?from={{pagination.index}}&n=20' AS seed, i AS page_no, 10 + 20 * i AS page_index,
        '{HOST}/c/' || c_custkey || '?from=' || (10 + 20 * i) || '&n=20' AS url FROM customer, range(6) AS r(i)""",
    "index_stop_on_empty": _chain(
        "NOT (o_orderpriority = '1-URGENT' AND n >= 2) AND NOT (o_orderpriority = '3-MEDIUM' AND n >= 4)",
        f"'{HOST}/orders/' || slug || '?page={{pagination.index}}'",
    ),
    "link_header_chain": _chain("NOT (o_orderpriority = '1-URGENT' AND n > 3)"),
    "chain_stop_on_empty": _chain("NOT (o_orderpriority = '1-URGENT' AND n >= 2) AND NOT (o_orderpriority = '3-MEDIUM' AND n >= 4)"),
    "link_body_chain": _chain("NOT (o_orderpriority = '2-HIGH' AND n > 2)"),
    "token_chain": _chain("NOT (o_orderpriority = '4-NOT SPECIFIED' AND n > 1)", f"'{HOST}/orders/' || slug || '?n=50'"),
    "custom_chain": _chain("NOT (o_orderpriority = '5-LOW' AND n > 3)"),
    "replay_fetch": f"""SELECT page_no, '{HOST}/orders?page=' || page_no AS url, CAST(200 AS INTEGER) AS status, count(*) AS n_entries
        FROM (SELECT o_orderkey // 50 AS page_no FROM orders) WHERE page_no % 13 <> 5 GROUP BY page_no""",
    "missing_pages": f"""SELECT DISTINCT page_no, '{HOST}/orders?page=' || page_no AS url, CAST(0 AS INTEGER) AS code,
        'Failed to load the page {HOST}/orders?page=' || page_no AS message
        FROM (SELECT o_orderkey // 50 AS page_no FROM orders) WHERE page_no % 13 = 5""",
    "read_with_holes": f"""WITH p AS (SELECT o_orderkey // 50 AS page_no, count(*) AS n FROM orders GROUP BY 1)
        SELECT page_no, CASE WHEN page_no % 13 = 5 THEN 0 ELSE n END AS n_records, CAST(CASE WHEN page_no % 13 = 5 THEN 0 END AS INTEGER) AS code,
            CASE WHEN page_no % 13 = 5 THEN 'Failed to load the page {HOST}/orders?page=' || page_no END AS message FROM p""",
    "chain_with_holes": f"""{SEEDED}, p AS (SELECT slug, n, count(*) AS c, '{HOST}/orders/' || slug || '?page=' AS u FROM s GROUP BY slug, n)
        SELECT u || '0' AS seed, n AS page_no, CASE WHEN lost THEN 0 ELSE c END AS n_records, CAST(CASE WHEN lost THEN 0 END AS INTEGER) AS code,
            CASE WHEN lost THEN 'Failed to load the page ' || u || n END AS message
        FROM (SELECT *, (slug = '2-high' AND n = 3) OR (slug = '5-low' AND n = 0) AS lost FROM p)
        WHERE NOT (slug = '2-high' AND n > 3) AND NOT (slug = '5-low' AND n > 0)""",
    "chain_torn_tail": f"""{SEEDED}, p AS (SELECT slug, n, count(*) AS c, '{HOST}/orders/' || slug || '?page=' AS u FROM s GROUP BY slug, n)
        SELECT u || '0' AS seed, n AS page_no, c AS n_records, CAST(NULL AS INTEGER) AS code, CAST(NULL AS VARCHAR) AS message FROM p
        UNION ALL SELECT u || '0', max(n) + 1, 0, CAST(0 AS INTEGER), 'Failed to load the page ' || u || (max(n) + 1) FROM p GROUP BY u""",
    "read_recaptured": f"SELECT {PAGE}, {ORDER} FROM orders",
    "status_route": f"""WITH p AS (SELECT DISTINCT o_orderkey // 50 AS page_no FROM orders),
        q AS (SELECT page_no, {_statuses([200, 204, 404, 429, 503, 500, 302, 2000, 600])} AS status FROM p)
        SELECT page_no, status, CASE WHEN status BETWEEN 200 AND 299 THEN 'Success' WHEN status = 404 THEN 'Skip'
            WHEN status BETWEEN 400 AND 499 THEN 'Send to error' WHEN status = 503 THEN 'Retry and send to error'
            WHEN status BETWEEN 500 AND 599 THEN 'Retry and skip' WHEN status BETWEEN 600 AND 699 THEN 'Retry and fail' ELSE 'Fail' END AS strategy,
            status IN (503, 500, 600) AS should_retry,
            CASE WHEN status BETWEEN 200 AND 299 THEN 'success' WHEN status IN (404, 500) THEN 'skipOnError'
            WHEN status IN (429, 503) THEN 'sendToError' ELSE 'stopOnError' END AS after_retry FROM q""",
    "http_error_page": f"""WITH p AS (SELECT DISTINCT o_orderkey // 50 AS page_no FROM orders),
        q AS (SELECT page_no, {_statuses([200, 404, 429, 503, 500])} AS code FROM p)
        SELECT page_no, CAST(0 AS BIGINT) AS entry_no, '{HOST}/orders?page=' || page_no AS url, code,
            'Request failed with ''' || code || ''' http status code. Body is ''busy ' || page_no || '''' AS message,
            'busy ' || page_no AS body FROM q WHERE code IN (429, 503)""",
    "send_to_error": f"""WITH b AS (SELECT *, {BAD} FROM customer)
        SELECT {CUSTOMER_PAGE}, '{HOST}/lines/' || (c_custkey // 50) AS url, CAST(0 AS INTEGER) AS code,
            'Cannot convert line ''' || line || ''' to a record. Reason: ' ||
            CASE WHEN short THEN 'no value for field ''name'', which is not nullable' WHEN long THEN 'more than 5 columns'
            ELSE 'field ''acctbal'' is not of type double' END AS message, line AS body FROM b WHERE short OR long OR word""",
    "skip_on_error": """SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment
        FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 17 <> 0""",
    "stop_on_error": """SELECT count(*) AS n_bad, true AS stopped FROM customer
        WHERE c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 17 = 0""",
    "retry_resolve": """WITH log AS (SELECT user_id AS url, event_id AS attempt,
            (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / 1000000.0 AS elapsed,
            CASE event_type WHEN 'error' THEN 500 WHEN 'click' THEN 503 WHEN 'view' THEN 429 ELSE 200 END AS status FROM events),
        m AS (SELECT *, status <> 200 AS again FROM log WHERE elapsed <= 43200 OR attempt = 1),
        g AS (SELECT url, min(CASE WHEN NOT again THEN attempt END) AS final, max(attempt) AS last FROM m GROUP BY url)
        SELECT g.url, m.attempt, CAST(m.status AS INTEGER) AS status,
            CASE WHEN m.status = 200 THEN 'Success' WHEN m.status = 429 THEN 'Retry and skip' ELSE 'Retry and send to error' END AS strategy,
            CASE WHEN m.status = 200 THEN 'success' WHEN m.status = 429 THEN 'skipOnError' ELSE 'sendToError' END AS after_retry,
            g.final IS NULL AS timed_out FROM g JOIN m ON m.url = g.url AND m.attempt = coalesce(g.final, g.last)""",
    "stream_pages": f"SELECT {PAGE}, {ORDER} FROM orders",
    "stream_resume": f"SELECT {PAGE}, {ORDER} FROM orders",
    "stream_max_pages": f"SELECT {PAGE}, {ORDER} FROM orders",
    "stream_skip_seen": f"SELECT {PAGE}, {ORDER} FROM orders",
    "stream_fetch": _chain("NOT (o_orderpriority = '1-URGENT' AND n > 3)"),
    "sink_json_lines": _batches(_json_customer(), "chr(10)"),
    "sink_json_array": _batches(_json_customer(), "','", "[", "]"),
    "sink_json_wrapped": _batches(_json_customer(), "','", '{"customers":[', "]}"),
    "sink_form": _batches(
        f"replace(url_encode({_form('&', '=').replace('NAME', 'c_name')}), '%20', '+')", "'|'"
    ),
    "sink_form_pairs": _batches(
        _form("&", "=").replace("NAME", "url_encode(c_name)"), "chr(10)"
    ),
    "sink_custom": _batches("c_name || ' (#' || c_custkey || ') has ' || CAST(c_acctbal AS VARCHAR)", "'; '"),
    "sink_url_template": _batches(
        _json_customer(), "chr(10)", url=f"'{HOST}/nation/' || c_nationkey || '/of/' || replace(url_encode(c_mktsegment), '%20', '+')"
    ),
    "sink_delete": f"""SELECT 'DELETE' AS method, '{HOST}/customer/' || c_custkey || '?name=' || url_encode(c_name) AS url,
        CAST(NULL AS VARCHAR) AS body, CAST(1 AS BIGINT) AS n_records, CAST(c_custkey AS VARCHAR) AS batch_id FROM customer""",
    "sink_messages": """SELECT 'POST' AS method, 'application/json' AS content_type,
        '{"Content-Type":"application/json","Instance-Follow-Redirects":"true","Request-Method":"POST","X-App":"a","charset":"UTF-8"}' AS headers,
        true AS fits, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "sink_outcomes": f"""SELECT '{HOST}/customer/' || c_custkey AS url, CAST(c_custkey AS VARCHAR) AS batch_id, CAST(1 AS BIGINT) AS n_records,
        CAST(CASE c_custkey % 10 WHEN 3 THEN 404 WHEN 7 THEN 409 ELSE 204 END AS INTEGER) AS status, CAST(1 AS INTEGER) AS attempts,
        CASE c_custkey % 10 WHEN 3 THEN 'skipOnError' WHEN 7 THEN 'sendToError' ELSE 'success' END AS handling FROM customer""",
}
