"""DuckDB SQL for the queries that SQL can express.

The others are tested against brute force: SQL has no byte-pair merges (1, 2, 6), no subset choice by
hash and dynamic program (3), no learnt model (7), no graph search (9).
"""

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

ORACLE = {
    "op5_warc_round_trip": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
        ), d AS (
            SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS sha, max(page_id) OVER (PARTITION BY body) AS keeper FROM p
        ), bits AS (
            SELECT *, list_transform(range(40), lambda i: strpos('0123456789abcdef', substr(sha, i + 1, 1)) - 1) AS hex FROM d
        )
        SELECT
            page_id,
            payload_bytes,
            list_aggregate(list_transform(range(32), lambda i:
                substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda b: 
                    ((hex[(5 * i + b) // 4 + 1] >> (3 - (5 * i + b) % 4)) & 1) << (4 - b)))::BIGINT, 1)), 'string_agg', '') AS payload_digest,
            CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id < keeper THEN keeper END AS refers_to
        FROM bits
    """,
    "op8_line_spread": """
        WITH cut AS (
            SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents
        ), lines AS (
            SELECT doc_id, source, generate_subscripts(parts, 1) AS i, unnest(parts) AS line FROM cut
        ), bare AS (
            SELECT *, regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS key FROM lines
        ), spread AS (
            SELECT key FROM bare WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= 6
        ), marked AS (
            SELECT b.*, s.key IS NOT NULL AS bad FROM bare b LEFT JOIN spread s USING (key)
        ), sums AS (
            SELECT
                doc_id,
                count(*) FILTER (key <> '') AS n_lines,
                count(*) FILTER (bad) AS n_spread,
                string_agg(line, chr(10) ORDER BY i) FILTER (NOT bad) AS rest
            FROM marked GROUP BY doc_id
        ), keys AS (
            SELECT DISTINCT doc_id, key FROM marked JOIN sums USING (doc_id) WHERE key <> '' AND n_spread > 0.5 * n_lines
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM keys GROUP BY doc_id
        ), pairs AS (
            SELECT a.doc_id, b.doc_id AS other, count(*) AS n_both
            FROM keys a JOIN keys b ON a.key = b.key AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
        ), copies AS (
            SELECT DISTINCT p.doc_id, true AS is_copy FROM pairs p JOIN sizes a ON p.doc_id = a.doc_id JOIN sizes b ON p.other = b.doc_id
            WHERE 100 * n_both >= 80 * (a.n + b.n - n_both)
        )
        SELECT
            d.doc_id,
            coalesce(n_lines, 0) AS n_lines,
            coalesce(n_spread, 0) AS n_spread,
            CASE WHEN is_copy THEN 0 ELSE coalesce(n_spread, 0) END AS n_removed,
            md5(CASE WHEN n_spread > 0 AND is_copy IS NULL THEN coalesce(rest, '') ELSE text END) AS text_md5
        FROM documents d LEFT JOIN sums USING (doc_id) LEFT JOIN copies ON d.doc_id = copies.doc_id
    """,
}
