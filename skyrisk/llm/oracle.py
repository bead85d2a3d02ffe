"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL = {
    "op11_url_filter": rf"""
WITH rules(rule_host, rule_path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), cut AS (
    SELECT page_id, url, regexp_extract(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END, '^[^?#]*') AS rest
    FROM pages
), parts AS (
    SELECT page_id, url, translate(regexp_extract(rest, '^[^/]*'), '{UPPER}', '{LOWER}') AS host, regexp_replace(rest, '^[^/]*', '') AS path
    FROM cut
), spelt AS (
    SELECT *, regexp_replace(host, '^www\.|(\.|:80|:443)\z', '', 'g') AS own_host, regexp_replace(path, '/+\z', '') AS own_path
    FROM parts
), lists AS (
    SELECT DISTINCT own_host, own_path FROM spelt WHERE host <> '' AND regexp_matches(own_host, 'pills|spam|adult|bets')
), fits AS (
    SELECT DISTINCT url, rule_host || rule_path AS rule, rules.verdict,
           row_number() OVER (PARTITION BY url ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
    FROM (SELECT DISTINCT url, host, path FROM spelt) s
    JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule,
       coalesce(f.verdict, CASE WHEN l.own_host IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       l.own_host IS NOT NULL AS listed
FROM spelt s
LEFT JOIN fits f ON f.url = s.url AND f.place = 1
LEFT JOIN lists l ON l.own_host = s.own_host AND l.own_path = s.own_path AND s.host <> ''
""",
    "op12_ranked_search": rf"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), tfs AS (
    SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), sizes AS (
    SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY ALL
), totals AS (
    SELECT count(*) AS documents, sum(n)::BIGINT AS words FROM sizes
), asked AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), weights AS (
    SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM tfs, totals WHERE term IN (SELECT term FROM asked) GROUP BY term, documents
), scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // words))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (doc_id), totals
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}
