"""DuckDB SQL of the queries of ``storage``: what has to come back from files, documents and streams."""

from __future__ import annotations

from . import oracles, storage
from .oracles import ANCHOR_HREFS, COUNTERS, HEADING, HOST, LINES, QUEUE, RECORDS, SCAN
from .views import TEXTS_SQL, values_sql

_RESULTS = f"SELECT 'e' || pos || '.uk' AS domain, machine, dns_active, http_active, http_status, response_ms, error FROM {SCAN} s"
_COUNTS = f"(SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM (SELECT coalesce(http_status::VARCHAR, 'none') AS k, count(*) AS n FROM {SCAN} t GROUP BY 1) u)"


def oracle_sql() -> dict[str, str]:
    queue = f"SELECT pos, domain FROM {QUEUE} q"
    return {
        "domain_list_read": queue,
        "line_counts": "SELECT count(*) AS domains, 2 * count(*) AS lines, count(*) AS output, 0::BIGINT AS missing FROM customer",
        "resume_from_files": f"SELECT domain, machine FROM ({_RESULTS}) r WHERE machine IN ('m1', 'm3')",
        "results_reread": f"SELECT domain, dns_active, http_active, http_status, response_ms, error FROM ({_RESULTS}) r",
        "tolerant_counts": f"""SELECT count(*) AS processed, count(json_extract_string(value, '$.domain')) AS named
            FROM (SELECT * FROM (SELECT value FROM {LINES} l UNION ALL SELECT props FROM events) m WHERE trim(value) <> '' AND json_valid(value)) g""",
        "run_documents": f"SELECT machine, processed, active, inactive, errors, has_email, last_domain FROM {COUNTERS} c",
        "registry_document": "SELECT lower(n_name) AS key, n_name AS label, CASE WHEN n_nationkey % 2 = 1 THEN 'tail' ELSE 'auto' END AS mode FROM nation WHERE n_nationkey % 5 > 1",
        "part_files": queue,
        "sorted_list_file": f"SELECT row_number() OVER (ORDER BY domain) - 1 AS pos, domain FROM (SELECT DISTINCT domain FROM {SCAN} s) d",
        "summary_document": oracles.oracle_sql()["merge_summary"],
        "record_lines": f"SELECT row_number() OVER (ORDER BY pos) - 1 AS pos, domain AS input_url, http_active AS active, http_status, error FROM {SCAN} s",
        "stream_append": f"SELECT pos, machine, domain, http_status FROM {SCAN} s",
        "watched_state": f"""SELECT count(*) + 5 AS total, count(*) AS processed, 5::BIGINT AS remaining, count(*) FILTER (http_active) AS active, count(*) FILTER (NOT http_active) AS inactive,
            count(error) AS errors, 'running' AS status, {_COUNTS} AS counts FROM {SCAN} s""",
        "latest_pushes": """SELECT 'm' || event_id % 4 AS machine, max_by(props, event_id) AS payload, max(event_id) >= (SELECT max(event_id) FROM events) - 2 AS fresh FROM events GROUP BY 1""",
        "file_checksums": """SELECT n_regionkey::INTEGER AS n_regionkey, sha256(string_agg(n_name || chr(10), '' ORDER BY n_name)) AS sha256, sum(strlen(n_name) + 1)::BIGINT AS size FROM nation GROUP BY n_regionkey""",
        "fetched_bodies": f"SELECT url, 200 AS status, strlen(html)::INTEGER AS n_bytes FROM pages UNION ALL SELECT '{storage.LONG_BODY[0]}', 200, 2000000",
        "argument_urls": "SELECT pos::BIGINT AS pos, url FROM " + values_sql([(0, "https://kestrel.example"), (1, "https://osprey.example/jobs"), (2, "http://heron.example/")], "pos, url") + """ a
            UNION ALL SELECT 2 + row_number() OVER (ORDER BY n_nationkey), 'https://' || replace(lower(n_name), ' ', '-') || '.example/' || n_nationkey FROM nation""",
        "positional_zip": "SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, lower(c_name) AS domain, c_acctbal AS result FROM customer",
        "probe_outcomes": f"""SELECT domain, k <> 3 AS dns_active, k IN (0, 1, 5, 7, 8) AS http_active, (CASE k WHEN 0 THEN 200 WHEN 1 THEN 301 WHEN 2 THEN 503 WHEN 4 THEN 404 WHEN 5 THEN 403 WHEN 7 THEN 302 WHEN 8 THEN 200 END)::INTEGER AS http_status,
            CASE k WHEN 1 THEN 'http://' || domain || '/' WHEN 3 THEN NULL WHEN 4 THEN 'https://' || domain || '/b' WHEN 6 THEN NULL WHEN 7 THEN 'https://' || domain || '/x' WHEN 8 THEN 'https://' || domain || '/9'
            ELSE 'https://' || domain END AS final_url, (CASE k WHEN 4 THEN 2 WHEN 7 THEN 10 WHEN 8 THEN 9 ELSE 0 END)::INTEGER AS redirect_count,
            CASE k WHEN 4 THEN 'https://' || domain || '/b' WHEN 7 THEN 'https://' || domain || '/y' WHEN 8 THEN 'https://' || domain || '/9' END AS last_location,
            CASE k WHEN 1 THEN 'tls: bad' WHEN 3 THEN 'no such host' WHEN 6 THEN 'connection refused' END AS error, (CASE WHEN k IN (2, 3, 6) THEN 2 ELSE 1 END)::INTEGER AS attempts, true AS timed
            FROM (SELECT c_custkey % 9 AS k, 'c' || c_custkey || '.uk' AS domain FROM customer) c""",
        "url_resolution": f"""SELECT page_id, n, target, {HOST} = {HOST.replace('url', 'target')} AS same_host FROM (SELECT page_id, url, n::INTEGER AS n, CASE n
            WHEN 0 THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || href WHEN 1 THEN href WHEN 2 THEN regexp_extract(url, '^[a-z]+:') || href
            ELSE regexp_extract(url, '^[^?#]*') || href END AS target FROM pages CROSS JOIN {values_sql(storage.REFERENCES, 'n, href')} r) t""",
        "merged_pages": f"""SELECT site, len(said)::INTEGER AS n_pages, array_to_string(list_filter(said, lambda x, i: list_position(said, x) = i)[1:25], ' | ') AS headings, len(links)::INTEGER AS n_anchors, array_to_string(links, ' ') AS hrefs
            FROM (SELECT page_id // {storage.PAGES_A_SITE} AS site, list({HEADING} ORDER BY page_id) AS said, flatten(list({ANCHOR_HREFS} ORDER BY page_id)) AS links FROM pages GROUP BY 1) p""",
        "distinct_candidates": """SELECT site, seq, url FROM (SELECT user_id AS site, event_id AS seq, CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END AS url,
            row_number() OVER (PARTITION BY user_id, lower(event_type) ORDER BY event_id) AS r FROM events) e WHERE r = 1""",
        "contacts_joined": f"""WITH mails AS ({oracles._emails()}), numbers AS ({oracles._phones()})
            SELECT t.doc_id, CASE WHEN t.text IS NOT NULL THEN coalesce(m.joined, '') END AS emails, coalesce(m.one, p.one) AS contact FROM {TEXTS_SQL} t
            LEFT JOIN (SELECT doc_id, string_agg(email, ', ' ORDER BY n) AS joined, min_by(email, n) AS one FROM mails GROUP BY doc_id) m ON m.doc_id = t.doc_id
            LEFT JOIN (SELECT doc_id, min_by(phone, n) AS one FROM numbers GROUP BY doc_id) p ON p.doc_id = t.doc_id""",
        "number_presence": f"SELECT machine, count(*) FILTER (has_number OR pos % 5 = 3) AS company_number FROM {RECORDS} r GROUP BY machine",
    }
