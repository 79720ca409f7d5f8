"""DuckDB SQL of the queries of ``flows``."""

from __future__ import annotations

from . import flows, oracles
from .oracles import SCAN


def oracle_sql() -> dict[str, str]:
    kind = "c_custkey % 8"
    url = "'https://c' || c_custkey || '.uk'"
    return {
        "pushed_states": f"""WITH latest AS (
              SELECT user_id, max(event_id) FILTER (event_type IN ('purchase', 'signup')) AS pushed, max(event_id) FILTER (event_type NOT IN ('purchase', 'signup')) AS pulled FROM events GROUP BY user_id
            ), chosen AS (
              SELECT user_id, pushed, pulled, coalesce(pushed >= (SELECT max(event_id) FROM events) - {flows.PUSH_TTL}, false) AS fresh FROM latest
            )
            SELECT 'u' || c.user_id AS machine, CASE WHEN fresh THEN 'push' WHEN pulled IS NOT NULL THEN 'pull' ELSE 'none' END AS source, e.props AS payload
            FROM chosen c LEFT JOIN events e ON e.event_id = CASE WHEN fresh THEN pushed ELSE pulled END""",
        "tailed_counters": f"""SELECT coalesce(http_status::VARCHAR, 'none') AS status, count(*) AS processed, count(*) FILTER (http_active) AS active, count(error) AS errors FROM {SCAN} s GROUP BY 1""",
        "redirect_chains": """WITH RECURSIVE named AS (
              SELECT page_id AS p, url || '&p=' || page_id AS url, CASE WHEN page_id % 26 = 0 THEN page_id + 12 ELSE page_id - 1 END AS goes,
                CASE WHEN page_id % 31 = 7 THEN NULL WHEN page_id % 26 = 13 THEN 200 WHEN page_id % 29 = 5 THEN 304 WHEN page_id % 2 = 0 THEN 302 ELSE 301 END AS status FROM pages
            ), moved AS (
              SELECT n.*, t.url AS location FROM named n LEFT JOIN named t ON t.p = n.goes
            ), walk AS (
              SELECT p AS start, p AS at, 0 AS n, [url] AS chain FROM moved
              UNION ALL
              SELECT w.start, m.goes, w.n + 1, list_append(w.chain, m.location) FROM walk w JOIN moved m ON m.p = w.at WHERE w.n < 10 AND m.status IN (301, 302) AND m.location IS NOT NULL
            ), ended AS (
              SELECT start, arg_max(chain, n) AS chain, max(n) AS n FROM walk GROUP BY start
            ), told AS (
              SELECT start, chain, n, chain[least(n, 9) + 1] AS final_url FROM ended
            )
            SELECT start AS page_id, coalesce(m.status < 400, false) AS http_active, m.status::INTEGER AS http_status, CASE WHEN m.status IS NOT NULL THEN final_url END AS final_url,
              (CASE WHEN m.status IS NOT NULL THEN n ELSE 0 END)::INTEGER AS redirect_count, CASE WHEN m.status IS NOT NULL AND n > 0 THEN array_to_string(chain, ' ') END AS chain,
              CASE WHEN m.p % 31 = 7 THEN 'connection reset' END AS error
            FROM told JOIN moved m ON m.url = final_url""",
        "fetch_replay": f"""SELECT {url} AS url, CASE WHEN k = 2 THEN 'plain' WHEN k IN (4, 5, 7) THEN 'browser' ELSE 'direct' END AS via,
              (CASE WHEN k IN (0, 1, 2, 4, 7) THEN 200 ELSE 0 END)::INTEGER AS status, CASE WHEN k = 2 THEN 'http://c' || c_custkey || '.uk/' WHEN k IN (0, 1, 4, 7) THEN {url} || '/' END AS final_url,
              CASE k WHEN 2 THEN 'plain' WHEN 5 THEN 'part' WHEN 4 THEN 'seen' WHEN 7 THEN 'seen' WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' END AS body,
              CASE k WHEN 3 THEN 'no such host' WHEN 5 THEN 'closed' WHEN 6 THEN 'connection refused' END AS error, (CASE k WHEN 0 THEN 1 WHEN 2 THEN 3 WHEN 5 THEN 3 WHEN 6 THEN 4 ELSE 2 END)::BIGINT AS tries
            FROM (SELECT c_custkey, {kind} AS k FROM customer) c""",
        "next_requests": f"""SELECT {url} AS url, (CASE WHEN c_custkey % 9 = 0 THEN 0 ELSE 1 END)::INTEGER AS seq, via, {url} AS request_url,
              (CASE WHEN c_custkey % 9 <> 0 AND via = 'direct' THEN 4000 ELSE 8000 END)::INTEGER AS timeout_ms, (CASE WHEN c_custkey % 9 <> 0 AND via = 'direct' THEN 150 ELSE 0 END)::INTEGER AS wait_ms,
              c_custkey % 9 <> 0 AND via = 'direct' AS fresh
            FROM (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 OR {kind} IN (1, 2, 5, 6) THEN 'direct' WHEN {kind} IN (3, 4, 7) THEN 'browser' END AS via FROM customer) c WHERE via IS NOT NULL""",
        "incremental_counters": f"""SELECT machine, count(*) AS processed, count(*) FILTER (http_active) AS active, count(error) AS errors, 1::BIGINT AS files_read, 3::BIGINT AS files_kept FROM {SCAN} s GROUP BY machine""",
        "queue_moves": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderpriority = '1-URGENT' THEN 'running' ELSE 'queue' END AS place FROM orders",
        "result_faults": """WITH lines AS (
              SELECT event_id % 7 AS f, row_number() OVER (PARTITION BY event_id % 7 ORDER BY event_id) AS line,
                CASE WHEN event_id % 997 = 5 AND event_id % 7 <> 3 THEN 'not a result' WHEN event_id % 1009 = 8 AND event_id % 7 <> 3 THEN 'blank'
                  WHEN event_id % 1013 = 9 AND event_id % 7 = 4 THEN 'not a result' END AS reason FROM events
            )
            SELECT 'f' || f AS file, count(*) AS lines, count(reason) AS bad_lines, min(line) FILTER (reason IS NOT NULL) AS first_bad_line, arg_min(reason, line) FILTER (reason IS NOT NULL) AS reason
            FROM lines GROUP BY f""",
        "ordered_results": f"SELECT row_number() OVER (ORDER BY machine, s.pos) - 1 AS pos, domain, http_active, http_status FROM {SCAN} s",
        "host_domains": f"""WITH hosts AS (
              SELECT 'customer' AS kind, c_custkey AS id, CASE c_custkey % 6 WHEN 0 THEN 'S' || k || '.uk' WHEN 1 THEN 'www.s' || k || '.uk' WHEN 2 THEN 'a.b.s' || k || '.uk.' WHEN 3 THEN 'xs' || k || '.uk'
                WHEN 4 THEN 'b.s' || k || '.uk' ELSE 'uk' END AS host FROM (SELECT c_custkey, c_custkey % 400 AS k FROM customer) c
              UNION ALL SELECT 'page', page_id, {oracles.HOST} FROM pages
            ), listed AS (
              SELECT 's' || s_suppkey || '.uk' AS d FROM supplier UNION SELECT 'b.s' || s_suppkey || '.uk' FROM supplier WHERE s_suppkey % 3 = 0 UNION SELECT 'com' FROM supplier WHERE s_suppkey % 5 = 0
            ), plain AS (
              SELECT DISTINCT host, rtrim(lower(host), '.') AS h FROM hosts
            ), met AS (
              SELECT p.host, arg_max(d, length(d)) AS matched FROM plain p JOIN listed l ON p.h = d OR ends_with(p.h, '.' || d) GROUP BY p.host
            )
            SELECT kind, id, host, matched FROM hosts LEFT JOIN met USING (host)""",
        "stored_upsert": oracles.oracle_sql()["registry_upsert"],
    }
