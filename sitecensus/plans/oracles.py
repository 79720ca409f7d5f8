"""DuckDB SQL of the queries that SQL can express, over the supplied tables and the inline rows of ``views``."""

from __future__ import annotations

from ..functions import fixed
from . import views
from .views import SCAN_SQL, SITES_SQL, TEXTS_SQL, values_sql

QUEUE = "(SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, lower(c_name) AS domain, count(*) OVER () AS total FROM customer)"
SCAN = f"({SCAN_SQL})"
LINES = values_sql(views.RESULT_LINES, "line, value")
#: The links of all pages, as seen from them, and the inline ones.
PAGE_HREFS = """(SELECT page_id, url, regexp_extract_all(html, '(?s)<a href="([^"]*)">', 1) AS hrefs FROM pages)"""
LINKS = f"""(SELECT 'p' || page_id AS site, (i - 1)::INTEGER AS pos, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || href ELSE href END AS url
  FROM (SELECT page_id, url, i, hrefs[i] AS href FROM (SELECT *, unnest(range(1, len(hrefs) + 1)) AS i FROM {PAGE_HREFS} a) b) c
  UNION ALL SELECT * FROM {values_sql(views.LINKS, "site, pos, url")} i)"""
CANDIDATES = f"(SELECT * FROM {values_sql(views.CANDIDATES, 'site, provider, identifier, url, raw_url, discovery, source_kind')} v UNION ALL {views.CUSTOMER_CANDIDATES})"
FETCHED = f"(SELECT * FROM {values_sql(views.FETCHED, 'url, status, final_url, body')} v UNION ALL {views.CUSTOMER_FETCHED})"
#: Providers of the planted boards, the part of a link that names the board, and the board's URL.
BOARD_RULES = values_sql(
    [
        ("bamboohr", r"^https://([a-z0-9-]+)\.bamboohr\.com/", "https://{}.bamboohr.com/"),
        ("lever", r"^https://jobs\.lever\.co/([^/?#]+)", "https://jobs.lever.co/{}"),
        ("greenhouse", r"^https://boards\.greenhouse\.io/([^/?#]+)", "https://boards.greenhouse.io/{}"),
        ("ashby", r"^https://jobs\.ashbyhq\.com/([^/?#]+)", "https://jobs.ashbyhq.com/{}"),
        ("recruitee", r"^https://([a-z0-9-]+)\.recruitee\.com/", "https://{}.recruitee.com/"),
        ("jobvite", r"^https://jobs\.jobvite\.com/([^/?#]+)", "https://jobs.jobvite.com/{}"),
    ],
    "provider, pattern, shape",
)


def _matched(links: str) -> str:
    """links (with a column link) with provider, identifier and url of the planted kinds of boards."""
    return f"""(SELECT l.*, b.provider, b.identifier, replace(b.shape, '{{}}', b.identifier) AS url FROM {links} l
      LEFT JOIN (SELECT DISTINCT l.link, r.provider, r.shape, regexp_extract(l.link, r.pattern, 1) AS identifier FROM {links} l JOIN {BOARD_RULES} r ON regexp_matches(l.link, r.pattern)) b
      ON b.link = l.link AND b.identifier <> 'www')"""


RECORDS = f"""(SELECT pos, machine, domain AS input_url, http_active AS active, error, http_status, CASE WHEN http_status = 200 THEN pos % 3 = 0 END AS ats_traceable,
  pos % 4 = 0 OR pos % 5 = 1 AS has_email, pos % 3 = 0 AS has_number, pos % 6 IN (0, 2) AS has_careers,
  CASE pos % 4 WHEN 0 THEN 'wix' WHEN 1 THEN 'shopify' WHEN 2 THEN 'other' END AS website_platform FROM {SCAN} s)"""
COUNTERS = f"""(SELECT machine, count(*) AS processed, count(*) FILTER (active) AS active, count(*) FILTER (NOT active) AS inactive, count(error) AS errors,
  count(*) FILTER (ats_traceable) AS ats_traceable, count(*) FILTER (has_email) AS has_email, count(*) FILTER (has_number) AS company_number,
  count(*) FILTER (has_careers) AS careers_page, max_by(input_url, pos) AS last_domain FROM {RECORDS} r GROUP BY machine)"""
STATES = f"""(SELECT *, machine <> 'm3' AS available, CASE WHEN machine = 'm1' THEN 'running' ELSE 'complete' END AS status, processed + 10 AS total, 10::BIGINT AS remaining,
  processed / 100.0::DOUBLE AS rate_per_second, '2026-01-0' || machine[2:] || 'T00:00:00Z' AS started_at, processed AS expected FROM {COUNTERS} c)"""

EMAIL = "(?i)[a-z0-9.!#$%&''*+/=?^_{|}~-]+@[a-z0-9-]+(?:\\.[a-z0-9-]+)+"
POSTCODE = "[A-Za-z]{1,2}[0-9][A-Za-z0-9]?[\\t\\n\\f\\r ]?[0-9][A-Za-z]{2}"
NUMBER = (
    "(?i)(?:company|companies house|registered|registration)[\\t\\n\\f\\r ]*(?:number|no|registration|details)?[\\t\\n\\f\\r ]*[:#-]?[\\t\\n\\f\\r ]*"
    "((?:[a-z]{2}[\\t\\n\\f\\r ]*)?[0-9]{6,8})\\b"
)


def _listed(values: list[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _any(column: str, markers: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '" + m.replace("'", "''") + "')" for m in markers) + ")"


def _numbered(source: str, value: str, column: str) -> str:
    """Elements of the list ``value`` of each row of source, numbered from 0."""
    return f"SELECT doc_id, (n - 1)::INTEGER AS n, l[n] AS {column} FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS n FROM (SELECT doc_id, {value} AS l FROM {source} x) y) z"


def _clean_phone(x: str) -> str:
    bare = f"regexp_replace({x}, '[\\t\\n\\f\\r ().-]', '', 'g')"
    return f"regexp_replace(regexp_replace(regexp_replace({bare}, '^\\+440+', '+44'), '^00440+', '+44'), '^0044', '+44')"


def _emails() -> str:
    bare = "regexp_replace(x, '^[ \\t\\r\\n.,;:!?/\\\\)\\]}-]+|[ \\t\\r\\n.,;:!?/\\\\)\\]}-]+$', '', 'g')"
    junk = f"(contains(lower(x), 'example') OR lower(x) IN {_listed(fixed.JUNK_EMAILS)} OR split_part(lower(x), '@', 2) IN {_listed(fixed.JUNK_EMAIL_DOMAINS)})"
    found = f"list_filter(list_transform(regexp_extract_all(text, '{EMAIL}'), lambda x: {bare}), lambda x: regexp_matches(x, '{EMAIL}') AND NOT {junk})"
    first = f"(SELECT doc_id, f AS found FROM (SELECT doc_id, {found} AS f FROM {TEXTS_SQL} t) u)"
    fold = "list_filter(found, lambda x, i: list_position(list_transform(found, lambda y: lower(y)), lower(x)) = i)"
    return _numbered(first, fold, "email")


def _phones() -> str:
    found = f"list_transform(regexp_extract_all(text, '(?:\\+44|0)(?:[\\t\\n\\f\\r ]*[0-9]){{9,10}}'), lambda x: {_clean_phone('x')})"
    valid = f"list_filter({found}, lambda x: regexp_matches(x, '^(\\+44|0)[1235789][0-9]{{8,9}}$'))"
    return _numbered(TEXTS_SQL, f"list_sort(list_distinct({valid}))", "phone")


def _first_seen(value: str) -> str:
    return f"list_filter({value}, lambda x, i: list_position({value}, x) = i)"


def _postcodes() -> str:
    labelled = f"regexp_extract_all(text, '(?i)post[\\t\\n\\f\\r ]*code[:\\t\\n\\f\\r ]*({POSTCODE})', 1)"
    every = f"list_concat({labelled}, regexp_extract_all(text, '{POSTCODE}'))"
    source = f"(SELECT doc_id, list_transform({every}, lambda x: upper(regexp_replace(x, '[\\t\\n\\f\\r ]', '', 'g'))) AS l0 FROM {TEXTS_SQL} t)"
    return _numbered(source, f"{_first_seen('l0')}[1:25]", "postcode")


def _numbers() -> str:
    source = f"(SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '{NUMBER}', 1), lambda x: replace(upper(x), ' ', '')), lambda x: strlen(x) BETWEEN 8 AND 10) AS l0 FROM {TEXTS_SQL} t)"
    return _numbered(source, f"{_first_seen('l0')}[1:25]", "number")


def _language() -> str:
    count = lambda c: f"len(regexp_extract_all(s, '{c}'))"
    total = count("[A-Za-z\\x{0400}-\\x{04FF}\\x{4E00}-\\x{9FFF}\\x{0600}-\\x{06FF}]")
    kind = " ".join(f"WHEN {count(c)} / {total} > 0.10 THEN '{name}'" for name, c in (("ZH", "[\\x{4E00}-\\x{9FFF}]"), ("RU", "[\\x{0400}-\\x{04FF}]"), ("AR", "[\\x{0600}-\\x{06FF}]")))
    # the longest prefix of 5000 bytes: the running sizes of the characters say where it ends
    cut = "CASE WHEN strlen(text) <= 5000 THEN text ELSE text[:(SELECT max(i) FROM (SELECT unnest(range(1, 5001)) AS i) WHERE strlen(text[:i]) <= 5000)] END"
    return f"SELECT doc_id, CASE WHEN strlen(text) < 50 OR {total} = 0 THEN NULL {kind} WHEN text IS NOT NULL THEN 'EN' END AS language FROM (SELECT doc_id, text, {cut} AS s FROM {TEXTS_SQL} t) u"


def _decoded(html: str) -> str:
    """The references that the supplied pages have."""
    return f"replace(replace(replace(replace({html}, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&amp;', '&')"


def _squeezed(text: str) -> str:
    return f"trim(regexp_replace({text}, '[\\t\\n\\f\\r ]+', ' ', 'g'))"


TITLE = "trim(" + _decoded("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)") + ")"
FOOTER = _squeezed(_decoded("regexp_replace(regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1), '<[^>]*>', ' ', 'g')"))
HEADING = _squeezed(_decoded("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))
ANCHOR_HREFS = "list_transform(regexp_extract_all(html, '(?s)<a href=\"([^\"]*)\">(.*?)</a>', 1), lambda h: " + _decoded("h") + ")"
HOST = "lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)', 1), ':[0-9]*$', ''))"
PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


def _hosting() -> str:
    low = _decoded("lower(html)")
    broker = " OR ".join(f"ends_with('.' || regexp_replace(host, '^www\\.', ''), '.{b}')" for b in fixed.BROKER_HOSTS)
    return f"""SELECT page_id, regexp_matches(path, '(?i)(^|/)(lander|parking|parked|domain-for-sale)(/|$)') OR regexp_matches(host, '^ww[0-9]+\\.') OR {broker}
      OR {_any('low', fixed.PARKING_MARKERS)} OR (contains(low, 'godaddy') AND {_any('low', ['lander', 'parking', 'expired', 'renew'])})
      OR regexp_matches(low, '(window\\.)?location(\\.href)?\\s*=\\s*["'']/?(lander|parking|domain([-_ ]for[-_ ]sale)?)([/\\s''"?]|$)')
      OR regexp_matches(low, 'location\\.replace\\(\\s*["'']/?(lander|parking|domain)([/\\s''"?]|$)') AS hosting
    FROM (SELECT page_id, {HOST} AS host, {PATH} AS path, {low} AS low FROM {SITES_SQL} s) t"""


def _platform_scores() -> str:
    parts = []
    for platform in fixed.PLATFORMS:
        points = []
        for name, n, markers in fixed.PLATFORM_MARKERS:
            if name == platform:
                points.append(f"CASE WHEN {_any('low', markers)} THEN {n} ELSE 0 END")
        for name, n, markers in fixed.PLATFORM_ALL_OF:
            if name == platform:
                points.append(f"CASE WHEN {_any('low', markers).replace(' OR ', ' AND ')} THEN {n} ELSE 0 END")
        for name, n, pattern in fixed.PLATFORM_PATTERNS:
            if name == platform:
                points.append(f"CASE WHEN regexp_matches(low, '{pattern.replace(chr(39), chr(39) * 2)}') THEN {n} ELSE 0 END")
        parts.append(f"SELECT page_id, '{platform}' AS platform, ({' + '.join(points)})::INTEGER AS score FROM p")
    return f"WITH p AS (SELECT page_id, {_decoded('lower(html)')} AS low FROM {SITES_SQL} s), scores AS ({' UNION ALL '.join(parts)}) "


def _links(kinds: dict[str, str]) -> str:
    scored = []
    for kind, words in kinds.items():
        bare = [w.lstrip("/") for w in words.split()]
        score = " + ".join(f"CASE WHEN ends_with(path, '/{w}') THEN 10 WHEN contains(path, '{w}') THEN 2 ELSE 0 END" for w in bare)
        archive = " + ".join(f"CASE WHEN contains(path, '{s}') THEN 100 ELSE 0 END" for s in fixed.ARCHIVE_SLUGS)
        scored.append(f"SELECT site, pos, url, '{kind}' AS kind, {score} - least(5, len(path) - len(replace(path, '/', ''))) - ({archive}) AS score FROM l WHERE {_any('path', bare)}")
    return f"""WITH l AS (SELECT site, pos, url, regexp_replace(lower({PATH}), '/+$', '') AS path FROM {LINKS} x), s AS ({' UNION ALL '.join(scored)})
    SELECT site, kind, url FROM (SELECT *, row_number() OVER (PARTITION BY site, kind ORDER BY score DESC, strlen(url), pos) AS r FROM s) t WHERE r = 1"""


def _social() -> str:
    hits = " UNION ALL ".join(
        f"SELECT site, pos, url, '{name}' AS network FROM l WHERE " + " OR ".join(f"ends_with('.' || host, '.{d}')" for d in domains) for name, domains in fixed.SOCIAL_DOMAINS.items()
    )
    return f"WITH l AS (SELECT site, pos, url, {HOST} AS host FROM {LINKS} x), h AS ({hits}) SELECT site, network, min_by(url, pos) AS url FROM h GROUP BY site, network"


def _page_kind() -> str:
    return "CASE " + " ".join(f"WHEN {_any('lower(url)', words.split())} THEN '{kind}'" for kind, words in fixed.PAGE_KINDS.items()) + " ELSE 'website' END"


VERIFIED = f"""(SELECT c.*, coalesce(f.status, 0)::INTEGER AS http_status,
   CASE c.provider
     WHEN 'bamboohr' THEN CASE WHEN NOT (f.status BETWEEN 200 AND 399 AND {HOST.replace('url', 'f.final_url')} = {HOST.replace('url', 'c.url')}) OR f.status IS NULL THEN 'BambooHR careers endpoint unavailable or redirected' END
     WHEN 'ashby' THEN CASE WHEN f.status IS NULL OR f.status NOT BETWEEN 200 AND 399 OR coalesce(json_type(f.body, '$.jobs'), '') <> 'ARRAY' THEN 'Ashby posting API unavailable' END
     WHEN 'greenhouse' THEN CASE WHEN f.status IS NULL OR f.status NOT BETWEEN 200 AND 399 OR coalesce(json_type(f.body, '$.jobs'), '') <> 'ARRAY' THEN 'Greenhouse jobs API unavailable' END
     ELSE CASE WHEN coalesce(f.status, 0) NOT BETWEEN 200 AND 399 THEN 'HTTP ' || coalesce(f.status, 0) END END AS error
  FROM {CANDIDATES} c LEFT JOIN {FETCHED} f ON f.url = CASE c.provider
     WHEN 'bamboohr' THEN 'https://' || {HOST.replace('url', 'c.url')} || '/careers/list'
     WHEN 'ashby' THEN 'https://api.ashbyhq.com/posting-api/job-board/' || split_part(c.url, '/', -1)
     WHEN 'greenhouse' THEN 'https://boards-api.greenhouse.io/v1/boards/' || split_part(c.url, '/', -1) || '/jobs' ELSE c.url END)"""

def _fetch_choice() -> str:
    made = values_sql([(i, *a) for i, a in enumerate(views.ANSWERS)], "place, kind, via, n, status, body, error")
    request = "CASE WHEN via = 'plain' THEN 'http' ELSE 'https' END || '://c' || c_custkey || '.uk'"
    tries = f"""(SELECT * FROM {values_sql(views.TRIES, "url, seq, via, status, final_url, body, error")} v
      UNION ALL SELECT 'https://c' || c_custkey || '.uk', place, via, status, CASE WHEN status <> 0 THEN {request} || '/' END, body, error FROM customer JOIN {made} a ON a.kind = c_custkey % 8)"""
    retry = f"coalesce({_any('lower(error)', fixed.RETRY_MARKERS)}, false)"
    down = f"{_any('lower(d.error)', fixed.DOWNGRADE_MARKERS)} AND NOT {_any('lower(d.error)', fixed.NAME_ERROR_MARKERS)}"
    fields = ["via", "status", "final_url", "body", "error"]
    plain = f"coalesce({down} AND p.via IS NOT NULL AND (coalesce(p.status, 0) <> 0 OR p.error IS NULL), false)"
    chosen = ", ".join(f"CASE WHEN {plain} THEN p.{c} ELSE d.{c} END AS {c}" for c in fields)
    poor = "(r.error IS NOT NULL OR coalesce(r.status, 0) IN (202, 403, 429, 503) OR trim(coalesce(r.body, '')) = '')"
    better = "(b.via IS NOT NULL AND (b.error IS NULL OR coalesce(b.body, '') <> ''))"
    result = ", ".join(f"CASE WHEN {poor} AND {better} THEN b.{c} ELSE r.{c} END AS {c}" for c in fields)
    return f"""WITH t AS (SELECT *, {retry} AS again FROM {tries} x),
      d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY again, CASE WHEN again THEN -seq ELSE seq END) AS n FROM t WHERE via = 'direct') u WHERE n = 1),
      p AS (SELECT * FROM t WHERE via = 'plain'), b AS (SELECT * FROM t WHERE via = 'browser'),
      r AS (SELECT d.url, {chosen} FROM d LEFT JOIN p ON p.url = d.url)
      SELECT r.url, {result}, (SELECT count(*) FROM t WHERE t.url = r.url) AS tries FROM r LEFT JOIN b ON b.url = r.url"""


IDENTITY = "list_filter(regexp_extract_all(lower({0}), '[a-z0-9]+'), lambda x: len(x) >= 3 AND x NOT IN " + _listed(fixed.IDENTITY_STOP_WORDS) + ")"

# a queue visited step by step: the state of a site is its visited pages, its queue and the kinds that it has
CRAWL = """
WITH RECURSIVE links AS (SELECT page_id AS src, k, 'k' || ((page_id + k) % 7) AS kind, 'p' || (page_id * 3 + k) AS target FROM pages, (SELECT unnest([1, 2, 3]) AS k)),
outs AS (SELECT 'p' || src AS url, list({'kind': kind, 'url': target} ORDER BY k) AS out FROM links GROUP BY src),
step AS (
  SELECT page_id AS site, ['p' || page_id] AS visited, ['website'] AS labels, [{'kind': '', 'url': ''}][:0] AS queue, ['']::VARCHAR[] AS kinds, 'p' || page_id AS at FROM pages 
  UNION ALL
  SELECT site, CASE WHEN len(rest) > 0 THEN list_append(visited, rest[1].url) ELSE visited END, CASE WHEN len(rest) > 0 THEN list_append(labels, rest[1].kind) ELSE labels END,
         rest, kinds2, CASE WHEN len(rest) > 0 THEN rest[1].url END
  FROM (SELECT site, visited, labels, list_concat(kinds, list_transform(fresh, lambda x: x.kind)) AS kinds2,
               list_filter(list_concat(queue, fresh), lambda x: NOT list_contains(visited, x.url)) AS rest
        FROM (SELECT s.*, list_filter(coalesce(o.out, [{'kind': '', 'url': ''}][:0]), lambda x: NOT list_contains(s.kinds, x.kind)) AS fresh
              FROM step s LEFT JOIN outs o ON o.url = s.at WHERE s.at IS NOT NULL AND len(s.visited) < 8) a) b
), last AS (SELECT site, max_by(visited, len(visited)) AS visited, max_by(labels, len(visited)) AS labels FROM step GROUP BY site)
SELECT site, (i - 1)::INTEGER AS visit, visited[i] AS url, labels[i] AS label FROM (SELECT *, unnest(range(1, len(visited) + 1)) AS i FROM last) t
"""


def oracle_sql() -> dict[str, str]:
    return {
        "split_contiguous": f"SELECT pos, domain, least(pos // greatest(1, ((total + 6) // 7)), 6)::INTEGER AS part FROM {QUEUE} q",
        "split_balanced": "SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, lower(c_name) AS domain, (ntile(7) OVER (ORDER BY c_custkey) - 1)::INTEGER AS part FROM customer",
        "assign_zones": "SELECT pos, n_name, ['zone-a', 'zone-b', 'zone-c', 'zone-d'][pos // 8 + 1] AS zone FROM (SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS pos, n_name FROM nation) n",
        "queue_tail": f"SELECT pos, domain FROM {QUEUE} q WHERE pos >= total - 100",
        "queue_head": f"SELECT pos, domain FROM {QUEUE} q WHERE pos < total - 100",
        "resume_anti_join": "SELECT o_orderkey AS domain, o_orderpriority AS label FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
        "resume_positional": f"SELECT pos, domain FROM {QUEUE} q WHERE pos >= 40",
        "merge_active_list": f"SELECT DISTINCT domain FROM {SCAN} s WHERE http_active",
        "merge_inactive_list": f"SELECT DISTINCT domain FROM {SCAN} s WHERE NOT http_active",
        "merge_summary": f"""SELECT count(*) AS tested, count(*) FILTER (dns_active) AS dns_active, count(*) FILTER (http_active) AS http_active, count(*) FILTER (NOT http_active) AS inactive,
            round(avg(response_ms), 6) AS average_response_ms, (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM (SELECT http_status::VARCHAR AS k, count(*) AS n FROM {SCAN} t WHERE http_status IS NOT NULL GROUP BY 1) u) AS status_counts FROM {SCAN} s""",
        "merge_status_counts": f"SELECT http_status::VARCHAR AS status, count(*) AS n FROM {SCAN} s WHERE http_status IS NOT NULL GROUP BY 1",
        "http_active_flags": f"SELECT pos, coalesce(http_status BETWEEN 200 AND 399 OR http_status IN (401, 403), false) AS site_active, coalesce(http_status BETWEEN 200 AND 399, false) AS board_live FROM {SCAN} s",
        "retry_candidates": f"""SELECT pos, domain, coalesce(error = 'connection refused', false) AS fetch_retry, CASE WHEN error = 'connection refused' THEN 'http://' || domain || '/x' END AS downgrade
            FROM {SCAN} s WHERE NOT dns_active OR http_status IS NULL OR http_status IN (408, 425, 429) OR http_status >= 500""",
        "run_state_counters": f"SELECT * FROM {COUNTERS} c",
        "platform_histogram_zero_filled": f"""SELECT p.platform, count(*) FILTER (r.pos % 4 = 0 AND p.platform IN ('wix', 'wordpress') OR r.pos % 4 = 1 AND p.platform = 'shopify') AS n_any,
            count(*) FILTER (r.website_platform = p.platform) AS n_primary FROM (SELECT unnest({fixed.PLATFORMS}) AS platform) p CROSS JOIN {RECORDS} r GROUP BY p.platform""",
        "combined_rollup": f"""SELECT bool_or(available) AS available, CASE WHEN bool_and(status = 'complete') FILTER (available) THEN 'complete' ELSE 'running' END AS status,
            sum(total) FILTER (available)::BIGINT AS total, sum(processed) FILTER (available)::BIGINT AS processed, sum(remaining) FILTER (available)::BIGINT AS remaining,
            sum(active) FILTER (available)::BIGINT AS active, sum(inactive) FILTER (available)::BIGINT AS inactive, sum(errors) FILTER (available)::BIGINT AS errors,
            round(sum(rate_per_second) FILTER (available), 6) AS rate_per_second, min(started_at) AS started_at,
            round(sum(remaining) FILTER (available) / sum(rate_per_second) FILTER (available), 6) AS eta_seconds FROM {STATES} s""",
        "combined_status_counts": f"SELECT coalesce(http_status::VARCHAR, 'none') AS key, count(*) AS n FROM {SCAN} s WHERE machine <> 'm3' GROUP BY 1",
        "throughput_eta": f"""SELECT machine, processed, total, seconds, remaining, round(rate, 6) AS rate_per_second, round(remaining / rate, 6) AS eta_seconds
            FROM (SELECT machine, processed, total, remaining, machine[2:]::DOUBLE * 10 AS seconds, processed / greatest(machine[2:]::DOUBLE * 10, 0.001) AS rate FROM {STATES} s) t""",
        "shard_completion": f"SELECT count(*) AS shards, bool_and(status = 'complete' AND processed = expected) AS complete, sum(processed)::BIGINT AS processed, sum(expected)::BIGINT AS expected FROM {STATES} s",
        "jsonl_permissive_counts": f"SELECT count(*) FILTER (json_valid(value)) AS processed, count(*) FILTER (NOT json_valid(value)) AS errors FROM (SELECT value FROM {LINES} l UNION ALL SELECT props FROM events) m WHERE trim(value) <> ''",
        "jsonl_strict_decode": "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract(props, '$.n')::BIGINT AS n FROM events",
        "extract_emails": _emails(),
        "extract_phones": _phones(),
        "extract_postcodes": _postcodes(),
        "extract_company_numbers": _numbers(),
        "language_detect": _language(),
        "page_titles": f"SELECT page_id, {TITLE} AS title FROM pages",
        "page_headings": f"SELECT page_id, 0 AS n, {HEADING} AS heading FROM pages",
        "page_anchors": f"""SELECT page_id, (i - 1)::INTEGER AS n, {_decoded('hrefs[i]')} AS href, {_decoded('names[i]')} AS text FROM (SELECT *, unnest(range(1, len(hrefs) + 1)) AS i FROM (
            SELECT page_id, regexp_extract_all(html, '(?s)<a href="([^"]*)">(.*?)</a>', 1) AS hrefs, regexp_extract_all(html, '(?s)<a href="([^"]*)">(.*?)</a>', 2) AS names FROM pages) a) b""",
        "footer_text": f"SELECT page_id, {FOOTER} AS footer_text FROM pages",
        "page_links_best": _links(fixed.PAGE_LINKS),
        "social_links": _social(),
        "description_build": f"""SELECT page_id, nullif(concat_ws(' — ', nullif(t, ''), CASE WHEN f <> '' AND NOT contains(t, f) THEN f END), '') AS description
            FROM (SELECT page_id, {TITLE} AS t, {FOOTER} AS f FROM {SITES_SQL} s) u""",
        "hosting_detect": _hosting(),
        "content_active": f"""SELECT page_id, NOT ({_any('low', fixed.SALE_MARKERS)} OR (contains(low, '404 not found') AND size < 1500) OR (contains(low, '403 forbidden') AND size < 200))
            AND (size > 500 OR contains(low, '<img ') OR contains(low, '<a href')) AS active FROM (SELECT page_id, lower(html) AS low, strlen(html) AS size FROM {SITES_SQL} s) t""",
        "platform_scores": _platform_scores() + "SELECT * FROM scores WHERE score > 0",
        "website_platforms": _platform_scores()
        + f"SELECT p.page_id, coalesce(string_agg(s.platform, ',' ORDER BY s.score DESC, list_position({fixed.PLATFORMS}, s.platform)), '') AS platforms FROM p LEFT JOIN scores s ON s.page_id = p.page_id AND s.score >= 5 GROUP BY p.page_id",
        "board_verify": f"SELECT site, url, error IS NULL AS active, http_status, error FROM {VERIFIED} v",
        "board_best": f"""SELECT site, provider, identifier, url FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY (source_kind = 'website')::INTEGER, (discovery = 'raw')::INTEGER,
            len(list_filter(string_split({PATH}, '/'), lambda s: s <> '')), contains(raw_url, '?')::INTEGER, strlen(url), url) AS r FROM {VERIFIED} v WHERE error IS NULL) t WHERE r = 1""",
        "fetch_choice": _fetch_choice(),
        "identity_overlap": f"""SELECT page_id, array_to_string(list_sort(list_distinct(own)), ' ') AS tokens, list_has_any(own, {IDENTITY.format(PATH)}) AS overlap,
            list_has_any({IDENTITY.format(f"{HOST} || ' ' || {PATH}")}, {IDENTITY.format(f"{TITLE} || ' ' || {HEADING}")}) AS overlap_of_texts
            FROM (SELECT page_id, url, html, {IDENTITY.format(HOST)} AS own FROM pages) p""",
        "board_match": "SELECT n, link, provider, identifier, url FROM " + values_sql([(i, *b) for i, b in enumerate(views.BOARDS)], "n, link, provider, identifier, url") + f""" b
            UNION ALL SELECT n, link, provider, identifier, url FROM {_matched(f"(SELECT 1000 + c_custkey AS n, {views.board_link('c_custkey')} AS link FROM customer)")} c
            UNION ALL SELECT n, link, provider, identifier, url FROM {_matched(f"(SELECT -1 - page_id AS n, unnest(hrefs) AS link FROM {PAGE_HREFS} a)")} p""",
        "board_candidates": f"""SELECT 'p' || n AS site, 0 AS seq, 0 AS pos, provider, identifier, url, link AS raw_url, 'href' AS discovery, 'website' AS source_kind
            FROM {_matched(f"(SELECT page_id AS n, {views.board_link('page_id')} AS link FROM pages)")} p WHERE provider IS NOT NULL""",
        "structured_data": "SELECT site, key, (row_number() OVER (PARTITION BY site, key ORDER BY place) - 1)::INTEGER AS n, value FROM " + values_sql([(i, *f) for i, f in enumerate(views.STRUCTURED_FACTS)], "place, site, key, value") + " f",
        "url_functions": f"""SELECT page_id, {HOST} AS host, {_page_kind()} AS kind, regexp_replace(regexp_replace(url, '^(https://[^/?#]*):443($|[/?#])', '\\1\\2'), '^(http://[^/?#]*):80($|[/?#])', '\\1\\2') AS bare,
            CASE WHEN ends_with({HOST}, '.uk') THEN 'GB' END AS location FROM {SITES_SQL} s""",
        "crawl_bfs": CRAWL,
        "registry_upsert": """WITH fresh AS (SELECT s_suppkey * 2 AS key, s_name || ' (new)' AS label FROM supplier)
            SELECT s_suppkey AS key, s_name AS label FROM supplier WHERE s_suppkey NOT IN (SELECT key FROM fresh) UNION ALL SELECT * FROM fresh""",
        "checksum_rows": "SELECT s_suppkey, sha256(s_suppkey || '|' || s_name) AS sha256 FROM supplier",
        "stream_state": f"SELECT coalesce(http_status::VARCHAR, 'none') AS status, count(*) AS processed, count(*) FILTER (http_active) AS active, count(error) AS errors FROM {SCAN} s GROUP BY 1",
    }
