"""DuckDB SQL of the queries of ``census`` and of the names in texts: computed from the planted rows and the documents."""

from __future__ import annotations

from ..functions import fixed, pages
from . import census, views
from .oracles import IDENTITY
from .views import values_sql

_AUTHORITY = "'^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*'"


def _key(url: str) -> str:
    rest = f"regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1)"
    origin = f"regexp_replace(lower(regexp_extract({url}, {_AUTHORITY})), '^(https://.*):443$', '\\1')"
    return f"{origin} || CASE WHEN starts_with({rest}, '/') THEN {rest} ELSE '/' || {rest} END"


def _host(url: str) -> str:
    return f"regexp_replace(lower(regexp_extract({url}, '^[A-Za-z]+://([^/?#]*)', 1)), ':[0-9]*$', '')"


def _own(column: str) -> str:
    return f"replace({column}, '{{n}}', c_custkey::VARCHAR) AS {column}"


_WORDS = IDENTITY.format(f"{_host('{0}')} || ' ' || coalesce(regexp_extract({{1}}, '<title>([^<]*)', 1), '')")

CENSUS = f"""WITH RECURSIVE given AS (SELECT 's' || c_custkey AS site, {_own('input_url')} FROM customer JOIN {values_sql(census.GIVEN, 'kind, input_url')} g ON kind = c_custkey % 8),
 planted AS (SELECT {_own('url')}, status, {_own('final_url')}, {_own('body')}, error FROM customer JOIN {values_sql(census.PLANTED, census.PLANTED_COLUMNS)} p ON kind = c_custkey % 8),
 fetched AS (SELECT {_key('url')} AS asked, status, coalesce(final_url, url) AS landed, body, error FROM planted),
 keyed AS (SELECT key, landed, body FROM (SELECT unnest([asked, {_key('landed')}]) AS key, * FROM fetched WHERE body <> '') f QUALIFY row_number() OVER (PARTITION BY key ORDER BY asked <> key) = 1),
 wanted AS (SELECT *, CASE WHEN contains(input_url, '://') THEN input_url ELSE 'https://' || input_url END AS url FROM given),
 root AS (SELECT site, input_url, coalesce(landed, url) AS website, coalesce(status, 0) AS status, CASE WHEN landed IS NULL THEN 'not fetched' ELSE error END AS error, body,
   coalesce(contains(body, 'domain is parked'), false) AS hosting FROM wanted LEFT JOIN fetched ON asked = {_key('url')}),
 hrefs AS (SELECT key, landed, unnest(regexp_extract_all(body, 'href="([^"]*)"', 1)) AS href, generate_subscripts(regexp_extract_all(body, 'href="([^"]*)"', 1), 1) AS pos FROM keyed),
 links AS (SELECT key, pos, CASE WHEN starts_with(href, '/') THEN regexp_extract(landed, {_AUTHORITY}) || href ELSE href END AS target, landed FROM hrefs WHERE NOT starts_with(href, 'mailto:')),
 kinds AS (SELECT *, regexp_extract(target, '://[^/]*.*/(contact|jobs|vacancies|privacy|terms)(#|$)', 1) AS kind, {_host('target')} = {_host('landed')} AS inside,
   regexp_extract(target, '^https://jobs\\.lever\\.co/[^/?#]+') AS board FROM links),
 visited AS (SELECT site, {_key('website')} AS key, 0 AS depth, 0::BIGINT AS pos FROM root
   UNION SELECT v.site, {_key('target')}, depth + 1, k.pos FROM visited v JOIN kinds k ON k.key = v.key JOIN root r ON r.site = v.site WHERE kind <> '' AND inside AND NOT hosting),
 seen AS (SELECT v.site, v.key, min(depth) AS depth, min_by(v.pos, depth) AS pos, any_value(landed) AS landed, any_value(body) AS body FROM visited v JOIN keyed USING (key) GROUP BY ALL),
 merged AS (SELECT site, count(*)::INTEGER AS n_pages, max(nullif(regexp_extract(body, 'Baker[0-9]+ Foods Limited'), '')) AS company, bool_or(contains(lower(body), '<footer>copyright')) AS footer FROM seen GROUP BY site),
 mails AS (SELECT site, string_agg(mail, ', ' ORDER BY textual, depth, pos) AS email FROM (SELECT * FROM
   (SELECT site, depth, pos, 0 AS textual, unnest(regexp_extract_all(body, 'mailto:([^"]*)', 1)) AS mail FROM seen
    UNION ALL SELECT site, depth, pos, 1, unnest(regexp_extract_all(regexp_replace(body, '<[^>]*>', ' ', 'g'), '[a-z0-9]+@[a-z.]+')) FROM seen) m
   QUALIFY row_number() OVER (PARTITION BY site, lower(mail) ORDER BY textual, depth, m.pos) = 1) d GROUP BY site),
 found AS (SELECT s.site, kind, target, board, inside FROM seen s JOIN kinds k ON k.key = s.key WHERE kind <> '' AND (inside OR depth = 0)
   QUALIFY row_number() OVER (PARTITION BY s.site, kind ORDER BY depth, s.pos, k.pos) = 1),
 shown AS (SELECT site, max(target) FILTER (kind = 'contact') AS contact_page, max(target) FILTER (kind = 'jobs') AS careers_page, max(target) FILTER (kind = 'vacancies') AS vacancies_page,
   max(target) FILTER (kind = 'privacy') AS privacy_page, max(target) FILTER (kind = 'terms') AS terms_conditions_page FROM found WHERE board = '' GROUP BY site),
 outside AS (SELECT f.site, f.target, k.key, list_has_any({_WORDS.format('website', 'r.body')}, {_WORDS.format('f.target', 'k.body')}) AS accepted
   FROM found f JOIN root r USING (site) JOIN keyed k ON k.key = {_key('f.target')} WHERE kind IN ('jobs', 'vacancies') AND board = '' AND NOT inside AND NOT hosting),
 refused AS (SELECT site, o.target || ' > ' || string_agg(board, ',' ORDER BY pos) AS refused FROM outside o JOIN kinds k USING (key) WHERE NOT accepted AND board <> '' GROUP BY site, o.target),
 candidates AS (SELECT site, board, 'website' AS source FROM seen JOIN kinds USING (key) WHERE board <> '' UNION SELECT site, board, 'external_careers' FROM outside JOIN kinds USING (key) WHERE accepted AND board <> ''),
 tried AS (SELECT site, string_agg(board || ' ' || source || ' ' || coalesce(status, 0) || CASE WHEN status BETWEEN 200 AND 399 THEN '' ELSE ' HTTP ' || coalesce(status, 0) END, '; ') AS tried,
   max(board) FILTER (status BETWEEN 200 AND 399) AS ats_page FROM candidates LEFT JOIN fetched ON asked = {_key('board')} GROUP BY site)
 SELECT site, input_url, website, nullif(status, 0)::INTEGER AS http_status, NOT hosting AND (status BETWEEN 200 AND 399 OR status IN (401, 403)) AS active, hosting, coalesce(n_pages, 0)::INTEGER AS n_pages,
  company AS company_name, company AS limited_company, coalesce(email, '') AS email, contact_page, careers_page, vacancies_page, privacy_page, terms_conditions_page,
  CASE WHEN ats_page IS NOT NULL THEN 'lever' END AS ats_provider, ats_page, CASE WHEN status = 200 THEN ats_page IS NOT NULL END AS ats_traceable, coalesce(footer, false) AS footer_evidence, error, refused, tried
 FROM root LEFT JOIN merged USING (site) LEFT JOIN mails USING (site) LEFT JOIN shown USING (site) LEFT JOIN refused USING (site) LEFT JOIN tried USING (site)"""

#: The forms as the library has them; at both ends of a form a word begins or ends.
_FORM = r"(?i)\b(?:l\.?\s*t\.?\s*d\.?|limited|p\.?\s*l\.?\s*c\.?|l\.?\s*l\.?\s*p\.?|inc\.?|incorporated|corp\.?|corporation)\b"
_EDGES = "".join(sorted(set(pages.NAME_EDGES) - set(" \t\r\n"))).replace("'", "''")
_BREAKS = r".!?;:()\[\]{}<>©|,\"''“”‘’".replace('\\"', '"')
_CONTEXT = "[" + ", ".join(f"'{w}'" for w in sorted(fixed.LEGAL_CONTEXT_WORDS)) + "]"
_LEADS = "w <> '' AND (w[1] = upper(w[1]) AND w[1] <> lower(w[1]) OR regexp_full_match(w[1], '\\pN') OR upper(w) = w)"


def _legal_names(texts: str) -> str:
    return f"""WITH texts AS ({texts}),
 cut AS (SELECT site, regexp_extract_all(text, '{_FORM}') AS forms, regexp_split_to_array(text, '{_FORM}') AS parts FROM texts),
 each AS (SELECT site, i - 1 AS position, forms[i] AS form, regexp_replace(parts[i], '(?s)^.*[{_BREAKS}]', '') AS lead FROM (SELECT *, unnest(range(1, len(forms) + 1)) AS i FROM cut) c),
 worded AS (SELECT site, position, form, list_filter(regexp_split_to_array(lead, '\\s+'), lambda w: w <> '')[-{pages.LEGAL_REACH}:] AS words FROM each),
 judged AS (SELECT *, coalesce(list_position(list_transform(words, lambda w: NOT list_contains({_CONTEXT}, lower(w))), true), len(words) + 1) AS start,
   list_transform(list_append(words, trim(form, '{_EDGES} ')), lambda w: {_LEADS}) AS leads FROM worded),
 named AS (SELECT site, position, trim(regexp_replace(array_to_string(list_append(words[list_filter(range(start, len(words) + 1), lambda i: leads[i] OR NOT leads[i + 1])[1]:], form), ' '), '\\s+', ' ', 'g'), '{_EDGES} ') AS name
   FROM judged WHERE len(list_filter(range(start, len(words) + 1), lambda i: leads[i] OR NOT leads[i + 1])) > 0),
 counted AS (SELECT site, count(*) AS count, min(position) AS first, min_by(name, position) AS name FROM named
   WHERE contains(name, ' ') AND NOT contains(lower(name), 'not limited') AND NOT contains(lower(name), 'limited to') AND NOT contains(lower(name), 'limited liability') GROUP BY site, lower(name))
 SELECT site, rank::INTEGER AS rank, name, count FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY count DESC, first) AS rank FROM counted) r WHERE rank <= 25"""


def _custom_boards() -> str:
    feed, font, company, assets = ("'" + p.replace("'", "''") + "'" for p in fixed.CUSTOM_BOARD_PATTERNS)
    return f"""WITH seen AS (SELECT page_id, base, {_host('base')} AS host, coalesce(html, '') || replace(coalesce(loaded, ''), '{{n}}', page_id::VARCHAR) AS body
   FROM (SELECT *, {census.BASE} AS base FROM pages) p LEFT JOIN {values_sql(census.LOADED, 'kind, loaded')} l ON kind = page_id % 10),
 told AS (SELECT *, regexp_matches(body, {feed}, 'is') AS feed, regexp_matches(body, {font}, 'is') AS font, regexp_extract(body, {company}, 1, 'is') AS company, regexp_matches(body, {assets}, 'is') AS assets,
   regexp_extract(body, 'https?://(careers\\.[a-z0-9.-]+)/cookie-policy/?"', 1) AS parent FROM seen),
 teamtailor AS (SELECT page_id, 'teamtailor' AS provider, CASE WHEN parent <> '' THEN parent WHEN company <> '' AND NOT font THEN company ELSE host END AS identifier,
   CASE WHEN parent <> '' THEN 'https://' || parent || '/jobs' ELSE 'https://' || host || '/' END AS url, base AS raw_url
   FROM told WHERE host <> '' AND NOT suffix(host, '.teamtailor.com') AND contains(lower(body), 'teamtailor') AND feed AND (font OR company <> '' OR assets)),
 pinpoint AS (SELECT page_id, 'pinpoint' AS provider, host AS identifier, 'https://' || host || '/' AS url, base AS raw_url
   FROM told WHERE host <> '' AND NOT suffix(host, '.pinpointhq.com') AND contains(lower(body), 'pinpointhq') AND contains(lower(body), 'jobs.rss'))
 SELECT * FROM teamtailor UNION ALL SELECT * FROM pinpoint p WHERE NOT EXISTS (SELECT 1 FROM teamtailor t WHERE t.page_id = p.page_id AND lower(t.url) = lower(p.url))"""


TIMING = f"""WITH told AS (SELECT event_id, replace(started, '{{d}}', (1 + event_id % 7)::VARCHAR) AS started, event_id % 5 / 4.0 AS rate, event_id % 3 * 100 AS remaining
   FROM events JOIN {values_sql(census.STARTS, 'kind, started')} s ON kind = event_id % 8),
 timed AS (SELECT event_id, epoch_ms(TIMESTAMPTZ '{census.NOW}') AS base, CASE WHEN len(started) = 10 THEN started || 'T00:00:00Z' WHEN len(started) > 10 THEN started END AS full_start,
   CASE WHEN rate > 0 AND remaining > 0 THEN remaining / rate END AS eta FROM told)
 SELECT event_id, coalesce(greatest((base - epoch_ms(try_cast(full_start AS TIMESTAMPTZ))) / 1000.0, 0.0), 0.0)::DOUBLE AS elapsed_seconds, round(eta, 3)::DOUBLE AS eta_seconds,
  (base + floor(eta * 1000))::BIGINT AS eta_ms FROM timed"""

BATCH_NAMES = """WITH names AS (SELECT n_name AS name FROM nation UNION ALL SELECT c_name FROM customer)
 SELECT name, regexp_full_match(name, '[a-z][a-z0-9-]*') AND len(name) BETWEEN 3 AND 51 AS sound
 FROM (SELECT unnest([name, lower(name), regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), lower(name)[1:2], repeat(lower(name), 4)]) AS name FROM names) n"""


def oracle_sql() -> dict[str, str]:
    inline = f"SELECT 'd' || doc_id AS site, coalesce(text, '') AS text FROM documents UNION ALL SELECT * FROM {values_sql(views.LEGAL_TEXTS, 'site, text')} v"
    planted = f"SELECT 'd' || doc_id AS site, {census.NAMED_TEXT} AS text FROM documents"
    return {"site_census": CENSUS, "legal_form_names": _legal_names(inline), "document_names": _legal_names(planted), "custom_boards": _custom_boards(), "state_timing": TIMING, "batch_names": BATCH_NAMES}
