"""Tables that the queries read: derived views of the supplied tables, and small inline ones.

Each view's columns are SQL that both Spark and DuckDB read alike, so that the queries and their oracles start from the
same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: One result of a domain scan for each event.
SCAN_COLUMNS = {
    "pos": "event_id",
    "machine": "concat('m', CAST(event_id % 4 AS STRING))",
    "domain": "concat('u', CAST(user_id AS STRING), '.co.uk')",
    "dns_active": "event_id % 10 <> 9",
    "http_status": "CAST(CASE WHEN event_id % 10 = 9 THEN NULL WHEN event_type = 'click' THEN 200 WHEN event_type = 'view' THEN 301 WHEN event_type = 'purchase' THEN 403 WHEN event_type = 'signup' THEN 404 END AS INT)",
    "http_active": "event_id % 10 <> 9 AND event_type IN ('click', 'view', 'purchase')",
    "response_ms": "value",
    "error": "CASE WHEN event_id % 10 = 9 THEN 'no such host' WHEN event_type = 'error' THEN 'connection refused' END",
}
SCAN_SQL = "SELECT " + ", ".join(f"{x} AS {c}" for c, x in SCAN_COLUMNS.items()).replace("AS STRING", "AS VARCHAR") + " FROM events"

#: Contacts that the supplied texts do not have, with negative ids.
CONTACT_TEXTS = [
    (-1, "Write to Sales@Acme-Widgets.co.uk, sales@acme-widgets.co.uk or info@acme.org. Call 020 7946 0018 or +44 (0) 1632 960001."),
    (-2, "Tel: +441632960002 / 01632 960 003. Postcode: SW1A 1AA. Our office is at M1 1AE. Company number 01234567."),
    (-3, "Registered No: SC123456, registration number 12345678. test@test.com someone@mailinator.com x@example.com"),
    (-4, "Phones 00441632960004 and +4401632960005 and 0632960006. Companies House: 123456. Company No. AB 123456"),
    (-5, ""),
    (-6, None),
]
#: Pages with the marks of platforms and of parked domains: id, url, html.
MARKED_PAGES = [
    (-1, "https://acme.co.uk/", '<html><head><meta name="generator" content="WordPress 6.4"></head><body><img src="/wp-content/a.png"></body></html>'),
    (-2, "https://shop.example/", '<script src="https://cdn.shopify.com/s/a.js"></script><div id="shopify-section-header"></div>'),
    (-3, "https://site.example/", '<img src="https://static.wixstatic.com/a.png"><script src="wp-json"></script>'),
    (-4, "https://ww25.parked.example/", "<p>hello</p>"),
    (-5, "https://foo.sedoparking.com/x", "<p>hello</p>"),
    (-6, "https://plain.example/lander", "<p>hello</p>"),
    (-7, "https://sale.example/", "<h1>This domain is parked</h1>"),
    (-8, "https://jump.example/", "<script>window.location.href = '/lander?x=1'</script>"),
    (-9, "https://gone.example/", "<h1>404 Not Found</h1>"),
    (-10, "https://duda.example/", '<script src="/_dm/s/rt.js"></script><script>window.dmAPI.x()</script>'),
    (-11, "https://empty.example/", ""),
]
#: Links of two sites: site, pos, url.
LINKS = [
    ("a", 0, "https://a.example/blog/contact"), ("a", 1, "https://a.example/contact-us/"), ("a", 2, "https://a.example/about/contact"), ("a", 3, "https://a.example/careers/"),
    ("a", 4, "https://a.example/jobs"), ("a", 5, "https://www.facebook.com/a"), ("a", 6, "https://x.com/a"), ("a", 7, "https://twitter.com/a"), ("a", 8, "https://notx.com/a"),
    ("b", 0, "https://b.example/privacy-policy"), ("b", 1, "https://b.example/terms"), ("b", 2, "https://uk.linkedin.com/b"), ("b", 3, "https://b.example/news/join"), ("b", 4, "https://b.example/legal"),
]
LEGAL_TEXTS = [
    ("a", "Operated by Acme Widgets Limited. © Acme Widgets Ltd. Terms of Acme Widgets Limited, including but not limited to this. Acme Widgets Limited is here"),
    ("b", "Northern Foods plc | Northern Foods PLC; our partners Blue Sky Holdings Inc. and Blue Sky Holdings Inc"),
    ("c", "nothing here"),
]
#: Links of boards and of none: link, provider, identifier, canonical URL.
BOARDS = [
    ('HTTPS://Apply.Workable.com/northwind-bakers/', 'workable', 'northwind-bakers', 'https://apply.workable.com/northwind-bakers'),
    ('https://larkfield.workable.com/view?dept=2', 'workable', 'larkfield', 'https://larkfield.workable.com/'),
    ('https://boards.eu.greenhouse.io/Tidewater/jobs/99?gh_jid=99', 'greenhouse', 'Tidewater', 'https://boards.eu.greenhouse.io/Tidewater'),
    ('https://job-boards.greenhouse.io/embed/job_board?for=copperline&b=1', 'greenhouse', 'copperline', 'https://job-boards.greenhouse.io/copperline'),
    ('https://jobs.eu.lever.co/Oakhurst/1b2c/apply', 'lever', 'Oakhurst', 'https://jobs.eu.lever.co/Oakhurst'),
    ('https://api.lever.co/v0/postings/brightsea?mode=json', 'lever', 'brightsea', 'https://jobs.lever.co/brightsea'),
    ('https://jobs.smartrecruiters.com/HarbourGroup/743-baker', 'smartrecruiters', 'HarbourGroup', 'https://jobs.smartrecruiters.com/HarbourGroup'),
    ('https://careers.smartrecruiters.com/NI/Moorgate', 'smartrecruiters', 'Moorgate', 'https://careers.smartrecruiters.com/Moorgate'),
    ('https://jobs.ashbyhq.com/fennelfoods/8a?utm=x#top', 'ashby', 'fennelfoods', 'https://jobs.ashbyhq.com/fennelfoods'),
    ('https://explore.jobs.netflix.net/careers/search', 'eightfold', 'careers/search', 'https://explore.jobs.netflix.net/careers/search'),
    ('https://quarry.teamtailor.com/departments/3', 'teamtailor', 'quarry', 'https://quarry.teamtailor.com/'),
    ('https://jobs.jobvite.com/stonebridge/job/o1', 'jobvite', 'stonebridge', 'https://jobs.jobvite.com/stonebridge'),
    ('https://ats.rippling.com/de-de/Pinehill/jobs/7', 'rippling', 'pinehill', 'https://ats.rippling.com/Pinehill'),
    ('https://wren.wd3.myworkdayjobs.com/en-GB/Wren_Careers/job/Leeds/Cook_R1', 'workday_cxs', 'wren.wd3', 'https://wren.wd3.myworkdayjobs.com/en-GB/Wren_Careers'),
    ('https://tern.wd1.myworkdayjobs.com/External', 'workday_cxs', 'tern.wd1', 'https://tern.wd1.myworkdayjobs.com/External'),
    ('https://recruiting.paylocity.com/Recruiting/Jobs/List/4711/extra', 'paylocity', 'list/4711', 'https://recruiting.paylocity.com/Recruiting/Jobs/List/4711/extra'),
    ('https://recruiting.ultipro.com/GLE1001/JobBoard/77-a/Opportunity', 'ultipro', 'gle1001/77-a', 'https://recruiting.ultipro.com/GLE1001/JobBoard/77-a/Opportunity'),
    ('https://gannet.bamboohr.com/jobs/view.php?id=4', 'bamboohr', 'gannet', 'https://gannet.bamboohr.com/'),
    ('https://plover-group.pinpointhq.com/en/postings/12', 'pinpoint', 'plover-group', 'https://plover-group.pinpointhq.com/'),
    ('https://sandpiper.recruitee.com/o/chef', 'recruitee', 'sandpiper', 'https://sandpiper.recruitee.com/'),
    ('https://dunlin.breezy.hr/p/1-chef', 'breezy', 'dunlin', 'https://dunlin.breezy.hr/'),
    ('https://knot.careers.hibob.com/jobs/3', 'hibob', 'knot', 'https://knot.careers.hibob.com/'),
    ('https://curlew.livevacancies.co.uk/#/', 'hireful', 'curlew', 'https://curlew.livevacancies.co.uk/'),
    ('https://avocet-gmbh.jobs.personio.de/job/12?language=de', 'personio', 'avocet-gmbh', 'https://avocet-gmbh.jobs.personio.de/'),
    ('https://beta.jobs.nhs.uk/candidate/search/results?keyword=nurse&page=2', 'nhs_jobs', 'candidate', 'https://beta.jobs.nhs.uk/candidate/search/results?keyword=nurse&page=2'),
    ('https://turnstone.avature.net/en_GB/careers/Home', 'avature', 'turnstone/en_GB/careers', 'https://turnstone.avature.net/en_GB/careers/Home'),
    ('https://www.employmenthero.com/jobs/organisations/Godwit-Ltd', 'employment_hero', 'godwit-ltd', 'https://www.employmenthero.com/jobs/organisations/Godwit-Ltd'),
    ('https://www.dayforcehcm.com/en/Phalarope/CORP/posting', 'dayforce', 'phalarope/corp', 'https://www.dayforcehcm.com/en/Phalarope/CORP/posting'),
    ('https://whimbrel.icims.com/jobs/intro?hashed=1', 'icims', 'whimbrel', 'https://whimbrel.icims.com/jobs/intro?hashed=1'),
    ('https://redshank.ciphr-irecruit.com/Applicants/vacancy/5', 'ciphr_irecruit', 'redshank', 'https://redshank.ciphr-irecruit.com/templates/CIPHR/job_list.aspx'),
    ('https://ruff.networxrecruitment.com/Jobs/Advert/7?cid=15', 'networx', 'cid:15', 'https://ruff.networxrecruitment.com/Jobs/Advert/7?cid=15'),
    ('https://siskin.softgarden.io/vacancies', 'softgarden', 'siskin', 'https://siskin.softgarden.io/vacancies'),
    ('https://linnet.hire.trakstar.com/jobs/8x', 'trakstar', 'linnet', 'https://linnet.hire.trakstar.com/jobs/8x'),
    ('https://www.careers-page.com/twite-and-sons/job/1', 'careers_page', 'twite-and-sons', 'https://www.careers-page.com/twite-and-sons/job/1'),
    ('https://brambling.talent-soft.com/accueil.aspx?lcid=2057', 'talent_soft', 'brambling', 'https://brambling.talent-soft.com/accueil.aspx?lcid=2057'),
    ('https://redpoll.ttcportals.com/jobs/new', 'ttcportals', 'redpoll', 'https://redpoll.ttcportals.com/jobs/new'),
    ('https://crossbill.schoolrecruiter.com/JobSeekers/login', 'schoolrecruiter', 'crossbill', 'https://crossbill.schoolrecruiter.com/JobSeekers/login'),
    ('https://api.greenhouse.io/v1', None, None, None),
    ('https://boards.greenhouse.io/embed', None, None, None),
    ('https://jobs.lever.co/Contact', None, None, None),
    ('https://apply.workable.com/j/ABC123', None, None, None),
    ('https://status.teamtailor.com/', None, None, None),
    ('https://jobs.nhs.uk/candidate/search', None, None, None),
    ('https://tenant.avature.net/de_DE/portal', None, None, None),
    ('https://www.avature.net/careers', None, None, None),
    ('https://shelduck.icims.com/connect', None, None, None),
    ('https://jobs.smartrecruiters.com/yellltd/1', None, None, None),
    ('tel:+441632960123', None, None, None),
    ('https://careers.example/jobs', None, None, None),
]
BOARD_PAGES = [
    ("a", 0, "https://jobs.harrier-foods.example/", '<p>Join us</p><link rel="alternate stylesheet" type="application/rss+xml" href="/en/jobs.rss"><link rel="stylesheet" href="https://assets-aws.teamtailor-cdn.com/v2/careersite-77ab.css"><a href="https://boards.greenhouse.io/embed/job_app?for=harrierfoods">Apply</a>', "website"),
    ("b", 0, "https://work.osprey-rail.example/uk", '<script>window.pinpointhq = {feed: "/uk/jobs.rss"}</script>', "website"),
    ("c", 0, "https://kestrel.example/", '<a href="//kestrel.bamboohr.com/careers">all roles</a><p>or see https://jobs.lever.co/kestrel/77-1, please</p>', "website"),
    ("c", 1, "https://kestrel.example/join", '<a href="https://Kestrel.BambooHR.com/jobs/?source=x">all roles</a>', "careers_page"),
]
#: Tries of fetches: url, seq, via, status, final_url, body, error.
TRIES = [
    ("https://a.uk", 0, "direct", 0, None, None, "read: connection reset"), ("https://a.uk", 1, "direct", 200, "https://a.uk/", "ok", None),
    ("https://b.uk", 0, "direct", 0, None, None, "remote error: tls: bad"), ("https://b.uk", 1, "direct", 0, None, None, "timeout"), ("https://b.uk", 2, "plain", 200, "http://b.uk/", "plain", None),
    ("https://c.uk", 0, "direct", 0, None, None, "tls: bad"), ("https://c.uk", 1, "plain", 200, "http://c.uk/", "plain", None),
    ("https://d.uk", 0, "direct", 403, "https://d.uk/", "no", None), ("https://d.uk", 1, "browser", 200, "https://d.uk/", "seen", None),
    ("https://e.uk", 0, "direct", 0, None, None, "no such host"), ("https://e.uk", 1, "plain", 200, "http://e.uk/", "x", None), ("https://e.uk", 2, "browser", 0, None, None, "closed"),
    ("https://f.uk", 0, "direct", 200, "https://f.uk/", "  ", None), ("https://f.uk", 1, "browser", 0, None, "part", "closed"),
]
#: What a server says, by the number in its name: kind, via, n, status, body, error.
ANSWERS = [
    (0, "direct", 0, 200, "ok", None),
    (1, "direct", 0, 0, None, "read: connection reset"), (1, "direct", 1, 200, "ok", None),
    (2, "direct", 0, 0, None, "remote error: tls: bad"), (2, "direct", 1, 0, None, "timeout: tls handshake"), (2, "plain", 0, 200, "plain", None),
    (3, "direct", 0, 0, None, "no such host"), (3, "browser", 0, 0, None, "closed"),
    (4, "direct", 0, 403, "no", None), (4, "browser", 0, 200, "seen", None),
    (5, "direct", 0, 0, None, "timeout"), (5, "direct", 1, 0, None, "timeout"), (5, "browser", 0, 0, "part", "closed"),
    (6, "direct", 0, 0, None, "connection refused"), (6, "direct", 1, 0, None, "connection refused"), (6, "plain", 0, 0, None, "connection refused"),
    (7, "direct", 0, 200, "  ", None), (7, "browser", 0, 200, "seen", None),
]


def board_link(key: str) -> str:
    """SQL of the link of a board (for two of eight keys: of none) that belongs to a key."""
    made = {0: "'https://c', {0}, '.bamboohr.com/jobs/view.php?id=', {0}", 1: "'https://jobs.lever.co/C', {0}, '/1b2c/apply'", 2: "'https://boards.greenhouse.io/C', {0}, '/jobs/9'", 3: "'https://jobs.ashbyhq.com/c', {0}, '/8a?utm=x'"}
    made |= {4: "'https://c', {0}, '.recruitee.com/o/chef'", 5: "'https://jobs.jobvite.com/c', {0}, '/job/o1'", 6: "'https://www.bamboohr.com/c', {0}", 7: "'https://careers.example/c', {0}"}
    return f"CASE {key} % 8 " + " ".join(f"WHEN {i} THEN concat({x.format(key)})" for i, x in made.items()) + " END"


#: Two candidates a customer: a list of jobs of its own, and a board that goes by the key.
CUSTOMER_CANDIDATES = """SELECT concat('s', c_custkey) AS site, 'bamboohr' AS provider, concat('c', c_custkey) AS identifier, concat('https://c', c_custkey, '.bamboohr.com/') AS url,
    concat('https://c', c_custkey, '.bamboohr.com/jobs/3') AS raw_url, 'href' AS discovery, 'website' AS source_kind FROM customer
  UNION ALL SELECT concat('s', c_custkey), CASE c_custkey % 3 WHEN 0 THEN 'greenhouse' WHEN 1 THEN 'ashby' ELSE 'recruitee' END, concat('c', c_custkey),
    CASE c_custkey % 3 WHEN 0 THEN concat('https://job-boards.greenhouse.io/c', c_custkey) WHEN 1 THEN concat('https://jobs.ashbyhq.com/c', c_custkey) ELSE concat('https://c', c_custkey, '.recruitee.com/') END,
    CASE c_custkey % 3 WHEN 0 THEN concat('https://job-boards.greenhouse.io/c', c_custkey, '/jobs/2') WHEN 1 THEN concat('https://jobs.ashbyhq.com/c', c_custkey, '?utm=x') ELSE concat('https://c', c_custkey, '.recruitee.com/o/x') END,
    'raw', CASE WHEN c_custkey % 2 = 0 THEN 'careers_page' ELSE 'website' END FROM customer"""
CUSTOMER_FETCHED = """SELECT concat('https://c', c_custkey, '.bamboohr.com/careers/list') AS url, CASE WHEN c_custkey % 5 = 0 THEN 404 ELSE 200 END AS status,
    CASE WHEN c_custkey % 7 = 0 THEN 'https://www.bamboohr.com/' ELSE concat('https://c', c_custkey, '.bamboohr.com/careers/list') END AS final_url, 'x' AS body FROM customer
  UNION ALL SELECT CASE c_custkey % 3 WHEN 0 THEN concat('https://boards-api.greenhouse.io/v1/boards/c', c_custkey, '/jobs') WHEN 1 THEN concat('https://api.ashbyhq.com/posting-api/job-board/c', c_custkey) ELSE concat('https://c', c_custkey, '.recruitee.com/') END,
    CASE c_custkey % 4 WHEN 0 THEN 301 WHEN 1 THEN 500 ELSE 200 END, concat('https://c', c_custkey, '.example/'), CASE WHEN c_custkey % 5 < 3 THEN '{"jobs": [1]}' WHEN c_custkey % 5 = 3 THEN '{"jobs": {}}' ELSE '[]' END
    FROM customer WHERE c_custkey % 11 <> 0"""
#: Candidates of sites, and what was fetched.
CANDIDATES = [
    ("a", "bamboohr", "moved", "https://moved.bamboohr.com/", "https://moved.bamboohr.com/jobs/3", "href", "website"),
    ("a", "ashby", "empty", "https://jobs.ashbyhq.com/empty", "https://jobs.ashbyhq.com/empty/1", "raw", "website"),
    ("b", "greenhouse", "heron", "https://job-boards.greenhouse.io/heron", "https://job-boards.greenhouse.io/heron/jobs/2", "href", "website"),
    ("b", "jobvite", "heron", "https://jobs.jobvite.com/heron", "https://jobs.jobvite.com/heron?nl=1", "href", "careers_page"),
    ("c", "softgarden", "egret", "https://egret.softgarden.io/job", "https://egret.softgarden.io/job", "href", "website"),
    ("c", "ttcportals", "egret", "https://egret.ttcportals.com/search/all", "https://egret.ttcportals.com/search/all", "raw", "website"),
    ("d", "ashby", "stork", "https://jobs.ashbyhq.com/stork", "https://jobs.ashbyhq.com/stork", "href", "website"),
    ("e", "bamboohr", "crane", "https://crane.bamboohr.com/", "https://crane.bamboohr.com/", "href", "legal_page"),
    ("e", "recruitee", "crane", "https://crane.recruitee.com/", "https://crane.recruitee.com/o/x?y=1", "href", "legal_page"),
]
FETCHED = [
    ("https://moved.bamboohr.com/careers/list", 200, "https://www.bamboohr.com/signup", "hello"),
    ("https://api.ashbyhq.com/posting-api/job-board/empty", 410, "https://api.ashbyhq.com/posting-api/job-board/empty", '{"jobs": []}'),
    ("https://api.ashbyhq.com/posting-api/job-board/stork", 201, "https://api.ashbyhq.com/posting-api/job-board/stork", '{"apiVersion": "1", "jobs": [{"title": "Cook"}]}'),
    ("https://boards-api.greenhouse.io/v1/boards/heron/jobs", 200, "https://boards-api.greenhouse.io/v1/boards/heron/jobs", '{"jobs": {"none": true}}'),
    ("https://jobs.jobvite.com/heron", 302, "https://jobs.jobvite.com/heron/jobs", "moved"),
    ("https://egret.softgarden.io/job", 401, "https://egret.softgarden.io/login", ""),
    ("https://egret.ttcportals.com/search/all", 399, "https://egret.ttcportals.com/", ""),
    ("https://crane.bamboohr.com/careers/list", 204, "https://crane.bamboohr.com/careers/list", ""),
    ("https://crane.recruitee.com/", 200, "https://crane.recruitee.com/", ""),
]
STRUCTURED_PAGES = [
    ("a", '<script type="application/ld+json">{"@graph": [{"@type": "Organization", "name": " Acme ", "legalName": "Acme Widgets Limited", "alternateName": ["AW", "Acme"], "address": {"streetAddress": "1 High St", "addressLocality": "Leeds", "postalCode": "ls1 1aa"}, "sameAs": ["https://x.com/acme"]}]}</script>'),
    ("b", '<script type="application/ld+json">{broken</script><script type=\'application/ld+json\'>{"@type": "WebSite", "name": "No"}</script>'),
]
#: What the pages above say, in order: site, key, value.
STRUCTURED_FACTS = [
    ("a", "names", "Acme"), ("a", "legal_names", "Acme Widgets Limited"), ("a", "alternate_names", "AW"), ("a", "alternate_names", "Acme"), ("a", "postcodes", "LS11AA"), ("a", "towns", "Leeds"),
    ("a", "addresses", "1 High St"), ("a", "urls", "https://x.com/acme"), ("a", "types", "organization"), ("b", "types", "website"),
]
#: Sites of several pages, as fetched: url, status, final_url, body, error.
SITE_PAGES = [
    ("https://merlin.example", 200, "https://merlin.example:443/home", '<title>Merlin Bakes</title><h1>Merlin Bakes</h1><img src="/logo.png"><a href="/about">About</a><a href="/contact">Contact</a><a href="https://talent.example/merlin/careers">Work with us</a><a href="https://x.com/merlin">x</a>', None),
    ("https://merlin.example/about", 200, None, '<h1>About</h1><p>Merlin Bakes Limited</p><a href="/careers">too late</a><a href="/privacy">Privacy</a><a href="https://other.example/terms">Terms</a>', None),
    ("https://merlin.example/contact", 404, None, '<p>Write to <a href="mailto:Oven@merlin.test">us</a>, 020 7946 0099</p>', None),
    ("https://merlin.example/privacy", 200, None, "<p>Registered number 01234567, LS1 4AP</p>", None),
    ("https://talent.example/merlin/careers", 200, None, '<title>Merlin careers</title><a href="https://jobs.jobvite.com/merlinbakes">All jobs</a><a href="/merlin/vacancies">Vacancies</a>', None),
    ("https://talent.example/merlin/vacancies", 200, None, '<h1>Merlin roles</h1><a href="https://merlinbakes.recruitee.com/">More</a>', None),
    ("https://jobs.jobvite.com/merlinbakes", 404, None, "", None),
    ("https://merlinbakes.recruitee.com/", 200, None, "", None),
    ("https://falcon.example", 200, None, '<title>Falcon Rail</title><a href="https://falconrail.breezy.hr/p/1">Vacancies at /vacancies</a><a href="https://falconrail.breezy.hr/vacancies">Vacancies</a><a href="https://agency.test/jobs">Jobs</a>', None),
    ("https://agency.test/jobs", 200, None, '<title>Agency</title><a href="https://someone.bamboohr.com/">Board</a>', None),
    ("https://falconrail.breezy.hr/", 200, None, "", None),
    ("https://parked.example", 200, None, '<h1>This domain is parked</h1><a href="/contact">c</a>', None),
    ("https://parked.example/contact", 200, None, "<p>020 7946 0055</p>", None),
    ("https://down.example", 0, None, None, "connection reset"),
]
SITE_ROOTS = [("merlin", "merlin.example"), ("falcon", "falcon.example"), ("parked", "https://parked.example"), ("down", "down.example"), ("unknown", "unknown.example")]
#: Lines of a result file as a run may leave it.
RESULT_LINES = [
    (0, '{"domain": "a.uk", "dns_active": true, "http_active": true, "http_status": 200, "response_ms": 12.5}'),
    (1, '{"domain": "b.uk", "dns_active": true, "http_status": 404}'),
    (2, ""),
    (3, '{"domain": "c.uk", "dns_active": fals'),
    (4, '{"domain": "d.uk"}'),
]


def scan_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*(f"{x} AS {c}" for c, x in SCAN_COLUMNS.items()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def values_sql(rows: list[tuple], columns: str) -> str:
    """The rows as a table expression of DuckDB SQL."""

    def literal(x: object) -> str:
        if x is None:
            return "NULL"
        return str(x) if isinstance(x, int | float) else "'" + str(x).replace("'", "''") + "'"

    return "(SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows) + f") AS t({columns}))"


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text: the documents and the inline contacts."""
    return table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(inline(spark, CONTACT_TEXTS, "doc_id long, text string"))


TEXTS_SQL = f"(SELECT doc_id, text FROM documents UNION ALL SELECT * FROM {values_sql(CONTACT_TEXTS, 'doc_id, text')})"


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, html: the pages and the inline ones."""
    return table(spark, sf_dir, "pages").unionByName(inline(spark, MARKED_PAGES, "page_id long, url string, html string"))


SITES_SQL = f"(SELECT page_id, url, html FROM pages UNION ALL SELECT * FROM {values_sql(MARKED_PAGES, 'page_id, url, html')})"


def spread(rows: DataFrame, key: str) -> DataFrame:
    """rows, dealt by a key over as many tasks as a shuffle has: a file of keys is few tasks, but what is made of them is long."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
