"""Queries over whole sites that are planted for all customers by a rule of their keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import lists, results, site
from .views import inline, spread, table

#: What is fetched of a customer's site, by the key's remainder of 8: kind, url, status, final_url, body, error; {n} is the key.
PLANTED = [
    (0, "https://c{n}.uk", 200, None, '<title>Baker{n} Foods.</title><p>Baker{n} Foods Limited.</p><a href="/contact">Contact</a><a href="/privacy">Privacy</a><footer>Copyright Baker{n}</footer>', None),
    (0, "https://c{n}.uk/contact", 404, None, '<p>Write to <a href="mailto:Oven{n}@baker.test">us</a> or desk{n}@baker.test</p><a href="/terms">Terms</a>', None),
    (0, "https://c{n}.uk/privacy", 200, None, "<p>We keep nothing.</p>", None),
    (0, "https://c{n}.uk/terms", 200, None, '<p>Write to <a href="mailto:oven{n}@BAKER.test">us</a></p>', None),
    (1, "https://c{n}.uk/", 200, None, '<title>c{n}</title><p>This domain is parked</p><a href="/contact">Contact</a>', None),
    (1, "https://c{n}.uk/contact", 200, None, "<p>desk{n}@baker.test</p>", None),
    (2, "https://c{n}.uk", 0, None, None, "connection reset"),
    (4, "https://c{n}.uk", 200, None, '<title>Baker{n} Foods.</title><p>Baker{n} Foods Limited.</p><a href="https://hire.test/{n}/jobs">Jobs</a>', None),
    (4, "https://hire.test/{n}/jobs", 200, None, '<title>Baker{n} openings</title><a href="https://jobs.lever.co/baker{n}">All</a>', None),
    (4, "https://jobs.lever.co/baker{n}", 404, None, "", None),
    (5, "https://c{n}.uk", 200, None, '<title>Baker{n} Foods.</title><p>Baker{n} Foods Limited.</p><a href="https://agency.test/{n}/jobs#top">Jobs</a>', None),
    (5, "https://agency.test/{n}/jobs", 200, None, '<title>Agency staff</title><a href="https://jobs.lever.co/agency{n}">All</a>', None),
    (6, "https://c{n}.uk/home", 500, "https://c{n}.uk/start", '<title>Baker{n} Foods</title><p>Nothing here.</p><a href="https://jobs.lever.co/baker{n}/vacancies">Vacancies</a>', None),
    (6, "https://jobs.lever.co/baker{n}", 200, None, "", None),
    (7, "HTTPS://C{n}.UK:443/", 403, "https://c{n}.uk/", '<title>Baker{n} Foods.</title><p>Baker{n} Foods Limited.</p><a href="/contact#team">Team</a><a href="https://hire.test/{n}/jobs">Jobs</a>', None),
    (7, "https://c{n}.uk/contact", 200, None, "<p>desk{n}@baker.test</p><a href=\"HTTPS://C{n}.uk/\">Home</a>", None),
    (7, "https://hire.test:443/{n}/jobs", 200, None, '<title>Baker{n} openings</title><a href="https://jobs.lever.co/baker{n}">All</a>', None),
    (7, "https://jobs.lever.co/baker{n}", 301, None, "", None),
]
#: A site's address as it is given, by the same remainder.
GIVEN = [(k, {6: "c{n}.uk/home", 7: "https://C{n}.uk"}.get(k, "c{n}.uk")) for k in range(8)]
PLANTED_COLUMNS = "kind, url, status, final_url, body, error"


def _planted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = spread(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("n"), (F.col("c_custkey") % 8).cast("int").alias("kind")), "n")
    of = lambda c: F.replace(c, F.lit("{n}"), F.col("n").cast("string")).alias(c)
    made = inline(spark, PLANTED, "kind int, url string, status int, final_url string, body string, error string")
    given = inline(spark, GIVEN, "kind int, input_url string")
    fetched = customer.join(F.broadcast(made), "kind").select(of("url"), "status", of("final_url"), of("body"), "error")
    return customer.join(F.broadcast(given), "kind").select(F.format_string("s%d", "n").alias("site"), of("input_url")), fetched


def site_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all customers' sites: crawled unless parked, their contacts put together, with boards of other hosts
    that share the site's words, and what was refused."""
    records = site.extract_sites(*_planted(spark, sf_dir))
    refused = F.array_join(F.transform("ats_rejections", lambda r: F.concat(r["page"], F.lit(" > "), F.array_join(r["ats"], ","))), "; ")
    tried = F.array_join(F.transform("ats_candidates", lambda c: F.concat_ws(" ", c["url"], c["source_kind"], c["http_status"].cast("string"), c["error"])), "; ")
    return records.select(
        *"site input_url website http_status active hosting n_pages company_name limited_company email contact_page careers_page vacancies_page privacy_page terms_conditions_page ats_provider ats_page ats_traceable footer_evidence error".split(),
        refused.alias("refused"),
        tried.alias("tried"),
    )


#: Documents in which many words begin with a capital, and legal forms stand in sentences and at their ends.
NAMED_TEXT = "replace(replace(replace(replace(coalesce(text, ''), ' a', ' A'), ' s', ' S'), '. ', ' Ltd. '), ' the ', ' the plc ')"


def document_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The legal names of all documents with forms planted in them, each a site of its own."""
    return site.legal_form_names(table(spark, sf_dir, "documents").selectExpr("concat('d', CAST(doc_id AS STRING)) AS site", f"{NAMED_TEXT} AS text"))


_FEED = '<link rel="alternate" type="application/rss+xml" href="https://feeds.test/jobs.rss">'
_FONT = "//fonts.teamtailor-cdn.com/teamtailor-production/oak-12/custom-fonts.css"
_COMPANY = "https://app.teamtailor.com/companies/oak_{n}@eu"
_PARENTS = '<a href="https://careers.other{n}.test/about">a</a><a href="https://careers.oak{n}.test/cookie-policy/">b</a><a href="https://careers.elm{n}.test/cookie-policy">c</a>'
#: What pages load, by the remainder of 10 of their ids: feeds and evidence of boards under a company's own host, or too little.
LOADED = [
    (0, f"{_FEED}<i data-f='{_FONT}'>"),
    (1, f"{_FEED}<i data-f='{_COMPANY}/x'>"),
    (2, f"{_FEED}<i data-careersite--ready>{_PARENTS}"),
    (3, f"<i data-f='{_FONT}'>"),
    (4, f"{_FEED}<p>Jobs by PinpointHQ</p>"),
    (5, f"<i data-f='{_COMPANY}?a'>{_FEED}<i data-f='{_FONT}'>PINPOINTHQ"),
    (6, "<p>pinpointhq and teamtailor</p>"),
    (7, f"{_FEED}<p>teamtailor</p>"),
    (8, f"{_FEED}<link href='https://ASSETS-eu.teamtailor-cdn.com/a/careersite-9.css'>pinpointhq"),
]
#: Some of these pages are at a provider's own host, whose boards are no custom ones.
BASE = "CASE WHEN page_id % 10 = 0 AND page_id % 3 = 0 THEN concat('https://oak', CAST(page_id AS STRING), '.teamtailor.com/') WHEN page_id % 10 = 4 AND page_id % 3 = 0 THEN concat('https://oak', CAST(page_id AS STRING), '.pinpointhq.com/jobs') ELSE url END"


def custom_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boards under companies' own hosts, on all pages with what they load behind their end."""
    loaded = inline(spark, LOADED, "kind int, loaded string")
    pages = table(spark, sf_dir, "pages").withColumn("kind", (F.col("page_id") % 10).cast("int")).join(F.broadcast(loaded), "kind", "left")
    body = F.concat(F.coalesce("html", F.lit("")), F.replace(F.coalesce("loaded", F.lit("")), F.lit("{n}"), F.col("page_id").cast("string")))
    found = site.board_candidates(pages.select(F.col("page_id").alias("site"), F.lit(0).alias("seq"), F.expr(BASE).alias("base"), body.alias("body"), F.lit("website").alias("source_kind")))
    return found.where("discovery = 'custom'").select(F.col("site").alias("page_id"), "provider", "identifier", "url", "raw_url")


#: Starts as states name them, by the remainder of 8 of an event's id: sound, in another zone, of a day, in the future, and none.
STARTS = [
    (0, "2026-01-0{d}T0{d}:30:00Z"), (1, "2026-01-0{d} 1{d}:00:00.250000+05:30"), (2, "2026-01-0{d}"), (3, "2026-13-0{d}T00:00:00Z"),
    (4, "yesterday"), (5, "2027-01-0{d}T00:00:00Z"), (6, "2026-01-0{d}T0{d}:15-02:00"), (7, None),
]
NOW = "2026-01-12T00:00:00Z"


def state_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each event, as a state, says of the time that it has taken and still needs."""
    made = inline(spark, STARTS, "kind int, started string")
    events = table(spark, sf_dir, "events").withColumn("kind", (F.col("event_id") % 8).cast("int")).join(F.broadcast(made), "kind")
    digit = (1 + F.col("event_id") % 7).cast("string")
    states = events.select("event_id", F.replace("started", F.lit("{d}"), digit).alias("started_at"), (F.col("event_id") % 5 / 4).alias("rate_per_second"), (F.col("event_id") % 3 * 100).alias("remaining"))
    timed = results.with_timing(states, C.instant(F.lit(NOW)))
    return timed.select("event_id", F.round("elapsed_seconds", 3).alias("elapsed_seconds"), F.round("eta_seconds", 3).alias("eta_seconds"), F.unix_millis("eta_at").alias("eta_ms"))


def batch_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which names of nations and customers, as they are and in small letters with hyphens, can name a batch."""
    names = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")).union(table(spark, sf_dir, "customer").select("c_name"))
    both = names.select(F.explode(F.array("name", F.lower("name"), F.regexp_replace(F.lower("name"), "[^a-z0-9]+", "-"), F.substring(F.lower("name"), 1, 2), F.repeat(F.lower("name"), 4))).alias("name"))
    return both.select("name", lists.is_batch_name(F.col("name")).alias("sound"))


NAMES = ["site_census", "document_names", "custom_boards", "state_timing", "batch_names"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: globals()[name] for name in NAMES}
