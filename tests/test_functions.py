import re

import pytest
from pyspark.sql import functions as F

from sitecensus.functions import boards, pages
from sitecensus.functions import columns as C
from sitecensus.operators import lists, results, site
from sitecensus.plans import views


def one(spark, column, **values):
    kinds = {str: "string", int: "int", bool: "boolean", type(None): "string", list: "array<string>"}
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()))
    return frame.select(column.alias("x")).first().x


def test_status_classes(spark):
    live = {200, 201, 202, 204, 206, 301, 302, 307, 399}
    every = [*live, 401, 403, 0, 400, 404, 429, 500, 502, 503, 504, None]
    frame = spark.createDataFrame([(s,) for s in every], "s int")
    rows = frame.select("s", C.site_active(F.col("s")).alias("site"), C.board_live(F.col("s")).alias("board")).collect()
    assert {r.s for r in rows if r.site} == live | {401, 403}
    assert {r.s for r in rows if r.board} == live


@pytest.mark.parametrize(
    "error, retried, downgraded",
    [("read: connection reset by peer", True, True), ("remote error: tls: handshake failure", True, True), ("lookup x: no such host", False, False), ("context deadline exceeded", True, False), (None, False, False)],
)
def test_retry_and_downgrade(spark, error, retried, downgraded):
    assert one(spark, C.fetch_retry(F.col("e")), e=error) is retried
    plain = one(spark, C.http_downgrade(F.col("u"), F.col("e")), u="https://a.com:443/x?y", e=error)
    assert plain == ("http://a.com/x?y" if downgraded else None)


def test_strip_and_clean(spark):
    assert one(spark, C.strip(F.col("t")), t="　\t a  b\n ") == "a  b"
    assert one(spark, C.clean_text(F.col("t")), t=" a\n\n b\t") == "a b"


@pytest.mark.parametrize(
    "text, numbers",
    [("+440 1632 960001", ["+44163296000"]), ("0044 1632 960001", []), ("(020) 79460018", []), ("020 7946 0018 x 02079460018", ["02079460018"]), ("0632960006", []), ("", []), (None, None)],
)
def test_phones(spark, text, numbers):
    assert one(spark, C.phones(F.col("t")), t=text) == numbers


def test_emails_keep_the_first_spelling(spark):
    text = "Me@Acme.org, me@acme.org. a@example.com you@test.org; test@test.com x@mailinator.com"
    assert one(spark, C.emails(F.col("t")), t=text) == ["Me@Acme.org", "you@test.org"]


@pytest.mark.parametrize(
    "text, kind",
    [("a" * 49, None), ("a" * 50, "EN"), ("1" * 60, None), ("Б" * 25, "RU"), ("a" * 90 + "Б" * 10, "EN"), ("a" * 89 + "Б" * 11, "RU"), ("漢" * 20, "ZH"), ("ع" * 30, "AR"), ("a" * 5000 + "Б" * 5000, "EN"), (None, None)],
)
def test_language(spark, text, kind):
    assert one(spark, C.language(F.col("t")), t=text) == kind


def test_description_is_cut_between_characters(spark):
    assert one(spark, C.description(F.col("t"), F.col("d"), F.lit("/")), t="é" * 300, d="x") == "é" * 250
    assert one(spark, C.description(F.col("t"), F.col("d"), F.lit("/")), t="Acme widgets", d="widgets") == "Acme widgets"
    assert one(spark, C.description(F.col("t"), F.col("d"), F.lit("/about")), t="Acme", d="x") is None


@pytest.mark.parametrize("link, provider, identifier, canonical", views.BOARDS)
def test_boards(link, provider, identifier, canonical):
    found = boards.match_board(link)
    assert found is None if provider is None else (found["provider"], found["identifier"], found["url"]) == (provider, identifier, canonical)


def test_every_provider_has_a_link():
    assert {rule.provider for rule in boards.RULES} == {provider for _, provider, _, _ in views.BOARDS} - {None}


@pytest.mark.parametrize("provider", sorted(set(boards.NOT_BOARDS) - {"avature_action", "rippling_locale", "greenhouse_host"}))
def test_names_that_are_not_boards(provider):
    """Every listed name of a provider in the place where its boards have theirs."""
    link = next(link for link, p, _, _ in views.BOARDS if p == provider)
    name = boards.match_board(link)["identifier"].split("/")[0]
    for blocked in boards.NOT_BOARDS[provider]:
        if provider == "networx":
            assert boards.match_board(f"https://{blocked}.networxrecruitment.com/x") is None
        elif not (provider == "greenhouse" and blocked == "embed"):
            assert boards.match_board(re.sub(name, blocked, link, flags=re.I)) is None, blocked


@pytest.mark.parametrize("link", [None, "", "#jobs", "javascript:void(0)", "http://[::1", "ftp://quarry.teamtailor.com/", "//quarry.teamtailor.com", "https://teamtailor.com/", "https://notgreenhouse.io/x"])
def test_links_of_no_board(link):
    assert boards.match_board(link) is None


def test_candidates_of_pages(spark):
    rows = {s: boards.board_candidates(body, base, kind) for s, _, base, body, kind in views.BOARD_PAGES[:2]}
    assert [(c["provider"], c["discovery"]) for c in rows["a"]] == [("greenhouse", "href"), ("teamtailor", "custom")]
    assert [(c["provider"], c["identifier"], c["url"]) for c in rows["b"]] == [("pinpoint", "work.osprey-rail.example", "https://work.osprey-rail.example/")]


PORTAL = '<meta name="avature.portal.lang" content="{lang}"><meta name="avature.portal.urlPath" content="{path}">'


@pytest.mark.parametrize(
    "page, path, searched, error",
    [
        ("https://bittern.avature.net/en_GB/talent", None, 200, None),
        ("https://bittern.avature.net/en_GB/talent", None, 500, "Avature SearchJobs HTTP 500"),
        ("https://bittern.avature.net/home", "openings", 301, None),
        ("https://bittern.avature.net/home", None, 200, "Avature page has no job-board portal"),
        ("https://bittern.avature.net/home", "openings", None, "Avature SearchJobs HTTP 0"),
    ],
)
def test_avature_boards_need_a_job_search(spark, page, path, searched, error):
    portal = path or "talent"
    search = f"https://bittern.avature.net/{portal}/SearchJobs/"
    rows = [(page, 200, page, PORTAL.format(lang="en_GB", path=path) if path else "")] + ([(search, searched, search, "")] if searched else [])
    fetched = spark.createDataFrame(rows, "url string, status int, final_url string, body string")
    candidate = spark.createDataFrame([("s", "avature", "bittern", page, page)], "site string, provider string, identifier string, url string, raw_url string")
    row = site.verified(candidate, fetched).first()
    assert (row.active, row.error) == (error is None, error)
    elsewhere = fetched.withColumn("body", F.lit(PORTAL.format(lang="pt_BR", path="x")))
    assert site.verified(candidate, elsewhere).first().error == "non-uk avature locale: pt_BR"


def test_legal_names():
    text = "Siskin & Sons L.T.D. sells; the Linnet Group plc bought it, not limited to this. ©Dunnock Foods Inc and Wren Ltd. 3 Tern Road limited"
    assert [(n["name"], n["position"]) for n in pages.legal_names(text)] == [("Siskin & Sons L.T.D", 0), ("Linnet Group plc", 1), ("Dunnock Foods Inc", 3), ("Wren Ltd", 4), ("3 Tern Road limited", 5)]
    assert pages.legal_names(None) == pages.legal_names("limited") == pages.legal_names("and not limited to this") == []
    assert pages.legal_names("one two three four five Six seven eight nine Ten Ltd")[0]["name"] == "three four five Six seven eight nine Ten Ltd"


def test_page_with_everything():
    page = pages.parse_page(
        '<head><title> Acme &amp; Co </title><meta name="Description" content=" We make "><link rel="Shortcut Icon" href=" /f.ico "></head><body><h1>Hi <b>there</b></h1>'
        '<script>no</script><a href="mailto:Me@acme.org?x=1">m</a><a href="tel: 020 1">t</a><a href="/x">one<a href="/y">two</a><img data-src="/i.png" alt="i"><footer>Copyright Acme</footer>'
    )
    assert (page["title"], page["description"], page["headings"], page["footer_text"]) == ("Acme & Co", "We make", ["Hi there"], "Copyright Acme")
    assert page["emails"] == ["Me@acme.org"] and page["phones"] == ["020 1"]
    assert [a["href"] for a in page["anchors"]] == ["/x", "/y"] and [i["href"] for i in page["images"]] == ["/f.ico", "/i.png"]
    assert "no" not in page["text"].split() and page["text"].startswith("Acme & Co")


def test_structured_data_keeps_document_order_and_skips_bad_blocks():
    assert pages.structured_data(views.STRUCTURED_PAGES[0][1])["names"] == ["Acme"]
    assert pages.structured_data(views.STRUCTURED_PAGES[0][1])["postcodes"] == ["LS11AA"]
    assert pages.structured_data(views.STRUCTURED_PAGES[1][1])["names"] == []


def test_external_boards_need_shared_words(spark):
    own = spark.createDataFrame([("s", "https://acme-widgets.co.uk", "Acme Widgets", ["Home"])], "site string, url string, title string, headings array<string>")
    rows = [("s", "https://jobs.acme.io", "Acme careers", ["Roles"], "u1"), ("s", "https://other.io", "Other company", ["Join"], "u2")]
    external = spark.createDataFrame(rows, "site string, page_url string, title string, headings array<string>, url string")
    assert {r.url: r.accepted for r in site.external_boards(own, external).collect()} == {"u1": True, "u2": False}


def test_merge_pages_and_probe(spark):
    read = site.parsed(spark.createDataFrame([("s", 0, "<h1>A</h1><a href='/x'>x</a>"), ("s", 1, "<h1>A</h1><h2>B</h2>")], "site string, visit int, html string"))
    one_site = site.merge_pages(read).first()
    assert one_site.headings == ["A", "B"] and one_site.text == "A x A B" and len(one_site.anchors) == 1
    answers = {"https://a.uk": {"error": "tls"}, "http://a.uk": {"status": 200}, "https://b.uk": {"status": 503}, "https://c.uk": {"dns_active": False, "error": "no such host"}}
    found = site.probe(spark.createDataFrame([("a.uk",), ("b.uk",), ("c.uk",)], "domain string"), lambda url: answers.get(url, {})).collect()
    assert all(r.checked_at.endswith("Z") and r.response_ms >= 0 and (r.redirect_count, r.redirect_chain) == (0, None) for r in found)
    chain = [f"https://d.uk/{i}" for i in range(11)]
    moved = site.probe(spark.createDataFrame([("d.uk",)], "domain string"), lambda url: {"status": 302, "final_url": chain[-1], "redirect_chain": chain}).first()
    assert (moved.http_active, moved.redirect_count, moved.redirect_chain, moved.final_url) == (True, 10, chain, chain[-1])
    assert {r.domain: (r.http_active, r.http_status, r.error, r.attempts) for r in found} == {"a.uk": (True, 200, "tls", 1), "b.uk": (False, 503, None, 2), "c.uk": (False, None, "no such host", 2)}


@pytest.fixture(scope="module")
def extracted(spark):
    fetched = spark.createDataFrame(views.SITE_PAGES, "url string, status int, final_url string, body string, error string")
    roots = spark.createDataFrame(views.SITE_ROOTS, "site string, input_url string")
    return {r.site: r for r in site.extract_sites(roots, fetched).collect()}


def test_sites_are_crawled_merged_and_their_boards_verified(extracted):
    merlin = extracted["merlin"]
    assert (merlin.website, merlin.active, merlin.n_pages, merlin.logo_link) == ("https://merlin.example/home", True, 4, "https://merlin.example/logo.png")
    # the contact page is a 404 with text; the privacy page is found on a page below the root, the terms page is on another host
    assert (merlin.contact_page, merlin.privacy_page, merlin.terms_conditions_page) == ("https://merlin.example/contact", "https://merlin.example/privacy", None)
    assert (merlin.email, merlin.phone, merlin.extra_info) == ("Oven@merlin.test", "02079460099", '{"company_number":["01234567"],"post_code":["LS14AP"]}')
    # the root's own careers link counts, on another host as it is, and is followed two steps for boards
    assert merlin.careers_page == "https://talent.example/merlin/careers"
    boards_ = [(c.url, c.source_kind, c.active, c.http_status, c.error) for c in merlin.ats_candidates]
    assert boards_ == [("https://jobs.jobvite.com/merlinbakes", "external_careers", False, 404, "HTTP 404"), ("https://merlinbakes.recruitee.com/", "external_careers", True, 200, None)]
    assert (merlin.ats_page, merlin.ats_traceable, merlin.ats_rejections) == ("https://merlinbakes.recruitee.com/", True, None)


def test_boards_of_links_and_of_other_companies(extracted):
    falcon = extracted["falcon"]
    assert [(c.url, c.source_kind) for c in falcon.ats_candidates] == [("https://falconrail.breezy.hr/", "website")]
    assert (falcon.ats_page, falcon.vacancies_page, falcon.careers_page) == ("https://falconrail.breezy.hr/", None, "https://agency.test/jobs")
    assert [(r.page, r.ats) for r in falcon.ats_rejections] == [("https://agency.test/jobs", ["https://someone.bamboohr.com/"])]


def test_parked_and_unreachable_sites_are_not_crawled(extracted):
    parked, down, unknown = (extracted[s] for s in ("parked", "down", "unknown"))
    assert (parked.hosting, parked.active, parked.n_pages, parked.phone) == (True, False, 1, "")
    assert (down.active, down.http_status, down.error, down.n_pages) == (False, None, "connection reset", 0)
    assert (unknown.error, unknown.website) == ("not fetched", "https://unknown.example")


def test_links_to_other_hosts_are_found_on_the_root_alone(spark):
    roots = spark.createDataFrame([("s", "r")], "site string, url string")
    rows = [("r", 0, "about", "a", True), ("r", 1, "jobs", "x", False), ("a", 1, "jobs", "j", True), ("a", 2, "terms", "t", False), ("a", 3, "legal", "l", True), ("x", 4, "press", "p", True)]
    links = spark.createDataFrame(rows, "url string, kind_order int, kind string, target string, follow boolean")
    state = site.crawl_states(roots, links).first()
    assert [v.url for v in state.visited] == ["r", "a", "l"] and [(f.kind, f.target) for f in state.found] == [("about", "a"), ("jobs", "x"), ("legal", "l")]


def test_same_host(spark):
    same = lambda a, b: one(spark, C.same_host(F.col("a"), F.col("b")), a=a, b=b)
    assert same("https://A.uk:8443/x", "http://a.uk") and not same("https://a.uk", "https://www.a.uk") and not same("", "") and not same("/x", "/x")


def test_candidates_of_a_site_are_one_for_each_board(spark):
    pages_ = spark.createDataFrame(views.BOARD_PAGES, "site string, seq int, base string, body string, source_kind string")
    found = [(r.seq, r.pos, r.provider, r.url, r.discovery) for r in site.board_candidates(pages_).where("site = 'c'").orderBy("seq", "pos").collect()]
    assert found == [(0, 0, "bamboohr", "https://kestrel.bamboohr.com/", "href"), (0, 1, "lever", "https://jobs.lever.co/kestrel", "raw")]


def test_url_key(spark):
    key = lambda url: one(spark, C.url_key(F.col("url")), url=url)
    assert {key(u) for u in ("https://a.uk", "HTTPS://A.uk:443/", "https://a.uk#top", "https://a.uk/#top")} == {"https://a.uk/"}
    assert key("https://a.uk?q=A#f") == "https://a.uk/?q=A" and key("http://a.uk:443/B") == "http://a.uk:443/B" and key("/x#y") == "/x#y" and key("") == ""
    assert spark.range(1).select(C.url_key(F.lit(None).cast("string"))).first()[0] is None


def test_pages_are_found_by_any_spelling_of_their_url(spark):
    root = '<a href="/contact#form">Contact</a><a href="https://JOBS.test/jobs#now">Jobs</a>'
    fetched = [
        ("https://a.uk/", 200, None, f"<title>Finch</title>{root}", None),
        ("HTTPS://a.uk:443/contact", 200, None, '<p>020 7946 0012</p><a href="https://A.uk">home</a>', None),
        ("https://jobs.test/jobs", 200, None, '<title>Finch roles</title><a href="https://jobs.lever.co/finch">All</a>', None),
        ("https://jobs.lever.co:443/finch#x", 200, None, "", None),
    ]
    fetched = spark.createDataFrame(fetched, "url string, status int, final_url string, body string, error string")
    found = site.extract_sites(spark.createDataFrame([("a", "A.uk")], "site string, input_url string"), fetched).first()
    assert (found.n_pages, found.error, found.phone, found.contact_page) == (2, None, "02079460012", "https://a.uk/contact#form")
    assert [(c.url, c.active) for c in found.ats_candidates] == [("https://jobs.lever.co/finch", True)]


def test_a_crawl_without_keys_tells_all_urls_apart(spark):
    roots = spark.createDataFrame([("s", "https://a.uk")], "site string, url string")
    links = spark.createDataFrame([("https://a.uk", 0, "about", "https://a.uk/")], "url string, kind_order int, kind string, target string")
    assert [v.url for v in site.crawl_states(roots, links).first().visited] == ["https://a.uk", "https://a.uk/"]
    keyed = links.withColumn("url", C.url_key(F.col("url")))
    assert [v.url for v in site.crawl_states(roots, keyed, key=C.url_key).first().visited] == ["https://a.uk"]


def test_instants(spark):
    seconds = lambda text: one(spark, C.instant(F.col("t")).cast("double"), t=text)
    assert seconds("1970-01-01T00:01:00.5Z") == 60.5 == seconds("1970-01-01 02:01:00.500000+02:00") and seconds("1970-01-02") == 86400
    assert seconds("1970-01-01T00:01Z") == 60 == seconds("1970-01-01T00:01") == seconds("1970-01-01T02:01+02:00")
    assert [seconds(t) for t in ("1970-01-01T01Z", "1970-02-30", "1970", "12:00", "now", "", "1970-01-01T00:00:00Z ")] == [None] * 7
    assert spark.range(1).select(C.instant(F.lit(None).cast("string"))).first()[0] is None


def test_timing_of_states(spark):
    rows = [("a", "2026-01-01T00:00:00Z", 2.0, 10), ("b", "bad", 0.0, 10), ("c", "2026-01-03", 1.0, 0), ("d", None, None, None)]
    states = spark.createDataFrame(rows, "machine string, started_at string, rate_per_second double, remaining long")
    timed = {r.machine: r for r in results.with_timing(states, F.expr("timestamp '2026-01-02 00:00:00'")).selectExpr("*", "unix_seconds(eta_at) - unix_seconds(timestamp '2026-01-02 00:00:00') AS more").collect()}
    assert [(timed[m].elapsed_seconds, timed[m].eta_seconds, timed[m].more) for m in "abcd"] == [(86400.0, 5.0, 5), (0.0, None, None), (0.0, None, None), (0.0, None, None)]


def test_batch_names(spark):
    names = {"abc": True, "a-1": True, "ab": False, "Abc": False, "1bc": False, "a_b": False, "abc\n": False, "a" * 51: True, "a" * 52: False, "": False}
    frame = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string")
    assert {r.name: r.sound for r in frame.select("name", lists.is_batch_name(F.col("name")).alias("sound")).collect()} == {**names, None: False}
    assert lists.batch_name("run-7") == "run-7"
    for bad in ("Run", "a", "abc\n"):
        with pytest.raises(ValueError, match="lowercase"):
            lists.batch_name(bad)
    with pytest.raises(ValueError, match="positive"):
        lists.tail(frame, 11, 0)
