"""Pages, links, crawls and the extraction record."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructType

from ..functions import boards, fixed, markers, pages
from ..functions import columns as C
from ..sources.writers import bucketed, staged

PAGE = (
    "title string, description string, og_image string, text string, footer_text string, headings array<string>, anchors array<struct<href:string,text:string>>, "
    "emails array<string>, phones array<string>, images array<struct<href:string,alt:string,class:string,rel:string,sizes:string>>, "
    "structured struct<names:array<string>,legal_names:array<string>,alternate_names:array<string>,company_numbers:array<string>,postcodes:array<string>,"
    "towns:array<string>,addresses:array<string>,urls:array<string>,types:array<string>>"
)
CANDIDATE = "provider string, identifier string, url string, raw_url string, discovery string, source_kind string"
MOST_PAGES = 8
MAPPED_ROWS = 256  # Python values of so many rows are held at once


def _mapped(rows: DataFrame, made: Callable[[list], list[dict]], inputs: list[str], schema: str) -> DataFrame:
    """rows with the columns of schema, which ``made`` gives for a batch of the input columns' values."""
    kept = rows.columns
    added = StructType.fromDDL(schema)
    out_schema = StructType([*rows.schema.fields, *added.fields])
    arrow = to_arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, MAPPED_ROWS) for whole in batches for i in range(0, whole.num_rows, MAPPED_ROWS)):
            values = [batch.column(kept.index(c)).to_pylist() for c in inputs]
            found = made(list(zip(*values, strict=True)))
            columns = [pa.array([r[f.name] for r in found], arrow.field(f.name).type) for f in added]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema=pa.schema([*batch.schema, *(arrow.field(f.name) for f in added)]))

    return rows.mapInArrow(run, out_schema)


def parsed(sites: DataFrame, body: str = "html") -> DataFrame:
    """sites with the columns of PAGE."""
    return _mapped(sites, lambda rows: [pages.parse_page(r[0]) for r in rows], [body], PAGE)


def with_marks(sites: DataFrame, body: str = "html") -> DataFrame:
    """sites with the body decoded (character references) and the markers that it has, in one pass of its batches."""
    return _mapped(sites, markers.marked, [body], markers.SCHEMA)


@F.pandas_udf(StringType())
def absolute_url(url: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([pages.absolute(u, b) for u, b in zip(url, base, strict=True)])


def page_links(pages_: DataFrame) -> DataFrame:
    """pages_ (site, base, anchors): site, pos, url of their links as seen from base."""
    each = pages_.select("site", "base", F.posexplode("anchors").alias("pos", "a"))
    return each.select("site", "pos", absolute_url(F.col("a.href"), F.col("base")).alias("url"))


def link_score(path: Column, keywords: list[str]) -> Column:
    """Points of a link for a kind of page, or null: 10 for a path that ends in a keyword, 2 for one that holds it; less
    for depth, and 100 less for an archive."""
    score, hit = F.lit(0), F.lit(False)
    for word in (k.lstrip("/") for k in keywords):
        ends, holds = path.endswith("/" + word), path.contains(word)
        score = score + F.when(ends, 10).when(holds, 2).otherwise(0)
        hit = hit | holds
    depth = F.least(F.lit(5), F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))))
    archive = sum((F.when(path.contains(slug), 100).otherwise(0) for slug in fixed.ARCHIVE_SLUGS), F.lit(0))
    return F.when(hit, score - depth - archive)


def best_links(links: DataFrame) -> DataFrame:
    """links (site, pos, url: absolute): the best of each site and kind (site, kind, url); most points, then the shortest
    URL, then the first."""
    path = F.regexp_replace(F.lower(C.path_of(F.col("url"))), "/+$", "")
    scores = lambda p: F.array(*(F.struct(F.lit(kind).alias("kind"), link_score(p, words.split()).alias("score")) for kind, words in fixed.PAGE_LINKS.items()))
    ranked = links.select("site", "pos", "url", F.explode(C.once(path, scores)).alias("s")).where("s.score is not null")
    best = F.min_by("url", F.struct(-F.col("s.score"), F.octet_length("url"), "pos"))
    return ranked.groupBy("site", F.col("s.kind").alias("kind")).agg(best.alias("url"))


def social_links(links: DataFrame) -> DataFrame:
    """links (site, pos, url): the first of each site and network (site, network, url)."""
    hits = lambda host: F.array_compact(F.array(*(F.when(C.in_domains(host, domains), F.lit(name)) for name, domains in fixed.SOCIAL_DOMAINS.items())))
    return links.select("site", "pos", "url", F.explode(C.once(C.host_of(F.col("url")), hits)).alias("network")).groupBy("site", "network").agg(F.min_by("url", "pos").alias("url"))


def legal_form_names(texts: DataFrame, most: int = 25) -> DataFrame:
    """texts (site, text): site, rank, name, count of the legal names; most frequent first, then the first one."""
    named = _mapped(texts, lambda rows: [{"found": pages.legal_names(r[0])} for r in rows], ["text"], "found array<struct<name:string,position:int>>")
    each = named.select("site", F.explode("found").alias("f")).select("site", F.col("f.name").alias("name"), F.col("f.position").alias("position"))
    counted = each.groupBy("site", F.lower("name").alias("folded")).agg(F.count("*").alias("count"), F.min("position").alias("first"), F.min_by("name", "position").alias("name"))
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy("site").orderBy(F.desc("count"), "first")))
    return ranked.where(F.col("rank") <= most).select("site", "rank", "name", "count")


def identity_overlap(a: Column, b: Column) -> Column:
    return F.arrays_overlap(a, b)


def crawl(roots: DataFrame, links: DataFrame, most: int = MOST_PAGES) -> DataFrame:
    """site, url, label, visit: pages in the order of a bounded breadth-first visit, see ``crawl_states``."""
    return crawl_states(roots, links, most).select("site", F.posexplode("visited").alias("visit", "v")).select("site", "v.url", "v.label", "visit")


def crawl_states(roots: DataFrame, links: DataFrame, most: int = MOST_PAGES, key: Callable[[Column], Column] = lambda url: url) -> DataFrame:
    """site; visited: pages (url, label) in the order of a bounded breadth-first visit; found: kinds and their links.

    roots: site, url. links: url, kind_order, kind, target, and optionally follow: the best link of each kind of each page;
    those without follow (to another host) are found on the root, but not visited. A site's kinds are fixed by the first page
    that has them; a page is visited once, and at most ``most`` pages are. ``key`` of a URL is what tells pages apart, and
    the links' url are keys; visited pages keep the URL by which they were found. One join of the frontier to the links a step,
    ``most`` steps at most; a site's state is one row, and a site without a next page takes part in no further step. The links of a page are stored once, in buckets of its URL (for
    more than one step), so that they do not move in any step; only the states do."""
    found, queue = "array<struct<kind:string,target:string,follow:boolean>>", "array<struct<url:string,label:string>>"
    state = roots.select(
        "site",
        F.array(F.struct(F.col("url").alias("url"), F.lit("website").alias("label"))).alias("visited"),
        F.array().cast(queue).alias("queue"),
        F.array().cast(found).alias("found"),
        key(F.col("url")).alias("at"),
    )
    links = links if "follow" in links.columns else links.withColumn("follow", F.lit(True))
    ordered = F.array_sort(F.collect_list(F.struct("kind_order", "kind", "target", "follow")))
    by_page = links.groupBy("url").agg(F.transform(ordered, lambda x: F.struct(x["kind"].alias("kind"), x["target"].alias("target"), x["follow"].alias("follow"))).alias("out"))
    by_page = by_page.withColumnRenamed("url", "at")
    if most > 1:
        by_page = bucketed(by_page, "links", "at")
    ended: list[DataFrame] = []
    for step in range(most):
        is_new = lambda x: ~F.exists("found", lambda f: f["kind"] == x["kind"]) & (x["follow"] | F.lit(step == 0))  # noqa: E731, B023
        grown = state.join(by_page, "at", "left").withColumn("out", F.filter(F.coalesce("out", F.array().cast(found)), is_new))
        fresh = F.transform(F.filter("out", lambda x: x["follow"]), lambda x: F.struct(x["target"].alias("url"), x["kind"].alias("label")))
        unseen = F.filter(F.concat("queue", fresh), lambda x: ~F.exists("visited", lambda v: key(v["url"]) == key(x["url"])))
        state = grown.select("site", "visited", unseen.alias("queue"), F.concat("found", "out").alias("found"))
        next_ = F.when(F.size("visited") < most, F.get("queue", F.lit(0)))
        state = state.withColumn("next", next_).select(
            "site",
            F.when(F.col("next").isNotNull(), F.concat("visited", F.array("next"))).otherwise(F.col("visited")).alias("visited"),
            "queue",
            "found",
            key(F.col("next.url")).alias("at"),
        )
        if step == most - 1:
            ended.append(state)
            break
        state = staged(state, "step")
        ended.append(state.where("at is null"))
        state = state.where("at is not null")
        if state.isEmpty():
            break
    state = reduce(DataFrame.unionByName, ended or [state])
    return state.select("site", "visited", "found")


def board_candidates(fetched: DataFrame) -> DataFrame:
    """fetched (site, seq, base, body, source_kind): one row a candidate (site, seq, pos and CANDIDATE), each URL once a site."""
    found = _mapped(fetched, lambda rows: [{"found": boards.board_candidates(*r)} for r in rows], ["body", "base", "source_kind"], f"found array<struct<{CANDIDATE.replace(' string', ':string')}>>")
    return distinct_boards(found.select("site", "seq", F.posexplode("found").alias("pos", "c")).select("site", "seq", "pos", "c.*"))


def distinct_boards(candidates: DataFrame) -> DataFrame:
    """candidates (site, seq, pos, url, ..): the first of each URL of a site."""
    first = Window.partitionBy("site", F.lower("url")).orderBy("seq", "pos")
    return candidates.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")


def with_board(urls: DataFrame, column: str = "url") -> DataFrame:
    """urls with ``board``: what the URL's board is, or null."""
    return _mapped(urls, lambda rows: [{"board": boards.match_board(r[0])} for r in rows], [column], "board struct<provider:string,identifier:string,url:string,raw_url:string>")


def probe_url(provider: Column, url: Column) -> Column:
    """Where a candidate's life shows: some providers have a list of jobs to ask for."""
    last = F.element_at(F.split(F.trim(url), "/"), -1)
    return (
        F.when(provider == "bamboohr", F.concat(F.lit("https://"), C.host_of(url), F.lit("/careers/list")))
        .when(provider == "ashby", F.concat(F.lit("https://api.ashbyhq.com/posting-api/job-board/"), last))
        .when(provider == "greenhouse", F.concat(F.lit("https://boards-api.greenhouse.io/v1/boards/"), last, F.lit("/jobs")))
        .otherwise(url)
    )


def meta_value(body: Column, name: str) -> Column:
    return F.regexp_extract(body, r"(?is)<meta[^>]+name=[\"']" + name.replace(".", r"\.") + r"[\"'][^>]+content=[\"']([^\"']*)", 1)


def verified(candidates: DataFrame, fetches: DataFrame) -> DataFrame:
    """candidates with availability_checked, active, http_status and error. fetches: url, status, final_url, body; a URL that
    was not fetched has status 0."""
    answer = fetches.select(C.url_key(F.col("url")).alias("probe"), F.coalesce("status", F.lit(0)).alias("status"), "final_url", F.coalesce("body", F.lit("")).alias("body")).dropDuplicates(["probe"])
    probed = candidates.withColumn("probe", C.url_key(probe_url(F.col("provider"), F.col("url")))).join(answer, "probe", "left").withColumn("status", F.coalesce("status", F.lit(0)))
    # a second question for Avature: its portal's job search
    meta = F.trim(meta_value(F.col("body"), "avature.portal.urlPath"))
    segments = F.filter(F.split(C.path_of(F.col("raw_url")), "/"), lambda s: s != "")
    local = F.coalesce(F.get(segments, F.lit(0)).rlike("(?i)^[a-z]{2}(_[a-z]{2})?$"), F.lit(False)).cast("int")
    portal = F.coalesce(F.nullif(F.regexp_replace(meta, "^/+|/+$", ""), F.lit("")), F.get(segments, local), F.lit(""))
    search = F.concat(F.regexp_extract("raw_url", "^([a-z]+)://", 1), F.lit("://"), C.host_of(F.col("raw_url")), F.lit("/"), portal, F.lit("/SearchJobs/"))
    is_avature = F.col("provider") == "avature"
    # without a second question: a key of its own, which meets nothing; one null for all would put them into one task
    none = F.concat(F.lit("none "), F.xxhash64(*candidates.columns).cast("string"))
    asked = probed.withColumns({"portal": F.when(is_avature, portal), "search": F.coalesce(F.when(is_avature, C.url_key(search)), none)})
    second = answer.select(F.col("probe").alias("search"), F.col("status").alias("search_status"), F.col("final_url").alias("search_url"))
    asked = asked.join(second, "search", "left").withColumn("search_status", F.coalesce("search_status", F.lit(0)))
    live, host = C.board_live(F.col("status")), C.host_of(F.coalesce("final_url", F.lit("")))
    at_home = lambda h: (h == "avature.net") | h.endswith(".avature.net")
    locale = F.regexp_replace(F.trim(meta_value(F.col("body"), "avature.portal.lang")), "^/+|/+$", "")
    http = F.concat(F.lit("HTTP "), F.col("status"))
    has_jobs = F.coalesce(F.expr("schema_of_variant(try_variant_get(try_parse_json(body), '$.jobs', 'variant')) LIKE 'ARRAY%'"), F.lit(False))
    error = (
        F.when(
            is_avature,
            F.when(~live, http)
            .when(~at_home(host), "redirected off avature.net")
            .when((locale != "") & (F.lower(locale) != "en_gb"), F.concat(F.lit("non-uk avature locale: "), locale))
            .when((F.col("portal") == "") | F.lower("portal").isin(*boards.NOT_BOARDS["avature_action"]), "Avature page has no job-board portal")
            .when(~C.board_live(F.col("search_status")), F.concat(F.lit("Avature SearchJobs HTTP "), F.col("search_status")))
            .when(~at_home(C.host_of(F.coalesce("search_url", F.lit("")))), "Avature SearchJobs redirected off provider"),
        )
        .when(F.col("provider") == "bamboohr", F.when(~(live & (host == C.host_of(F.col("url")))), "BambooHR careers endpoint unavailable or redirected"))
        .when(F.col("provider") == "ashby", F.when(~(live & has_jobs), "Ashby posting API unavailable"))
        .when(F.col("provider") == "greenhouse", F.when(~(live & has_jobs), "Greenhouse jobs API unavailable"))
        .otherwise(F.when(~live, http))
    )
    return asked.select(*candidates.columns, F.lit(True).alias("availability_checked"), error.isNull().alias("active"), F.col("status").alias("http_status"), error.alias("error"))


def best_board(candidates: DataFrame) -> DataFrame:
    """The best candidate of each site: active ones if there are any; none if all were found inactive."""
    rank = F.struct(
        (F.col("source_kind") == "website").cast("int").alias("source"),
        (F.col("discovery") == "raw").cast("int").alias("discovery"),
        F.size(F.filter(F.split(C.path_of(F.col("url")), "/"), lambda s: s != "")).alias("depth"),
        F.col("raw_url").rlike(r"^[^?#]*\?[^#]").cast("int").alias("query"),
        F.octet_length("url").alias("length"),
        F.col("url").alias("url"),
    )
    checked, active = F.coalesce("availability_checked", F.lit(False)), F.coalesce("active", F.lit(False))
    usable = candidates.withColumns({"usable": active | ~checked, "live": active, "rank": rank})
    best = F.min_by(F.struct("provider", "identifier", "url", "raw_url"), F.struct(~F.col("live"), "rank"))
    return usable.groupBy("site").agg(best.alias("best"), F.bool_or("live").alias("any_live"), F.bool_or(~checked).alias("any_open")).where("any_live or any_open").select("site", "best.*")


def _contact(found: DataFrame) -> tuple[Column, Column]:
    linked = F.filter(F.transform("emails", C.clean_email), lambda x: x.isNotNull())
    mails = C.distinct_fold(F.concat(linked, C.emails(F.col("text"))))
    numbers = F.filter(F.transform("phones", C.clean_phone), C.valid_phone)
    return mails, F.array_distinct(F.concat(numbers, C.phones(F.col("text"))))


def extract_records(sites: DataFrame) -> DataFrame:
    """One extraction record a fetched site. sites: site, input_url, status, final_url, body, error.

    The page itself is read, not its further pages, and its boards are not verified: ``extract_sites`` does both."""
    located = sites.withColumn("final_url", C.without_default_port(F.coalesce(F.nullif("final_url", F.lit("")), "input_url")))
    page = staged(with_marks(parsed(located, "body"), "body"), "pages")
    boards_ = board_candidates(page.select("site", F.lit(0).alias("seq"), F.col("final_url").alias("base"), "body", F.lit("website").alias("source_kind")))
    best = best_board(boards_.withColumns({"availability_checked": F.lit(False), "active": F.lit(False)}))
    links = page_links(page.select("site", F.col("final_url").alias("base"), "anchors"))
    by_kind = best_links(links).groupBy("site").agg(F.map_from_entries(F.collect_list(F.struct("kind", "url"))).alias("page_links"))
    merged = page.withColumns({c: F.col(f"structured.{c}") for c in STRUCTURED} | {"logo_link": _logo(), "n_pages": F.lit(1)})
    return _records(merged.join(by_kind, "site", "left"), links, best)


def _logo() -> Column:
    """The first image that can be reached, icons included."""
    candidates = F.transform("images", lambda x: F.trim(x["href"]))
    return F.try_element_at(F.filter(candidates, lambda x: (x != "") & ~x.startswith("data:")), F.lit(1))


def _records(full: DataFrame, links: DataFrame, best: DataFrame) -> DataFrame:
    """full: the fields of a site's root and what its pages say together; links: site, pos, url; best: each site's board."""
    legal = legal_form_names(full.select("site", "text")).groupBy("site").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "name"))), lambda x: x["name"]).alias("legal"))
    social = social_links(links).groupBy("site").agg(F.map_from_entries(F.collect_list(F.struct("network", "url"))).alias("social"))
    board = best.select("site", F.col("provider").alias("ats_provider"), F.col("identifier").alias("ats_identifier"), F.col("url").alias("ats_page"))
    full = full.join(social, "site", "left").join(board, "site", "left").join(legal, "site", "left")
    mails, numbers = _contact(full)
    low, url = F.lower("text"), F.col("final_url")
    parts = (F.size("anchors") > 0) | (F.size("emails") > 0) | (F.size("images") > 0)
    active = F.when(F.col("status") != 0, C.site_active(F.col("status"))).otherwise(F.col("error").isNull() & C.content_active(F.coalesce("body", F.lit("")), parts))
    # in steps: each value is computed once, and no projection becomes too large to compile
    full = full.select("*", C.host_of(url).alias("host"), C.path_of(url).alias("path"), low.contains("[email protected]").alias("email_protected"), F.lower("footer_text").contains("copyright").alias("footer_evidence"))
    full = full.select("*", markers.parked(F.col("marks"), F.col("decoded"), url).alias("is_hosting"), active.alias("is_alive"), absolute_url(F.col("logo_link"), url).alias("logo"))
    full = full.select("*", markers.platforms(F.col("marks"), F.col("decoded")).alias("website_platforms"), C.language(F.col("text")).alias("website_language"))
    full = full.select("*", mails.alias("all_emails"), numbers.alias("all_phones"))
    full = full.select("*", C.company_numbers(F.col("text")).alias("numbers"), C.postcodes(F.col("text")).alias("codes"))
    network = lambda n: F.try_element_at("social", F.lit(n)).alias(n)
    link = lambda k, name: F.try_element_at("page_links", F.lit(k)).alias(name)
    codes = F.slice(F.array_distinct(F.concat("codes", "postcodes")), 1, 25)
    extra = F.to_json(F.struct(F.col("numbers").alias("company_number"), codes.alias("post_code")))
    return full.select(
        "site",
        "input_url",
        F.col("final_url").alias("website"),
        F.nullif("status", F.lit(0)).alias("http_status"),
        (F.col("is_alive") & ~F.col("is_hosting")).alias("active"),
        F.col("is_hosting").alias("hosting"),
        F.when(F.col("host").endswith(".uk"), "GB").alias("location"),
        "website_language",
        F.when(F.col("logo_link").isNotNull(), F.nullif("logo", F.lit(""))).alias("logo_link"),
        *(network(n) for n in sorted(fixed.SOCIAL_DOMAINS)),
        link("contact_page", "contact_page"),
        link("careers_page", "careers_page"),
        link("vacancies_page", "vacancies_page"),
        link("terms_page", "terms_conditions_page"),
        link("privacy_page", "privacy_page"),
        "ats_provider",
        "ats_identifier",
        "ats_page",
        C.first_non_empty(F.col("legal_names"), F.col("names"), F.col("alternate_names"), F.col("legal")).alias("company_name"),
        C.description(F.col("title"), F.col("description"), F.col("path")).alias("company_description"),
        C.join_fold(F.col("all_emails")).alias("email"),
        "email_protected",
        F.array_join("all_phones", ", ").alias("phone"),
        extra.alias("extra_info"),
        F.when(F.col("status") == 200, F.col("ats_page").isNotNull()).alias("ats_traceable"),
        F.try_element_at("website_platforms", F.lit(1)).alias("website_platform"),
        "website_platforms",
        F.get("legal", F.lit(0)).alias("limited_company"),
        "footer_evidence",
        F.array_join("towns", "; ").alias("towns"),
        F.array_join("addresses", "; ").alias("addresses"),
        F.size("headings").alias("n_headings"),
        F.size("anchors").alias("n_anchors"),
        "n_pages",
        F.col("error").alias("error"),
        F.lit(11).alias("job_category_hint"),
    )


def extract_sites(sites: DataFrame, fetched: DataFrame) -> DataFrame:
    """One extraction record a site, from the pages that its crawl reaches, with its boards verified: the columns of
    ``extract_records``, ats_candidates (all, in the order of discovery) and ats_rejections (boards of career pages on other
    hosts, whose words are not those of the site).

    sites: site, input_url. fetched: url, status, final_url, body, error of everything that was fetched, boards' lists of jobs
    included; what is not among it could not be reached. URLs are compared by ``columns.url_key``, so a missing slash, the
    default port, a fragment or a capital in the host hides no page. A page that only holds or sells its domain is not crawled."""
    outcome = fetched.withColumns({"status": F.coalesce("status", F.lit(0)), "landed": C.without_default_port(F.coalesce(F.nullif("final_url", F.lit("")), "url"))})
    outcome = staged(outcome.withColumn("asked", C.url_key(F.col("url"))), "outcome")
    both = F.explode(F.array_distinct(F.array(F.col("asked"), C.url_key(F.col("landed"))))).alias("key")
    first = F.min_by(F.struct("landed", "body"), F.struct(F.col("asked") != F.col("key"), F.col("url"))).alias("p")
    bodies = outcome.where("body <> ''").select("*", both).groupBy("key").agg(first).select("key", F.col("p.landed").alias("base"), "p.body")
    read = staged(parsed(bodies, "body"), "pages")

    answers = outcome.groupBy("asked").agg(F.min_by(F.struct("status", "landed", "error"), F.struct(F.col("status") == 0, "status", "url")).alias("a"))
    root = sites.withColumn("wanted", C.with_scheme(F.col("input_url"))).withColumn("asked", C.url_key(F.col("wanted"))).join(answers, "asked", "left")
    missing = F.when(F.col("a").isNull(), "not fetched").otherwise(F.col("a.error"))
    root = root.select("site", "input_url", F.coalesce("a.landed", "wanted").alias("final_url"), F.coalesce("a.status", F.lit(0)).alias("status"), missing.alias("error"))
    root = root.withColumn("key", C.url_key(F.col("final_url"))).join(read.select("key", "body", "title", "description", "images"), "key", "left").drop("key")
    root = staged(with_marks(root, "body").withColumn("gated", markers.parked(F.col("marks"), F.col("decoded"), F.col("final_url"))), "roots")

    order = {kind: i for i, kind in enumerate(fixed.PAGE_LINKS)}
    links = best_links(page_links(read.select(F.col("key").alias("site"), "base", "anchors")))
    number = F.element_at(F.create_map(*(F.lit(x) for pair in order.items() for x in pair)), F.col("kind"))
    links = staged(links.select(F.col("site").alias("url"), number.alias("kind_order"), "kind", F.col("url").alias("target"), C.same_host(F.col("url"), F.col("site")).alias("follow")), "links")
    start = lambda gated: root.where(gated).select("site", F.col("final_url").alias("url"))
    state = staged(crawl_states(start("not gated"), links, key=C.url_key).unionByName(crawl_states(start("gated"), links, most=1, key=C.url_key)), "crawl")
    visits = state.select("site", F.posexplode("visited").alias("visit", "v")).select("site", "visit", F.col("v.label").alias("label"), C.url_key(F.col("v.url")).alias("key")).join(read, "key")
    merged = staged(merge_pages(visits), "merged")

    career = [F.lit("careers_page"), F.lit("vacancies_page")]
    careers = state.select("site", F.explode("found").alias("f")).where(F.col("f.kind").isin("careers_page", "vacancies_page")).select("site", F.col("f.kind").alias("kind"), F.col("f.target").alias("url"))
    careers = staged(with_board(careers), "careers")
    on_page = board_candidates(visits.select("site", F.col("visit").alias("seq"), "base", "body", F.col("label").alias("source_kind")))
    by_link = careers.where("board is not null").select("site", F.when(F.col("kind") == career[0], 1000).otherwise(1001).alias("seq"), F.lit(0).alias("pos"), "board.*", F.lit("href").alias("discovery"), F.lit("page_link").alias("source_kind"))

    # career pages on other hosts, and the same host's pages one step on
    own = root.where("not gated").select("site", F.col("final_url").alias("own_url"))
    outside = careers.where("board is null").join(own, "site").where(~C.same_host(F.col("url"), F.col("own_url")))
    outside = outside.groupBy("site", "url").agg(F.min(F.when(F.col("kind") == career[0], 100).otherwise(110)).alias("seq"))
    beyond = links.where(F.col("kind").isin("careers_page", "vacancies_page")).withColumnRenamed("url", "from").join(outside.select("site", C.url_key(F.col("url")).alias("from"), "seq"), "from")
    landed = read.select(F.col("key").alias("from"), F.col("base").alias("from_base"))
    beyond = beyond.join(landed, "from").where(C.same_host(F.col("target"), F.col("from_base"))).groupBy("site", F.col("target").alias("url")).agg(F.min(F.col("seq") + 1 + F.when(F.col("kind") == career[1], 1).otherwise(0)).alias("seq"))
    hops = outside.unionByName(beyond).groupBy("site", C.url_key(F.col("url")).alias("key")).agg(F.min("seq").alias("seq"), F.min_by("url", F.struct("seq", "url")).alias("url"))
    hops = hops.join(read, "key").select("site", "seq", F.col("url").alias("page_url"), "base", "body", "title", "headings")
    hops = staged(hops, "hops")
    words = merged.join(root.select("site", F.col("final_url").alias("url"), "title"), "site").select("site", "url", "title", "headings")
    judged = external_boards(words, hops.select("site", "seq", "page_url", "title", "headings")).select("site", "seq", "page_url", "accepted")
    found = staged(board_candidates(hops.withColumn("source_kind", F.lit("external_careers"))).join(judged, ["site", "seq"]), "external")
    refused = found.where("not accepted").groupBy("site", "page_url").agg(F.min("seq").alias("seq"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "url"))), lambda x: x["url"]).alias("ats"))
    refused = refused.groupBy("site").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", F.col("page_url").alias("page"), "ats"))), lambda x: F.struct(x["page"].alias("page"), x["ats"].alias("ats"))).alias("ats_rejections"))

    candidates = on_page.unionByName(found.where("accepted").drop("page_url", "accepted")).unionByName(by_link)
    candidates = staged(verified(staged(distinct_boards(candidates), "candidates"), outcome.select("url", "status", "final_url", "body")), "candidates")
    fields = ["provider", "identifier", "url", "raw_url", "discovery", "source_kind", "availability_checked", "active", "http_status", "error"]
    listed = candidates.groupBy("site").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "pos", *fields))), lambda x: F.struct(*(x[c].alias(c) for c in fields))).alias("ats_candidates"))

    moved = careers.groupBy("site").agg(F.collect_set(F.when(F.col("board").isNotNull(), F.col("kind"))).alias("moved"))
    kept = F.filter("found", lambda f: ~F.array_contains(F.coalesce("moved", F.array().cast("array<string>")), f["kind"]))
    by_kind = state.join(moved, "site", "left").select("site", F.map_from_entries(F.transform(kept, lambda f: F.struct(f["kind"], f["target"]))).alias("page_links"))
    nothing = {c: F.coalesce(F.col(c), F.array().cast(merged.schema[c].dataType)) for c in ("headings", "anchors", "emails", "phones", *STRUCTURED)}
    full = root.drop("gated").withColumn("logo_link", _logo()).join(merged, "site", "left").withColumns(nothing)
    full = full.withColumns({"text": F.coalesce("text", F.lit("")), "footer_text": F.coalesce("footer_text", F.lit("")), "n_pages": F.coalesce("n_pages", F.lit(0)), "images": F.coalesce("images", F.array().cast(root.schema["images"].dataType))})
    records = _records(full.join(by_kind, "site", "left"), _visited_links(visits), best_board(candidates))
    return records.join(listed, "site", "left").join(refused, "site", "left")


def _visited_links(visits: DataFrame) -> DataFrame:
    """site, pos, url of the links of all visited pages, in the order of visits."""
    each = visits.select("site", "visit", "base", F.posexplode("anchors").alias("place", "a"))
    return each.select("site", F.struct("visit", "place").alias("pos"), absolute_url(F.col("a.href"), F.col("base")).alias("url"))


STRUCTURED = ["names", "legal_names", "alternate_names", "postcodes", "towns", "addresses", "urls"]


def merge_pages(read: DataFrame) -> DataFrame:
    """read (site, visit and PAGE): one row a site with its pages' texts and lists in the order of visits. Headings are
    distinct, 25 at most; structured lists are only put together."""
    ordered = F.array_sort(F.collect_list(F.struct("visit", "text", "footer_text", "headings", "anchors", "emails", "phones", *(F.col(f"structured.{c}").alias(c) for c in STRUCTURED))))
    joined = lambda c: F.transform("p", lambda x: x[c])
    return (
        read.groupBy("site")
        .agg(ordered.alias("p"))
        .select(
            "site",
            F.size("p").alias("n_pages"),
            C.clean_text(F.array_join(joined("text"), " ")).alias("text"),
            C.clean_text(F.array_join(joined("footer_text"), " ")).alias("footer_text"),
            F.slice(F.array_distinct(F.flatten(joined("headings"))), 1, 25).alias("headings"),
            *(F.flatten(joined(c)).alias(c) for c in ("anchors", "emails", "phones", *STRUCTURED)),
        )
    )


def external_boards(sources: DataFrame, external: DataFrame) -> DataFrame:
    """external (site, page_url, title, headings, url of a candidate) with ``accepted``: the page's words overlap with those
    of the site (sources: site, url, title, headings); else the candidate is a rejection."""
    tokens = lambda url, title, headings: C.identity_tokens(C.host_of(url), title, F.array_join(F.slice(headings, 1, 3), " "))
    own = sources.select("site", tokens(F.col("url"), F.col("title"), F.col("headings")).alias("own"))
    theirs = external.withColumn("theirs", tokens(F.col("page_url"), F.col("title"), F.col("headings")))
    return theirs.join(own, "site").withColumn("accepted", F.arrays_overlap("own", "theirs")).drop("own", "theirs")


def poor_fetch(result: Column) -> Column:
    """Whether a result (struct of status, body, error) is worth a browser: none, an error, 202, 403, 429, 503, or blank."""
    blank = F.trim(F.coalesce(result["body"], F.lit(""))) == ""
    return result.isNull() | result["error"].isNotNull() | F.coalesce(result["status"], F.lit(0)).isin(202, 403, 429, 503) | blank


def chosen_fetches(tries: DataFrame) -> DataFrame:
    """The outcome of each URL (url, via, status, final_url, body, error, tries) from the tries that were made.

    tries: url, seq, via (direct, plain, browser), status, final_url, body, error. Of the direct tries the first counts that
    is not worth another one, else the last. A plain-http try replaces it after an https failure of the right kind, if it has
    a status or no error; a browser's replaces that if it is an error, 202, 403, 429, 503 or blank, and the browser got anything."""
    fields = ["via", "status", "final_url", "body", "error"]
    one = F.struct(*fields)
    retry = C.fetch_retry(F.col("error"))
    of = lambda via, x: F.when(F.col("via") == via, x)
    order = F.struct(retry, F.when(retry, -F.col("seq")).otherwise(F.col("seq")))
    by_url = tries.groupBy("url").agg(
        F.min_by(of("direct", one), of("direct", order)).alias("direct"),
        F.max_by(of("plain", one), of("plain", F.col("seq"))).alias("plain"),
        F.max_by(of("browser", one), of("browser", F.col("seq"))).alias("browser"),
        F.count("*").alias("tries"),
    )
    got = F.coalesce(F.col("plain.status"), F.lit(0)) != 0
    plain = C.http_downgrade(C.with_scheme(F.col("url")), F.col("direct.error")).isNotNull() & F.col("plain").isNotNull() & (got | F.col("plain.error").isNull())
    first = by_url.select("url", "browser", "tries", F.when(plain, F.col("plain")).otherwise(F.col("direct")).alias("r"))
    poor = poor_fetch(F.col("r"))
    better = F.col("browser").isNotNull() & (F.col("browser.error").isNull() | (F.coalesce(F.col("browser.body"), F.lit("")) != ""))
    chosen = F.when(poor & better, F.col("browser")).otherwise(F.coalesce("r", "browser"))
    return first.select("url", chosen.alias("r"), "tries").select("url", *(f"r.{c}" for c in fields), "tries")


LIVENESS = "dns_active boolean, http_active boolean, http_status int, final_url string, redirect_count int, redirect_chain array<string>, checked_at string, response_ms double, error string, attempts int"


def _asked(fetch: Callable[[str], dict], url: str, most: int = 10) -> dict:
    """What fetch says of url. An answer with a location is followed, ``most`` times at most: the last location is then
    only noted, and the answer that gave it counts."""
    chain = [url]
    while True:
        got = fetch(chain[-1])
        if got.get("status") not in fixed.REDIRECT_STATUS or not got.get("location"):
            break
        chain.append(pages.absolute(got["location"], chain[-1]) or got["location"])
        if len(chain) > most:
            return got | {"final_url": chain[-2], "redirect_chain": chain}
    own = {"final_url": got.get("final_url") or chain[-1], "redirect_chain": chain} if len(chain) > 1 and got.get("status") else {}
    return got | own


def probe(domains: DataFrame, fetch: Callable[[str], dict], attempts: int = 2, back_off: float = 0.25) -> DataFrame:
    """domains (domain) with the fields of a liveness result, by a function that fetches a URL: https, then http.

    fetch gives one response (status, location, error, dns_active), whose redirects are followed here, or the end of its own
    chain (status, final_url, redirect_chain: all URLs asked, the first included). A try without a status, or with 408, 425,
    429 or 5xx, is made again after back_off seconds times the tries so far; response_ms covers all of it, checked_at and
    error are the last try's. Of an https and an http error the later stays; an https error stays if http has an answer.
    The function runs in the tasks, for one domain after the other."""

    def one(domain: str) -> dict:
        began = time.perf_counter()
        for attempt in range(1, attempts + 1):
            checked = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
            got = _asked(fetch, f"https://{domain}")
            error = got.get("error")
            if got.get("dns_active", True) and not got.get("status"):
                got = _asked(fetch, f"http://{domain}")
                error = got.get("error") or error
            status = got.get("status")
            if got.get("dns_active", True) and status and status not in (408, 425, 429) and status < 500:
                break
            if attempt < attempts:
                time.sleep(back_off * attempt)
        chain = (got.get("redirect_chain") or []) if status else []
        active = bool(status) and (200 <= status < 400 or status in (401, 403))
        final = got.get("final_url") if status else None
        found = {"dns_active": bool(got.get("dns_active", True)), "http_active": active, "http_status": status, "final_url": final, "error": error, "attempts": attempt}
        return found | {"redirect_count": max(0, len(chain) - 1), "redirect_chain": chain or None, "checked_at": checked, "response_ms": round((time.perf_counter() - began) * 1000, 3)}

    return _mapped(domains, lambda rows: [one(domain) for (domain,) in rows], ["domain"], LIVENESS)
