"""The library's queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import markers
from ..operators import lists, results, site
from ..sources import readers
from ..streaming import liveness
from . import views
from .views import inline, scan_results, sites, spread, table, texts

PARTS = 7
Query = Callable[[SparkSession, str], DataFrame]


def _queue(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    customers = table(spark, sf_dir, "customer")
    return lists.numbered(customers.selectExpr("c_custkey", "lower(c_name) AS domain"), "c_custkey").select("pos", "domain"), customers.count()


def split_contiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue, total = _queue(spark, sf_dir)
    return queue.withColumn("part", lists.contiguous_part(F.col("pos"), total, PARTS))


def split_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue, total = _queue(spark, sf_dir)
    return queue.withColumn("part", lists.balanced_part(F.col("pos"), total, PARTS))


def assign_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    servers = lists.numbered(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "n_nationkey")
    return lists.assign_zones(servers.select("pos", "n_name"), ["zone-a", "zone-b", "zone-a", "zone-c", "zone-d"])


def queue_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.tail(*_queue(spark, sf_dir), 100)


def queue_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.head(*_queue(spark, sf_dir), 100)


def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS domain", "o_orderpriority AS label")
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").selectExpr("l_orderkey AS domain")
    return lists.not_done(inputs, done)


def resume_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.skip(_queue(spark, sf_dir)[0], 40)


def merge_active_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.domains(scan_results(spark, sf_dir), True)


def merge_inactive_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.domains(scan_results(spark, sf_dir), False)


def merge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = results.summary(scan_results(spark, sf_dir))
    entries = F.transform(F.array_sort(F.map_entries("status_counts")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return one.withColumns({"status_counts": F.array_join(entries, ","), "average_response_ms": F.round("average_response_ms", 6)})


def merge_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.status_counts(scan_results(spark, sf_dir))


def http_active_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("http_status")
    return scan_results(spark, sf_dir).select("pos", C.site_active(status).alias("site_active"), C.board_live(status).alias("board_live"))


def retry_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_results(spark, sf_dir)
    again = C.scan_retry(F.col("dns_active"), F.col("http_status"))
    return found.where(again).select("pos", "domain", C.fetch_retry(F.col("error")).alias("fetch_retry"), C.http_downgrade(F.concat(F.lit("https://"), "domain", F.lit(":443/x")), F.col("error")).alias("downgrade"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_results(spark, sf_dir).selectExpr(
        "pos", "machine", "domain AS input_url", "http_active AS active", "error", "http_status", "CASE WHEN http_status = 200 THEN pos % 3 = 0 END AS ats_traceable",
        "CASE pos % 4 WHEN 0 THEN concat('info@', domain) WHEN 1 THEN ' ' END AS email", "CASE pos % 5 WHEN 0 THEN '[]' WHEN 1 THEN '[1]' END AS new_emails",
        "CASE pos % 3 WHEN 0 THEN '{\"company_number\":[\"01234567\"]}' WHEN 1 THEN '{\"company_number\":[]}' END AS extra_info",
        "CASE pos % 6 WHEN 0 THEN '/careers' WHEN 1 THEN '{}' WHEN 2 THEN 'null' END AS careers_page",
        "CASE pos % 4 WHEN 0 THEN 'wix' WHEN 1 THEN 'shopify' WHEN 2 THEN 'other' END AS website_platform",
        "CASE pos % 4 WHEN 0 THEN array('wix', 'wordpress') WHEN 1 THEN array('shopify') ELSE CAST(array() AS array<string>) END AS website_platforms",
    )


def run_state_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.run_counters(records(spark, sf_dir), "machine")


def platform_histogram_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.platform_histogram(records(spark, sf_dir))


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = results.run_counters(records(spark, sf_dir), "machine")
    return counted.selectExpr(
        "machine", "machine <> 'm3' AS available", "CASE WHEN machine = 'm1' THEN 'running' ELSE 'complete' END AS status", "processed + 10 AS total", "processed", "CAST(10 AS BIGINT) AS remaining",
        "active", "inactive", "errors", "processed / 100.0D AS rate_per_second", "concat('2026-01-0', substr(machine, 2), 'T00:00:00Z') AS started_at", "processed AS expected",
    )


def combined_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = results.combined(_states(spark, sf_dir))
    return one.withColumns({c: F.round(c, 6) for c in ("rate_per_second", "eta_seconds")})


def combined_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The machines' status maps, added up by key."""
    by_machine = scan_results(spark, sf_dir).groupBy("machine", F.coalesce(F.col("http_status").cast("string"), F.lit("none")).alias("key")).agg(F.count("*").alias("n"))
    states = by_machine.groupBy("machine").agg(F.map_from_entries(F.collect_list(F.struct("key", "n"))).alias("counts")).withColumn("available", F.col("machine") != "m3")
    return results.map_sums(states, "counts")


def throughput_eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = _states(spark, sf_dir).selectExpr("machine", "processed", "total", "CAST(substr(machine, 2) AS DOUBLE) * 10 AS seconds")
    return results.with_rates(states, "processed", "total", "seconds").withColumns({c: F.round(c, 6) for c in ("rate_per_second", "eta_seconds")})


def shard_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.shards_complete(_states(spark, sf_dir))


def _lines(spark: SparkSession) -> DataFrame:
    return inline(spark, views.RESULT_LINES, "line int, value string")


def jsonl_permissive_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bad line is an error, but nothing processed: the lines of a result file and the properties of all events."""
    read = readers.decode_permissive(_lines(spark).select("value").unionByName(table(spark, sf_dir, "events").select(F.col("props").alias("value"))))
    return read.agg(F.count_if(~F.col("is_bad")).alias("processed"), F.count_if("is_bad").alias("errors"))


def jsonl_strict_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The properties of all events, each of which has to be sound."""
    values = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    item = F.from_json("value", "k string, n bigint", {"mode": "FAILFAST"})
    return values.select("event_id", item.alias("item")).select("event_id", "item.k", "item.n")


def extract_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", F.posexplode(C.emails(F.col("text"))).alias("n", "email"))


def extract_phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", F.posexplode(C.phones(F.col("text"))).alias("n", "phone"))


def extract_postcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", F.posexplode(C.postcodes(F.col("text"))).alias("n", "postcode"))


def extract_company_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", F.posexplode(C.company_numbers(F.col("text"))).alias("n", "number"))


def language_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", C.language(F.col("text")).alias("language"))


def legal_form_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all documents, each a site of its own, and the inline texts."""
    documents = table(spark, sf_dir, "documents").selectExpr("concat('d', CAST(doc_id AS STRING)) AS site", "coalesce(text, '') AS text")
    return site.legal_form_names(documents.unionByName(inline(spark, views.LEGAL_TEXTS, "site string, text string")))


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site.parsed(table(spark, sf_dir, "pages")).select("page_id", "title")


def page_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site.parsed(table(spark, sf_dir, "pages")).select("page_id", F.posexplode("headings").alias("n", "heading"))


def page_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site.parsed(table(spark, sf_dir, "pages")).select("page_id", F.posexplode("anchors").alias("n", "a")).select("page_id", "n", "a.href", "a.text")


def footer_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site.parsed(table(spark, sf_dir, "pages")).select("page_id", "footer_text")


def page_parse_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = site.parsed(sites(spark, sf_dir))
    sizes = [F.size(c).alias(f"n_{c}") for c in ("headings", "anchors", "emails", "phones", "images")]
    return page.select("page_id", "title", "description", "og_image", F.length("text").alias("n_text"), "footer_text", *sizes)


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of all pages, each a site of its own, and the inline ones."""
    pages = site.parsed(table(spark, sf_dir, "pages").selectExpr("concat('p', CAST(page_id AS STRING)) AS site", "url AS base", "html"))
    return site.page_links(pages).unionByName(inline(spark, views.LINKS, "site string, pos int, url string"))


def page_links_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site.best_links(_links(spark, sf_dir))


def social_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site.social_links(_links(spark, sf_dir))


def description_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = site.parsed(sites(spark, sf_dir))
    return page.select("page_id", C.description(F.col("title"), F.col("footer_text"), F.lit("/")).alias("description"))


def hosting_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = site.with_marks(sites(spark, sf_dir))
    return page.select("page_id", markers.parked(F.col("marks"), F.col("decoded"), F.col("url")).alias("hosting"))


def content_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = site.parsed(sites(spark, sf_dir))
    parts = (F.size("anchors") > 0) | (F.size("emails") > 0) | (F.size("images") > 0)
    return page.select("page_id", C.content_active(F.col("html"), parts).alias("active"))


def platform_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = site.with_marks(sites(spark, sf_dir))
    return page.select("page_id", F.explode(markers.platform_scores(F.col("marks"), F.col("decoded"))).alias("s")).select("page_id", "s.platform", "s.score").where("score > 0")


def website_platforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = site.with_marks(sites(spark, sf_dir))
    return page.select("page_id", F.array_join(markers.platforms(F.col("marks"), F.col("decoded")), ",").alias("platforms"))


def board_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boards of all links: of all pages, of the customers' boards, and the inline ones."""
    own = inline(spark, [(i, link) for i, (link, *_) in enumerate(views.BOARDS)], "n long, link string")
    planted = table(spark, sf_dir, "customer").selectExpr("1000 + c_custkey AS n", f"{views.board_link('c_custkey')} AS link")
    anchors = site.parsed(table(spark, sf_dir, "pages").select("page_id", "html")).select((-1 - F.col("page_id")).alias("n"), F.explode("anchors.href").alias("link"))
    return site.with_board(own.unionByName(planted).unionByName(anchors), "link").select("n", "link", "board.provider", "board.identifier", "board.url")


def board_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boards on all pages, each with a link behind its end."""
    link = F.expr(views.board_link("page_id"))
    body = F.concat("html", F.lit('<p><a href="'), link, F.lit('">All our jobs</a></p>'))
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("site"), F.lit(0).alias("seq"), F.col("url").alias("base"), body.alias("body"), F.lit("website").alias("source_kind"))
    return site.board_candidates(pages)


def fetch_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcomes of all customers' tries, and of the inline ones."""
    own = inline(spark, views.TRIES, "url string, seq int, via string, status int, final_url string, body string, error string")
    made = inline(spark, [(i, *a) for i, a in enumerate(views.ANSWERS)], "seq int, kind int, via string, n int, status int, body string, error string")
    customers = table(spark, sf_dir, "customer").join(F.broadcast(made), F.expr("kind = c_custkey % 8"))
    final = F.concat(F.when(F.col("via") == "plain", "http").otherwise("https"), F.lit("://c"), F.col("c_custkey").cast("string"), F.lit(".uk/"))
    url = F.format_string("https://c%d.uk", F.col("c_custkey"))
    tries = customers.select(url.alias("url"), "seq", "via", "status", F.when(F.col("status") != 0, final).alias("final_url"), "body", "error")
    return site.chosen_fetches(own.unionByName(tries))


def _verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates of all customers and the inline ones."""
    customer = spread(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")
    candidates = inline(spark, views.CANDIDATES, "site string, provider string, identifier string, url string, raw_url string, discovery string, source_kind string")
    fetched = inline(spark, views.FETCHED, "url string, status int, final_url string, body string")
    of = lambda sql: spark.sql(sql.replace("FROM customer", "FROM {customer}"), customer=customer)
    return site.verified(candidates.unionByName(of(views.CUSTOMER_CANDIDATES.replace("{", "{{").replace("}", "}}"))), fetched.unionByName(of(views.CUSTOMER_FETCHED.replace("{", "{{").replace("}", "}}"))))


def board_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verified(spark, sf_dir).select("site", "url", "active", "http_status", "error")


def board_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site.best_board(_verified(spark, sf_dir)).select("site", "provider", "identifier", "url")


def structured_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").selectExpr("concat('p', CAST(page_id AS STRING)) AS site", "html")
    page = site.parsed(pages.unionByName(inline(spark, views.STRUCTURED_PAGES, "site string, html string")))
    keys = ["names", "legal_names", "alternate_names", "postcodes", "towns", "addresses", "urls", "types"]
    each = F.array(*(F.struct(F.lit(k).alias("key"), F.col(f"structured.{k}").alias("vals")) for k in keys))
    return page.select("site", F.explode(each).alias("e")).select("site", "e.key", F.posexplode("e.vals").alias("n", "value"))


def identity_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether host and path, and whether URL and what the page says of itself (title, first headings), share words."""
    page = site.parsed(table(spark, sf_dir, "pages").withColumn("host", C.host_of(F.col("url"))))
    own, path = C.identity_tokens(F.col("host")), C.path_of(F.col("url"))
    said = C.identity_tokens(F.col("title"), F.array_join(F.slice("headings", 1, 3), " "))
    return page.select(
        "page_id",
        F.array_join(F.array_sort(F.array_distinct(own)), " ").alias("tokens"),
        F.arrays_overlap(own, C.identity_tokens(path)).alias("overlap"),
        F.arrays_overlap(C.identity_tokens(F.col("host"), path), said).alias("overlap_of_texts"),
    )


def _page_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Pages linked by id: page p points to 3 p + 1, 3 p + 2 and 3 p + 3 as three of the kinds k0 to k6; each is a site's root."""
    ids = table(spark, sf_dir, "pages").select("page_id")
    roots = ids.selectExpr("page_id AS site", "concat('p', CAST(page_id AS STRING)) AS url")
    links = ids.select("page_id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("k")).selectExpr(
        "concat('p', CAST(page_id AS STRING)) AS url", "k AS kind_order", "concat('k', CAST((page_id + k) % 7 AS STRING)) AS kind", "concat('p', CAST(page_id * 3 + k AS STRING)) AS target"
    )
    return roots, links


def crawl_bfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site.crawl(*_page_graph(spark, sf_dir))


def registry_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS key", "s_name AS label")
    new = table(spark, sf_dir, "supplier").selectExpr("s_suppkey * 2 AS key", "concat(s_name, ' (new)') AS label")
    return lists.upsert(old, new)


def checksum_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.sha2(F.concat_ws("|", F.col("s_suppkey").cast("string"), "s_name"), 256).alias("sha256"))


def url_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return sites(spark, sf_dir).select("page_id", C.host_of(url).alias("host"), C.page_kind(url).alias("kind"), C.without_default_port(url).alias("bare"), F.when(C.host_of(url).endswith(".uk"), "GB").alias("location"))


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of the results so far, by a stream that has read all of them: same rows as the batch. The stream's
    result is a table in the shared folder, as its checkpoint is."""
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")
    read = stream.selectExpr(*(f"{x} AS {c}" for c, x in views.SCAN_COLUMNS.items()))
    return liveness.counted_by_stream(read)


def extract_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched = sites(spark, sf_dir).selectExpr("page_id AS site", "url AS input_url", "200 AS status", "url AS final_url", "html AS body", "CAST(NULL AS STRING) AS error")
    return site.extract_records(fetched)


def extract_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole sites: all pages, each a site's root, and the inline sites of several pages."""
    own = inline(spark, views.SITE_PAGES, "url string, status int, final_url string, body string, error string")
    roots = inline(spark, views.SITE_ROOTS, "site string, input_url string")
    pages = sites(spark, sf_dir).selectExpr("concat('p', CAST(page_id AS STRING)) AS site", "url AS input_url", "html AS body")
    fetched = own.unionByName(pages.selectExpr("input_url AS url", "200 AS status", "CAST(NULL AS STRING) AS final_url", "body", "CAST(NULL AS STRING) AS error"))
    return site.extract_sites(roots.unionByName(pages.select("site", "input_url")), fetched)


NAMES = (
    "split_contiguous split_balanced assign_zones queue_tail queue_head resume_anti_join resume_positional merge_active_list merge_inactive_list merge_summary merge_status_counts "
    "http_active_flags retry_candidates run_state_counters platform_histogram_zero_filled combined_rollup combined_status_counts throughput_eta shard_completion jsonl_permissive_counts "
    "jsonl_strict_decode extract_emails extract_phones extract_postcodes extract_company_numbers language_detect legal_form_names page_titles page_headings page_anchors footer_text "
    "page_parse_full page_links_best social_links description_build hosting_detect content_active platform_scores website_platforms fetch_choice board_match board_candidates board_verify board_best "
    "structured_data identity_overlap crawl_bfs registry_upsert checksum_rows url_functions stream_state extract_record extract_site"
).split()


def queries() -> dict[str, Query]:
    return {name: globals()[name] for name in NAMES}
