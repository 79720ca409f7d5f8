"""Queries that go through files, documents and streams: whole tables are written in the shared folder and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import lists, results, site
from ..sources import readers, writers
from ..streaming import liveness
from . import catalog, views
from .views import inline, scan_results, table, texts

PARTS = 7
PAGES_A_SITE = 8
#: References of all kinds, as pages have them.
REFERENCES = [(0, "/a?b=1"), (1, "https://other.example/x"), (2, "//cdn.example/p"), (3, "?q=2")]
#: Arguments of a call, with a blank one.
ARGUMENTS = ["kestrel.example", " ", "https://osprey.example/jobs", "http://heron.example:80/"]
#: A body beyond the cap, in characters of two bytes.
LONG_BODY = ("https://long.example/", 1_100_000)


def _own_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result a domain."""
    return scan_results(spark, sf_dir).withColumn("domain", F.format_string("e%d.uk", "pos"))


def _result_rows(results_: DataFrame) -> DataFrame:
    return results_.select("domain", "dns_active", "http_active", "http_status", "response_ms", "error")


def _list_file(spark: SparkSession, sf_dir: str) -> str:
    """All customers as a text file in the order of their keys, with white space around them and blank lines between."""
    path = writers.fresh_path(spark, "list")
    lines = F.explode(F.array(F.concat(F.lit("  "), F.lower("c_name"), F.lit("\t")), F.lit(" "))).alias("value")
    ordered = table(spark, sf_dir, "customer").repartitionByRange("c_custkey").sortWithinPartitions("c_custkey")
    ordered.select(lines).write.text(path)
    return path


def domain_list_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.domain_list(spark, _list_file(spark, sf_dir))


def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines a list has, by each way to count them; a missing file has none."""
    path = _list_file(spark, sf_dir)
    counts = {"domains": readers.count_domains(spark, path), "lines": readers.count_lines(spark, path), "output": readers.count_output(spark, path), "missing": readers.count_output(spark, f"{path}-none")}
    return spark.range(1).select(*(F.lit(n).cast("long").alias(c) for c, n in counts.items()))


def resume_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left to do after a run that was begun anew and then resumed."""
    path, rows = writers.fresh_path(spark, "results"), _own_domains(spark, sf_dir)
    todo = lists.not_done(rows, readers.completed_domains(spark, path))  # no file yet: all
    for machine, resume in (("m1", False), ("m0", False), ("m2", True)):
        writers.write_results(_result_rows(todo.where(F.col("machine") == machine)), path, resume)
    return lists.not_done(rows, readers.completed_domains(spark, path)).select("domain", "machine")


def results_reread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results of two runs, from both of their files."""
    path, rows = writers.fresh_path(spark, "runs"), _own_domains(spark, sf_dir)
    for name, machines in (("results-1", ["m0", "m1"]), ("results-2", ["m2", "m3"])):
        writers.write_results(_result_rows(rows.where(F.col("machine").isin(machines))), f"{path}/{name}", False)
    return _result_rows(readers.scan_results(spark, f"{path}/results-*"))


def tolerant_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose faults are passed over: those of a result file and the properties of all events."""
    lines = inline(spark, views.RESULT_LINES, "line int, value string").select("value")
    read = readers.decode_tolerant(lines.unionByName(table(spark, sf_dir, "events").select(F.col("props").alias("value"))))
    return read.agg(F.count("*").alias("processed"), F.count("domain").alias("named"))


def run_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each machine's state, from its document; documents are replaced whole."""
    path = writers.fresh_path(spark, "states")
    for row in results.run_counters(catalog.records(spark, sf_dir), "machine").collect():  # a row a machine
        for processed in (0, row.processed):
            writers.write_document(spark, f"{path}/{row.machine}.json", row.asDict() | {"processed": processed})
    return readers.json_document(spark, f"{path}/*.json", readers.RUN_STATE).select("machine", "processed", "active", "inactive", "errors", "has_email", "last_domain")


def registry_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations as entries of a registry: some without a label or with a blank one, which do not count."""
    path, entries = writers.fresh_path(spark, "registry"), []
    for row in table(spark, sf_dir, "nation").collect():  # 25 rows at any scale
        entry = {c: row.n_name.lower() for c in ("key", "host", "input", "results", "log", "stats")}
        entry |= {"label": row.n_name} if row.n_nationkey % 5 > 1 else {"label": " "} if row.n_nationkey % 5 else {}
        entries.append(entry | ({"mode": "tail"} if row.n_nationkey % 2 else {}))
    writers.write_document(spark, path, {"servers": entries})
    return readers.registry(spark, path).select("key", "label", "mode")


def part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue cut into part files, which one after the other hold it in its order."""
    path, parted = writers.fresh_path(spark, "parts"), catalog.split_contiguous(spark, sf_dir)
    total = parted.count()
    size = -(-total // PARTS)
    writers.write_exact_parts(parted, path, "queue", [max(0, min(size, total - i * size)) for i in range(PARTS)])
    return readers.domain_list(spark, f"{path}/queue-*")


def sorted_list_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = writers.fresh_path(spark, "sorted")
    writers.write_unique_sorted(scan_results(spark, sf_dir), "domain", path)
    return readers.domain_list(spark, path)


def summary_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = writers.fresh_path(spark, "summary")
    writers.write_document(spark, path, catalog.merge_summary(spark, sf_dir).first().asDict())
    schema = "tested bigint, dns_active bigint, http_active bigint, inactive bigint, average_response_ms double, status_counts string"
    return readers.json_document(spark, path, schema)


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in the order of their input, from the lines of their file."""
    path = writers.fresh_path(spark, "records")
    writers.write_records(scan_results(spark, sf_dir).selectExpr("pos", "domain AS input_url", "http_active AS active", "http_status", "error"), path)
    item = F.from_json("domain", "input_url string, active boolean, http_status int, error string")
    return readers.domain_list(spark, path).select("pos", item.alias("r")).select("pos", "r.*")


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results, appended by a stream that is started twice on the same checkpoint."""
    out, place = writers.fresh_path(spark, "appended"), writers.fresh_path(spark, "place")
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")
    for _ in range(2):
        liveness.append_records(events.selectExpr(*(f"{x} AS {c}" for c, x in views.SCAN_COLUMNS.items())), out, place).awaitTermination()
    return spark.read.parquet(out).select("pos", "machine", "domain", "http_status")


def watched_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state document that a watch over a folder of results keeps; five results are still to come."""
    folder, place = writers.fresh_path(spark, "watched"), writers.fresh_path(spark, "place")
    rows = _own_domains(spark, sf_dir)
    writers.write_results(_result_rows(rows), folder, False)
    liveness.watch(spark, folder, f"{place}/state.json", f"{place}/checkpoint", rows.count() + 5).awaitTermination()
    state = readers.json_document(spark, f"{place}/state.json", readers.RUN_STATE)
    counts = F.transform(F.array_sort(F.map_entries("http_status_counts")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return state.select("total", "processed", "remaining", "active", "inactive", "errors", "status", F.array_join(counts, ",").alias("counts"))


def latest_pushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each machine's latest push (of the properties of its events, one a second) and whether it is 2 seconds old at most."""
    events = table(spark, sf_dir, "events")
    now = F.timestamp_seconds(F.lit(events.agg(F.coalesce(F.max("event_id"), F.lit(0))).first()[0]))
    pushes = events.select(F.format_string("m%d", F.col("event_id") % 4).alias("machine"), F.col("props").alias("payload"), F.timestamp_seconds("event_id").alias("at"))
    return results.latest_push(pushes, now, 2)


def file_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksum and size of one file a region, of its nations' names."""
    path = writers.fresh_path(spark, "files")
    nations = table(spark, sf_dir, "nation").repartition("n_regionkey").sortWithinPartitions("n_regionkey", "n_name")
    nations.select("n_regionkey", F.col("n_name").alias("value")).write.partitionBy("n_regionkey").text(path)
    region = F.regexp_extract("path", "n_regionkey=([0-9]+)", 1).cast("int").alias("n_regionkey")
    sums, sizes = readers.checksums(spark, path), readers.change_signatures(spark, path)
    return sums.join(sizes, "path").select(region, "sha256", "size")


def fetched_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of fetched bodies, in bytes: all pages, and one that is cut."""
    path = writers.fresh_path(spark, "fetches")
    pages = table(spark, sf_dir, "pages").selectExpr("page_id", "url", "200 AS status", "html AS body")
    long = inline(spark, [(-1, *LONG_BODY)], "page_id long, url string, n int").select("page_id", "url", F.lit(200).alias("status"), F.repeat(F.lit("é"), F.col("n")).alias("body"))
    pages.unionByName(long).drop("page_id").write.json(path)
    return readers.fetches(spark, path).select("url", "status", F.octet_length("body").alias("n_bytes"))


def argument_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs given as arguments, with a scheme and without a default port: some of one's own, and the nations'."""
    nations = [f"{r.n_name.lower().replace(' ', '-')}.example:443/{r.n_nationkey}" for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()]  # 25 rows at any scale
    return readers.argument_list(spark, [*ARGUMENTS, *nations]).withColumn("url", C.without_default_port(C.with_scheme(F.col("url"))))


def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue beside the results that came back in its order."""
    queue = lists.numbered(table(spark, sf_dir, "customer").selectExpr("c_custkey", "lower(c_name) AS domain"), "c_custkey").select("pos", "domain")
    back = lists.numbered(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_custkey").select("pos", F.col("c_acctbal").alias("result"))
    return lists.zipped(queue, back)


def _answer(url: str) -> dict:
    """What a made-up server says, by the number in its name: of the kinds, 1 answers by http only, 6 by neither, 7 sends
    round in a circle and 8 nine times to the next path."""
    scheme, _, rest = url.partition("://c")
    kind = int(rest.split(".")[0]) % 9
    if kind == 1:
        return {"status": None, "error": "tls: bad"} if scheme == "https" else {"status": 301, "final_url": url + "/"}
    if kind == 3:
        return {"dns_active": False, "error": "no such host"}
    if kind == 4:
        return {"status": 404, "final_url": url + "/b", "redirect_chain": [url, url + "/a", url + "/b"]}
    if kind == 6:
        return {"status": None, "error": "tls: bad" if scheme == "https" else "connection refused"}
    if kind == 7:
        return {"status": 302, "location": "/y" if url.endswith("/x") else "/x"}
    if kind == 8:
        at = int(url.rsplit("/", 1)[1]) if url.count("/") > 2 else 0
        return {"status": 307, "location": f"/{at + 1}"} if at < 9 else {"status": 200}
    return {"status": {0: 200, 2: 503, 5: 403}[kind], "final_url": url}


def probe_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probe of all customers' domains, against made-up servers."""
    domains = table(spark, sf_dir, "customer").select(F.format_string("c%d.uk", "c_custkey").alias("domain"))
    found = site.probe(domains, _answer, back_off=0)
    timed = (F.col("response_ms") >= 0) & F.col("checked_at").rlike("^[0-9-]{10}T[0-9:]{8}Z$")
    last = F.element_at("redirect_chain", -1).alias("last_location")
    return found.select("domain", "dns_active", "http_active", "http_status", "final_url", "redirect_count", last, "error", "attempts", timed.alias("timed"))


def url_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of all kinds as each page sees them, and whether they stay on its host."""
    kinds = F.array(*(F.struct(F.lit(n).alias("n"), F.lit(href).alias("href")) for n, href in REFERENCES))
    each = table(spark, sf_dir, "pages").select("page_id", "url", F.inline(kinds))
    seen = each.withColumn("target", site.absolute_url(F.col("href"), F.col("url")))
    return seen.select("page_id", "n", "target", C.same_host(F.col("target"), F.col("url")).alias("same_host"))


def merged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pages of a site say together; a site is eight pages in a row."""
    pages = table(spark, sf_dir, "pages").select((F.floor(F.col("page_id") / PAGES_A_SITE)).alias("site"), F.col("page_id").alias("visit"), "html")
    merged = site.merge_pages(site.parsed(pages))
    return merged.select("site", "n_pages", F.array_join("headings", " | ").alias("headings"), F.size("anchors").alias("n_anchors"), F.array_join(F.transform("anchors", lambda a: a["href"]), " ").alias("hrefs"))


def distinct_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first candidate of each URL of a site, whatever its case: users' events stand for what was found."""
    url = F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type"))
    found = table(spark, sf_dir, "events").select(F.col("user_id").alias("site"), F.col("event_id").alias("seq"), F.lit(0).alias("pos"), url.alias("url"))
    return site.distinct_boards(found).select("site", "seq", "url")


def contacts_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All addresses of a text in one, and the first contact of any kind."""
    found = texts(spark, sf_dir).select("doc_id", C.emails(F.col("text")).alias("emails"), C.phones(F.col("text")).alias("phones"))
    return found.select("doc_id", C.join_fold(F.col("emails")).alias("emails"), C.first_non_empty(F.col("emails"), F.col("phones")).alias("contact"))


def number_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a company number, in their details or beside them."""
    records = catalog.records(spark, sf_dir).withColumn("company_number", F.when(F.col("pos") % 5 == 3, "01234567").when(F.col("pos") % 5 == 4, " "))
    return results.run_counters(records, "machine").select("machine", "company_number")


NAMES = (
    "domain_list_read line_counts resume_from_files results_reread tolerant_counts run_documents registry_document part_files sorted_list_file summary_document record_lines stream_append "
    "watched_state latest_pushes file_checksums fetched_bodies argument_urls positional_zip probe_outcomes url_resolution merged_pages distinct_candidates contacts_joined number_presence"
).split()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: globals()[name] for name in NAMES}
