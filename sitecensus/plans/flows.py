"""Queries through streams with a state, growing files, fetch policies and tables that change as a whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns
from ..operators import fetching, lists, site, suffixes
from ..sources import incremental, readers, tail, versions, writers
from ..streaming import pushes
from . import storage, views
from .views import table

#: Seconds for which a push counts.
PUSH_TTL = 300
#: The policy of the fetch queries.
POLICY = {"attempts": 2, "timeout_ms": 8_000, "browser": "fallback"}


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")


def pushed_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's state at the end of the events, one a second: purchases and sign-ups are pushed, all else is pulled."""
    reports = _event_stream(spark, sf_dir).select(
        F.format_string("u%d", F.col("user_id")).alias("machine"), F.col("event_type").isin("purchase", "signup").alias("is_push"), F.col("props").alias("payload"), F.timestamp_seconds("event_id").alias("at")
    )
    return pushes.states_of(reports, f"{PUSH_TTL} seconds").select("machine", "source", "payload")


def tailed_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a growing folder of all results, which is looked at three times: before it is there, and after each half."""
    folder, state, place = (writers.fresh_path(spark, x) for x in ("tailed", "counts", "place"))
    results_ = views.scan_results(spark, sf_dir)
    tail.follow(spark, f"{folder}/*/part-*", state, place)
    for half in (0, 1):
        writers.write_results(storage._result_rows(results_.where(F.col("pos") % 2 == half)), f"{folder}/{half}", False)
        counts = tail.follow(spark, f"{folder}/*/part-*", state, place)
    return counts.groupBy("status").agg(*(F.sum(c).alias(c) for c in tail.COUNTS))


def redirect_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages' URLs, followed. A page redirects to the one before it; each 26th goes back to the end of a circle of 13,
    the one in the middle between them answers, some are unchanged (304), and some cannot be reached."""
    p = F.col("page_id")
    named = table(spark, sf_dir, "pages").select("page_id", F.concat("url", F.lit("&p="), p.cast("string")).alias("url"))
    to = F.when(p % 26 == 0, p + 12).otherwise(p - 1)
    status = F.when(p % 31 == 7, None).when(p % 26 == 13, 200).when(p % 29 == 5, 304).when(p % 2 == 0, 302).otherwise(301)
    target = named.select(F.col("page_id").alias("to"), F.col("url").alias("location"))
    responses = named.withColumn("to", to).join(target, "to", "left").select("url", status.cast("int").alias("status"), "location", F.when(p % 31 == 7, "connection reset").alias("error"))
    found = fetching.followed(named, responses)
    return found.join(named, "url").select("page_id", "http_active", "http_status", "final_url", "redirect_count", F.array_join("redirect_chain", " ").alias("chain"), "error")


def _customer_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.format_string("https://c%d.uk", F.col("c_custkey")).alias("url"))


def _answers(urls: DataFrame) -> DataFrame:
    kinds = views.inline(urls.sparkSession, views.ANSWERS, "kind int, via string, n int, status int, body string, error string")
    request = F.when(F.col("via") == "plain", F.regexp_replace("url", "^https", "http")).otherwise(F.col("url"))
    asked = urls.withColumn("kind", (F.col("c_custkey") % 8).cast("int")).join(F.broadcast(kinds), "kind")
    return asked.select("c_custkey", "url", request.alias("request_url"), "via", "n", "status", F.when(F.col("status") != 0, F.concat(request, F.lit("/"))).alias("final_url"), "body", "error")


def fetch_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome for each customer's URL once the policy has made all its requests."""
    urls = _customer_urls(spark, sf_dir)
    return site.chosen_fetches(fetching.replay(urls, _answers(urls), **POLICY))


def next_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is to be asked next when each ninth customer's URL has not been asked, and the others have once."""
    urls = _customer_urls(spark, sf_dir)
    first = _answers(urls).where("via = 'direct' and n = 0 and c_custkey % 9 <> 0")
    tries = first.select("url", F.lit(0).alias("seq"), "via", "status", "final_url", "body", "error")
    return fetching.next_requests(urls, tries, **POLICY)


def incremental_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of one folder of results a machine. After a first look m1's results are written anew, with those that were still
    missing: files_read is what the second look has read, files_kept what it has not."""
    folder, rows = writers.fresh_path(spark, "machines"), views.scan_results(spark, sf_dir)
    store = versions.Store(spark, writers.fresh_path(spark, "store"))

    def write(machine: str, which: str) -> None:
        chosen = rows.where(F.col("machine") == machine).where(which)
        writers.write_results(storage._result_rows(chosen).coalesce(1), f"{folder}/{machine}", False)

    def count(lines: DataFrame) -> DataFrame:
        item = F.from_json("value", readers.SCAN_RESULT)
        read = lines.select("path", item.alias("r")).select("path", "r.*")
        machine = F.regexp_extract("path", "/(m[0-9]+)/[^/]*$", 1).alias("machine")
        return read.groupBy("path", machine).agg(F.count("*").alias("processed"), F.count_if("http_active").alias("active"), F.count("error").alias("errors"))

    for machine in ("m0", "m1", "m2", "m3"):
        write(machine, "machine <> 'm1' or pos % 8 = 1")
    incremental.refresh(spark, f"{folder}/*/part-*", store, count)
    write("m1", "true")
    counts, kinds = incremental.refresh(spark, f"{folder}/*/part-*", store, count)
    total = counts.groupBy("machine").agg(*(F.sum(c).alias(c) for c in ("processed", "active", "errors")))
    return total.select("*", F.lit(kinds["new"] + kinds["changed"]).cast("long").alias("files_read"), F.lit(kinds["same"]).cast("long").alias("files_kept"))


def queue_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in a queue, of which the finished ones and then the urgent ones move on, each move in one commit."""
    store = versions.Store(spark, writers.fresh_path(spark, "queue"))
    store.commit({"queue": table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")}, 0)
    store.move("queue", "done", F.col("o_orderstatus") == "F")
    store.move("queue", "running", F.col("o_orderpriority") == "1-URGENT")
    tables = store.snapshot()[1]
    each = [rows.select("o_orderkey", F.lit(name).alias("place")) for name, rows in sorted(tables.items())]
    return each[0].unionByName(each[1]).unionByName(each[2])


def stored_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry's upsert, twice in a row on a stored table."""
    store = versions.Store(spark, writers.fresh_path(spark, "registry"))
    old = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS key", "s_name AS label")
    new = table(spark, sf_dir, "supplier").selectExpr("s_suppkey * 2 AS key", "concat(s_name, ' (new)') AS label")
    store.commit({"registry": old}, 0)
    for rows in (new.where("key % 3 = 0"), new.where("key % 3 <> 0")):
        store.update(lambda tables, rows=rows: {"registry": lists.upsert(tables["registry"], rows)})
    return store.snapshot()[1]["registry"]


def _written_lines(rows: DataFrame, label: str) -> str:
    """A folder with one folder of lines for each value of file, in the order of seq (rows: file, seq, value) through its part
    files in the order of their names, so that no task holds a whole file."""
    path = writers.fresh_path(rows.sparkSession, label)
    rows.repartitionByRange("file", "seq").sortWithinPartitions("file", "seq").select("file", "value").write.partitionBy("file").text(path)
    return path


def result_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a strict reader would stop in seven files of results, one a line for each event; some lines are broken or blank."""
    e = F.col("event_id")
    good = F.format_string('{"domain":"e%d.uk","http_active":%s}', e, (e % 2 == 0).cast("string"))
    value = F.when((e % 997 == 5) & (e % 7 != 3), '{"domain": ').when((e % 1009 == 8) & (e % 7 != 3), "  ").when((e % 1013 == 9) & (e % 7 == 4), '{"domain":"x","http_status":"ok"}').otherwise(good)
    lines = table(spark, sf_dir, "events").select(F.format_string("f%d", e % 7).alias("file"), e.alias("seq"), value.alias("value"))
    return readers.line_faults(spark, f"{_written_lines(lines, 'faults')}/*/part-*", whole=lambda path: F.regexp_extract(path, "file=(f[0-9])", 1))


def ordered_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results in the order of their files, one a machine, and of the lines in each."""
    rows = views.scan_results(spark, sf_dir)
    line = F.to_json(F.struct("domain", "dns_active", "http_active", "http_status", "response_ms", "error"), {"ignoreNullFields": "false"})
    path = _written_lines(rows.select(F.col("machine").alias("file"), F.col("pos").alias("seq"), line.alias("value")), "ordered")
    return readers.ordered_results(spark, f"{path}/*/part-*").select("pos", "domain", "http_active", "http_status")


def host_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest listed domain of each customer's host, and of all pages' hosts: a domain a supplier, some with one below it."""
    k = F.col("c_custkey") % 400
    forms = {0: "S%d.uk", 1: "www.s%d.uk", 2: "a.b.s%d.uk.", 3: "xs%d.uk", 4: "b.s%d.uk"}
    host = F.coalesce(*(F.when(F.col("c_custkey") % 6 == i, F.format_string(form, k)) for i, form in forms.items()), F.lit("uk"))
    hosts = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), host.alias("host"))
    hosts = hosts.unionByName(table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), columns.host_of(F.col("url")).alias("host")))
    s = F.col("s_suppkey")
    listed = F.array(F.format_string("s%d.uk", s), F.when(s % 3 == 0, F.format_string("B.s%d.uk", s)), F.when(s % 5 == 0, F.lit("com")))
    domains = table(spark, sf_dir, "supplier").select(F.explode(listed).alias("domain"))
    return suffixes.with_domain(hosts, domains).select("kind", "id", "host", "matched")


NAMES = "pushed_states tailed_counters redirect_chains fetch_replay next_requests incremental_counters queue_moves stored_upsert result_faults ordered_results host_domains".split()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: globals()[name] for name in NAMES}
