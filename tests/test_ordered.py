"""Strict reading in the order of files, hosts below listed domains, and links in buckets."""

import random

import pytest
from pyspark.sql import functions as F

from sitecensus.operators import site, suffixes
from sitecensus.sources import readers, writers

GOOD = '{"domain":"%s.uk","http_active":true}'


def put(folder, **files):
    for name, lines in files.items():
        (folder / f"results-{name}.jsonl").write_text("".join(line + "\n" for line in lines))
    return f"{folder}/results-*.jsonl"


def test_results_follow_the_order_of_files(spark, tmp_path):
    path = put(tmp_path, b=[GOOD % "b1", GOOD % "b0"], a=[GOOD % "a1"], **{"a b+c": [GOOD % "s"]})
    rows = readers.ordered_results(spark, path).orderBy("pos").collect()
    assert [(r.pos, r.domain, r.http_active) for r in rows] == [(0, "s.uk", True), (1, "a1.uk", True), (2, "b1.uk", True), (3, "b0.uk", True)]
    with pytest.raises(FileNotFoundError, match="no result files match"):
        readers.ordered_results(spark, f"{tmp_path}/none-*.jsonl")


def test_two_bad_files_name_the_first(spark, tmp_path):
    path = put(tmp_path, a=[GOOD % "a"], b=[GOOD % "b", "", "{"], c=["{"], d=[GOOD % "x" * 60_000], e=[])
    with pytest.raises(readers.BadLine, match="results-b.jsonl: blank") as told:
        readers.ordered_results(spark, path)
    assert (told.value.line, told.value.reason) == (2, "blank")
    found = {r.file[-7]: tuple(r)[1:] for r in readers.line_faults(spark, path).collect()}
    assert found == {"a": (1, 0, None, None), "b": (3, 2, 2, "blank"), "c": (1, 1, 1, "not a result"), "d": (1, 1, 1, "longer than 1 MiB")}


def test_line_numbers_over_many_splits(spark, tmp_path):
    lines = [GOOD % i for i in range(4000)]
    lines[3456] = lines[3999] = '{"http_status": "x"}'
    path = put(tmp_path, one=lines, two=lines[:3000])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 15
        found = {r.file[-9:-6]: tuple(r)[1:] for r in readers.line_faults(spark, path).collect()}
        assert found == {"one": (4000, 2, 3457, "not a result"), "two": (3000, 0, None, None)}
        put(tmp_path, one=lines[:3456])
        rows = readers.ordered_results(spark, path).orderBy("pos").collect()
        assert [r.domain for r in rows] == [f"{i}.uk" for i in [*range(3456), *range(3000)]]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("most", [1000, 0])
def test_longest_domain(spark, most):
    rng = random.Random(3)
    labels = ["a", "b", "c", "uk", "co"]
    name = lambda n: ".".join(rng.choice(labels) for _ in range(n))
    hosts = [name(rng.randrange(1, 7)) for _ in range(300)] + ["x.hot.uk"] * 200 + ["A.UK.", " co ", "", None, "..", "a..uk", ".".join(["z"] * 3000) + ".uk", "notuk"]
    listed = [name(rng.randrange(1, 4)) for _ in range(25)] + ["uk", "UK", "uk.", "", None, "hot.uk"]
    frame = spark.createDataFrame(list(enumerate(hosts)), "suffix_n long, host string")
    got = {r.suffix_n: r.matched for r in suffixes.with_domain(frame, spark.createDataFrame([(d,) for d in listed], "domain string"), most).collect()}
    plain = lambda h: h.strip(" ").lower().removesuffix(".")
    known = {plain(d) for d in listed if d} - {""}
    for i, host in enumerate(hosts):
        h = plain(host or "")
        assert got[i] == max((d for d in known if h and (h == d or h.endswith("." + d))), key=len, default=None), host
    assert len(got) == len(hosts)


@pytest.mark.parametrize("most", [1000, 0])
def test_no_hosts_and_no_domains(spark, most):
    none = spark.createDataFrame([], "domain string")
    some = spark.createDataFrame([("a.uk", 1)], "host string, n int")
    assert [tuple(r) for r in suffixes.with_domain(some, none, most).collect()] == [("a.uk", 1, None)]
    assert suffixes.with_domain(some.limit(0), spark.createDataFrame([("uk",)], "domain string"), most).collect() == []


def test_links_do_not_move_in_any_step(spark):
    links = spark.createDataFrame([(f"u{i}", k, f"k{k}", f"u{i * 3 + k + 1}") for i in range(200) for k in range(3)], "url string, kind_order int, kind string, target string")
    roots = spark.createDataFrame([(f"s{i}", f"u{i}") for i in range(20)], "site string, url string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = site.crawl_states(roots, links)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Bucketed: true") == plan.count("FileScan") == site.MOST_PAGES
    # only the states move: once a step
    assert plan.count("Exchange hashpartitioning") == site.MOST_PAGES and "out#" not in "".join(line for line in plan.splitlines() if "Exchange" in line)
    assert found.count() == 20


def test_bucketed_tables_are_dropped(spark):
    rows = writers.bucketed(spark.range(10).withColumn("k", F.col("id") % 3), "small", "k", 4)
    assert rows.count() == 10 and any(name.startswith("small_") for name in (t.name for t in spark.catalog.listTables()))
    kept, tables = list(writers._staged), list(writers._tables)
    writers._staged[:], writers._tables[:] = kept[-1:], tables[-1:]
    writers.drop_staged()
    writers._staged[:], writers._tables[:] = kept[:-1], tables[:-1]
    assert not any(t.name.startswith("small_") for t in spark.catalog.listTables())
