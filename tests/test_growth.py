"""What keeps tasks small: no key that many rows share, no value that is asked for once a row."""

from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from sitecensus.operators import site
from sitecensus.plans import flows
from sitecensus.sources import readers
from sitecensus.streaming import pushes


@pytest.fixture
def plain_joins(spark):
    """Joins by shuffles as they are planned, of eight parts."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_part(rows):
    return max(Counter(r.part_ for r in rows.withColumn("part_", F.spark_partition_id()).collect()).values())


def test_candidates_without_a_second_question_are_spread(spark, plain_joins):
    url = "concat('https://c', id, '.recruitee.com/')"
    candidates = spark.range(400).selectExpr("concat('s', id) AS site", "if(id % 50 = 7, 'avature', 'recruitee') AS provider", f"{url} AS url", f"{url} AS raw_url")
    fetched = spark.range(400).selectExpr(f"{url} AS url", "200 AS status", f"{url} AS final_url", "'x' AS body")
    found = site.verified(candidates, fetched)
    assert largest_part(found) < 200
    assert found.where("active and http_status = 200").count() == 392


class Counted:
    """A value of a state that counts its calls."""

    def __init__(self, calls):
        self.value, self.calls = None, calls

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def clear(self):
        self.calls.append("clear")
        self.value = None


def test_a_machine_asks_for_its_state_once_a_batch():
    calls, timers = [], []
    handle = SimpleNamespace(getValueState=lambda *_: Counted(calls), listTimers=lambda: iter(timers[:]), deleteTimer=timers.remove, registerTimer=timers.append)
    processor = pushes.FreshPush(1000, True)
    processor.init(handle)
    report = lambda us, push: SimpleNamespace(is_push=push, payload=f"{us}", us=us)
    shown = list(processor.handleInputRows(("m",), iter([report(i * 1000, i % 3 == 0) for i in (5, 3, 9, 1, 8, *range(10, 200))]), None))
    assert [(r.version, r.source, r.payload) for r in shown] == [(1, "push", "198000")]
    assert timers == [199] and len(calls) < 10
    again = list(processor.handleInputRows(("m",), iter([report(300_000, True), report(301_000, False), report(250_000, True)]), None))
    assert [(r.version, r.source, r.payload) for r in again] == [(2, "push", "300000")] and timers == [301]
    expired = list(processor.handleExpiredTimer(("m",), None, None))
    assert [(r.version, r.source, r.payload) for r in expired] == [(3, "pull", "301000")]


def test_sites_whose_crawl_has_ended_move_no_more(spark, plain_joins):
    roots = spark.range(400).selectExpr("id AS site", "concat('p', id) AS url")
    links = spark.createDataFrame([("p3", 1, "k", "q3"), ("q3", 1, "l", "r3")], "url string, kind_order int, kind string, target string")
    found = site.crawl_states(roots, links)
    assert largest_part(found) < 200
    assert {r.site: [v.url for v in r.visited] for r in found.collect()} == {i: [f"p{i}"] if i != 3 else ["p3", "q3", "r3"] for i in range(400)}


def test_a_file_of_lines_is_written_by_many_tasks(spark, plain_joins):
    line = F.format_string('{"domain":"d%d.uk"}', "id")
    rows = spark.range(4000).select(F.lit("m0").alias("file"), F.col("id").alias("seq"), F.when(F.col("id") == 3000, "{").otherwise(line).alias("value"))
    path = f"{flows._written_lines(rows, 'lines')}/*/part-*"
    assert spark.read.text(path).groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0] < 2000
    found = readers.line_faults(spark, path, whole=lambda path: F.regexp_extract(path, "file=(m[0-9])", 1)).collect()
    assert [tuple(r) for r in found] == [("m0", 4000, 1, 3001, "not a result")]
    good = readers.ordered_results(spark, f"{flows._written_lines(rows.where('seq <> 3000'), 'lines')}/*/part-*")
    assert {r.pos: r.domain for r in good.collect()} == {i: f"d{i if i < 3000 else i + 1}.uk" for i in range(3999)}
