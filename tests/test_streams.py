"""Streams with a state or a source of their own."""

import json
import time

import pytest
from pyspark.sql import functions as F

from sitecensus.sources import tail
from sitecensus.streaming import pushes

REPORTS = "machine string, is_push boolean, payload string, at timestamp"


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, pushes.ROCKSDB)
    yield
    spark.conf.set(name, before)


def reports(spark, folder, rows):
    """Add a file of reports: machine, is_push, payload, seconds."""
    made = spark.createDataFrame(rows, "machine string, is_push boolean, payload string, s double").selectExpr("machine", "is_push", "payload", "timestamp_millis(CAST(s * 1000 AS BIGINT)) AS at")
    made.coalesce(1).write.mode("append").parquet(folder)


def shown(spark, path):
    return {r.machine: (r.source, r.payload) for r in pushes.latest_states(spark.read.schema(f"{pushes.STATE}, batch int").parquet(path)).collect()}


def test_a_push_expires_by_event_time_and_after_a_restart(spark, tmp_path, rocksdb):
    folder, out, place = (str(tmp_path / x) for x in ("in", "out", "place"))
    spark.createDataFrame([], REPORTS).write.parquet(folder)

    def run():
        stream = spark.readStream.schema(REPORTS).parquet(folder)
        pushes.kept_states(pushes.fresh_states(stream, "20 seconds"), out, place).awaitTermination()

    reports(spark, folder, [("a", True, '{"n": 1}', 100.0), ("a", False, "old", 50.0), ("a", False, "pulled", 99.0), ("b", True, '{"n": 2}', 95.0), ("c", False, "c", 90.0)])
    run()
    assert shown(spark, out) == {"a": ("push", '{"n": 1}'), "b": ("push", '{"n": 2}'), "c": ("pull", "c")}
    reports(spark, folder, [("c", False, "later", 116.0)])
    run()  # 21 seconds after b's push, 16 after a's; b never had a pulled state
    assert shown(spark, out) == {"a": ("push", '{"n": 1}'), "b": ("none", None), "c": ("pull", "later")}
    reports(spark, folder, [("a", True, '{"n": 3}', 119.0), ("c", False, "last", 121.0), ("b", True, "[1]", 121.0), ("b", True, "{broken", 121.0), ("b", True, "", 121.0)])
    run()  # a's new push moves its timer; pushes that are no object do not count
    assert shown(spark, out) == {"a": ("push", '{"n": 3}'), "b": ("none", None), "c": ("pull", "last")}
    reports(spark, folder, [("c", False, "end", 139.0)])
    run()
    assert shown(spark, out)["a"] == ("push", '{"n": 3}')  # exactly as old as it may be
    reports(spark, folder, [("c", False, "over", 139.001)])
    run()
    assert shown(spark, out)["a"] == ("pull", "pulled")


def test_a_push_expires_by_the_clock(spark, tmp_path, rocksdb):
    folder, out, place = (str(tmp_path / x) for x in ("in", "out", "place"))
    reports(spark, folder, [("a", True, "{}", 100.0), ("a", False, "pulled", 99.0)])
    changes = pushes.fresh_states(spark.readStream.schema(REPORTS).parquet(folder), "3 seconds", by_event_time=False)
    query = changes.writeStream.outputMode("update").foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}")).option("checkpointLocation", place).trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            time.sleep(1)
            rows = spark.read.schema(f"{pushes.STATE}, batch int").parquet(out).orderBy("version").collect() if (tmp_path / "out").exists() else []
            if len(rows) > 1:
                break
        assert [(r.version, r.source, r.payload) for r in rows] == [(1, "push", "{}"), (2, "pull", "pulled")]
    finally:
        query.stop()


def test_payloads(spark):
    rows = [("{}", True), ('{"a": [1]}', True), ("[]", False), ("1", False), ("{", False), ("", False), (None, False), (json.dumps({"x": "y" * 999_991}), True), (json.dumps({"x": "y" * 999_992}), False)]
    found = spark.createDataFrame(rows, "payload string, wanted boolean").where(pushes.acceptable(F.col("payload")) != F.col("wanted"))
    assert found.count() == 0


def line(domain, status=None, active=False, error=None):
    return json.dumps({"domain": domain, "http_status": status, "http_active": active, "error": error}) + "\n"


def counted(frame):
    return {(r.file.rsplit("/", 1)[1], r.status): (r.processed, r.active, r.errors) for r in frame.collect()}


def test_a_growing_file_is_followed_across_restarts(spark, tmp_path):
    path, other = tmp_path / "m1.jsonl", tmp_path / "m2.jsonl"
    run = lambda: counted(tail.follow(spark, f"{tmp_path}/*.jsonl", f"{tmp_path}/state", f"{tmp_path}/place", range_mb=0.0001))
    assert run() == {}
    whole = line("a.uk", 200, True) + "\n" + line("b.uk", None, False, "no such host") + "{broken\n" + line("é.uk", 200, True)
    half = line("c.uk", 404)
    path.write_text(whole + half[:20])
    assert run() == {("m1.jsonl", "200"): (2, 2, 0), ("m1.jsonl", "none"): (1, 0, 1)}
    assert run() == {("m1.jsonl", "200"): (2, 2, 0), ("m1.jsonl", "none"): (1, 0, 1)}  # the half line is held back
    path.write_text(whole + half)
    other.write_text(line("d.uk", 200, True) * 50)
    wanted = {("m1.jsonl", "200"): (2, 2, 0), ("m1.jsonl", "none"): (1, 0, 1), ("m1.jsonl", "404"): (1, 0, 0), ("m2.jsonl", "200"): (50, 50, 0)}
    assert run() == wanted
    path.write_text(line("a.uk", 500))  # begun anew
    assert run() == {("m1.jsonl", "500"): (1, 0, 0), ("m2.jsonl", "200"): (50, 50, 0)}
    path.write_text("")
    other.write_text(line("d.uk", 200, True) * 51)
    assert run() == {("m2.jsonl", "200"): (51, 51, 0)}
    path.write_text(whole)
    assert run() == {("m1.jsonl", "200"): (2, 2, 0), ("m1.jsonl", "none"): (1, 0, 1), ("m2.jsonl", "200"): (51, 51, 0)}


def test_ranges_cut_no_line(tmp_path):
    path = tmp_path / "lines"
    lines = ["x" * n for n in (0, 1, 5, 0, 300, 2, 7, 64, 63, 65, 0, 0, 9)]
    path.write_text("".join(f"{x}\n" for x in lines) + "half")
    for size in (1, 2, 7, 64, 10_000):
        reader = tail.TailReader(str(path), size)
        parts = reader.partitions({}, reader.latestOffset())
        found = sorted(row for p in parts for row in reader.read(p))
        assert [v for *_, v in found] == lines and not any(r for _, _, r, _ in found)
    assert tail.sizes(str(tmp_path / "none")) == {} and tail.sizes(str(tmp_path / "no" / "*.x")) == {}


def test_a_line_of_a_mebibyte_is_an_error(tmp_path):
    path = tmp_path / "long"
    path.write_text("x" * (3 << 20) + "\n")
    reader = tail.TailReader(str(path), 1 << 25)
    with pytest.raises(ValueError, match="1 MiB"):
        list(reader.read(reader.partitions({}, reader.latestOffset())[0]))
