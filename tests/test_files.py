"""Readers, writers and the stream, over files."""

import json

import pytest
from pyspark.sql import functions as F

from sitecensus.operators import lists, results
from sitecensus.plans import views
from sitecensus.sources import readers, writers
from sitecensus.streaming import liveness


def test_domain_lists_and_counts(spark, tmp_path):
    path = tmp_path / "domains.txt"
    path.write_text("\n".join([" b.uk ", "", "a.uk", " ", "c.uk"]) + "\n")
    rows = readers.domain_list(spark, str(path)).orderBy("pos").collect()
    assert [(r.pos, r.domain) for r in rows] == [(0, "b.uk"), (1, "a.uk"), (2, "c.uk")]
    assert (readers.count_domains(spark, str(path)), readers.count_lines(spark, str(path)), readers.count_output(spark, str(tmp_path / "none"))) == (3, 5, 0)
    path.write_text("x" * (1 << 20))
    for read in (lambda: readers.lines(spark, str(path)).collect(), lambda: readers.count_domains(spark, str(path)), lambda: readers.count_lines(spark, str(path)), lambda: readers.count_output(spark, str(path))):
        with pytest.raises(Exception, match="1 MiB"):
            read()


def test_one_shared_folder_a_session(spark):
    assert writers.shared_dir(spark) == writers.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_split_rules(spark):
    queue = lists.numbered(spark.createDataFrame([(i, c) for i, c in enumerate("abcd")], "k long, domain string"), "k")
    part = lambda rule: [r.part for r in queue.withColumn("part", rule(F.col("pos"), 4, 3)).orderBy("pos").collect()]
    assert part(lists.contiguous_part) == [0, 0, 1, 1] and part(lists.balanced_part) == [0, 0, 1, 2]
    with pytest.raises(ValueError):
        lists.balanced_part(F.col("pos"), 4, 0)


def test_part_files(spark, tmp_path):
    parted = spark.createDataFrame([(0, 0, "a"), (0, 1, "b"), (1, 2, "c")], "part int, pos long, domain string")
    writers.write_exact_parts(parted, str(tmp_path), "queue", [2, 1, 0])
    read = lambda i: [r.value for r in spark.read.text(f"{tmp_path}/queue-{i}-of-3.txt").collect()]
    assert [read(1), read(2), read(3)] == [["a", "b"], ["c"], []]
    with pytest.raises(ValueError):
        writers.write_exact_parts(parted, str(tmp_path), "queue", [1, 2])


def test_many_part_files_keep_their_order(spark, tmp_path):
    rows = spark.range(5000).selectExpr("CAST(pmod(id * 7919, 5000) AS long) AS pos", "cast(id as string) AS domain").withColumn("part", lists.contiguous_part(F.col("pos"), 5000, 7))
    writers.write_parts(rows.repartition(9), str(tmp_path), "queue", 7)
    wanted = {r.pos: r.domain for r in rows.collect()}
    for part in range(7):
        got = [r.value for r in spark.read.text(f"{tmp_path}/queue-{part + 1}-of-7.txt").collect()]
        assert got == [wanted[pos] for pos in range(part * 715, min(5000, part * 715 + 715))]


@pytest.mark.parametrize("make", [lambda i: i, lambda i: i * i * i * 1_000_003 - 2**62, lambda i: -(2**63) + i if i % 2 else 2**63 - 1 - i, lambda i: i // 900 * 10**12])
def test_numbers_of_dense_sparse_extreme_and_repeated_keys(spark, make):
    keys = [make(i) for i in range(3000)] + [None] * 5
    frame = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    got = sorted((r.pos, r.k) for r in lists.numbered(frame, "k", range_rows=20).collect())
    assert [p for p, _ in got] == list(range(3005))
    assert [k for _, k in got] == [None] * 5 + sorted(k for k in keys if k is not None)
    text = frame.selectExpr("cast(k as string) AS k")
    assert [r.k for r in lists.numbered(text, "k").orderBy("pos").collect()] == [None] * 5 + sorted(str(k) for k in keys if k is not None)


def test_ranges_of_sparse_keys_share_rows(spark):
    frame = spark.range(20_000).selectExpr("xxhash64(id) AS k")
    ranges = frame.select(lists.key_ranges(frame, "k", 100).alias("r")).groupBy("r").count().collect()
    assert 100 < len(ranges) < 500 and max(r["count"] for r in ranges) < 500


def test_json_documents(spark, tmp_path):
    read = lambda: readers.json_document(spark, str(tmp_path / "x.json"), "a int, b string")
    assert read() is None
    for text, wanted in (('{"a": 1, "b": "x"}', [(1, "x")]), ('{\n "a": 1\n}', [(1, None)]), ('[{"a": 1}, {"b": "y"}]', [(1, None), (None, "y")]), ('{"a": ', None), ("", None), ("nothing", None), ('{"a": "word"}', None)):
        (tmp_path / "x.json").write_text(text)
        found = read()
        assert (found if found is None else [tuple(r) for r in found.collect()]) == wanted


def test_four_ways_to_read_bad_lines(spark):
    rows = spark.createDataFrame(views.RESULT_LINES, "line int, value string")
    assert [r.is_bad for r in readers.decode_permissive(rows).collect()].count(True) == 1
    assert [r.domain for r in readers.decode_tolerant(rows).collect()] == ["a.uk", "b.uk", "d.uk"]
    for bad in ("line <= 2", "line in (0, 3)"):
        with pytest.raises(Exception):
            readers.decode_strict(rows.where(bad)).collect()
    assert [r.http_status for r in readers.decode_strict(rows.where("line < 2")).collect()] == [200, 404]


def test_results_and_resume(spark, tmp_path):
    out = f"{tmp_path}/results"
    rows = readers.decode_strict(spark.createDataFrame([(l, v) for l, v in views.RESULT_LINES if l < 2], "line int, value string"))
    assert readers.completed_domains(spark, out).count() == 0
    writers.write_results(rows, out, False)
    writers.write_results(rows, out, True)
    lines = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert len(lines) == 4 and all("redirect_chain" not in x and "final_url" in x for x in lines)
    done = readers.completed_domains(spark, out)
    inputs = spark.createDataFrame([("a.uk",), ("z.uk",), ("z.uk",)], "domain string")
    assert [r.domain for r in lists.not_done(inputs, done).collect()] == ["z.uk", "z.uk"]
    one = results.summary(readers.scan_results(spark, out)).first()
    assert (one.tested, one.http_active, one.inactive, one.average_response_ms, one.status_counts) == (4, 2, 2, 6.25, {"200": 2, "404": 2})
    nothing = results.summary(readers.scan_results(spark, out).where("false")).first()
    assert (nothing.tested, nothing.average_response_ms) == (0, 0.0)


def test_documents_and_registry(spark, tmp_path):
    path = f"{tmp_path}/state.json"
    for value in ({"a": 1}, {"a": 2}):
        writers.write_document(spark, path, value)
    assert json.loads((tmp_path / "state.json").read_text()) == {"a": 2}
    entry = {k: k for k in ("key", "label", "host", "input", "results", "log", "stats")}
    for whole in ([entry, {"key": "x"}], {"servers": [entry | {"mode": "tail"}]}):
        (tmp_path / "registry.json").write_text(json.dumps(whole))
        rows = readers.registry(spark, str(tmp_path / "registry.json")).collect()
        assert [(r.key, r.mode) for r in rows] == [("key", "auto" if isinstance(whole, list) else "tail")]
    (tmp_path / "blob").write_bytes(b"abc")
    assert readers.checksums(spark, str(tmp_path / "blob")).first().sha256.startswith("ba7816bf")
    assert readers.change_signatures(spark, str(tmp_path / "blob")).first().size == 3


def test_staged_tables_are_dropped(spark):
    rows = writers.staged(spark.range(5), "five")
    path = rows.inputFiles()[0].rsplit("/", 1)[0]
    assert rows.count() == 5 and readers.exists(spark, path)
    writers.drop_staged()
    assert not readers.exists(spark, path) and writers._staged == []


def test_unique_sorted(spark, tmp_path):
    writers.write_unique_sorted(spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("C",)], "d string"), "d", f"{tmp_path}/list")
    assert [r.value for r in spark.read.text(f"{tmp_path}/list").orderBy(F.input_file_name(), F.monotonically_increasing_id()).collect()] == ["C", "a", "b"]


def test_watch_resumes_from_its_checkpoint(spark, tmp_path):
    folder = tmp_path / "results"
    folder.mkdir()
    state = tmp_path / "state.json"
    good = [v for _, v in views.RESULT_LINES]

    def run():
        liveness.watch(spark, str(folder), str(state), str(tmp_path / "checkpoint"), 6).awaitTermination()
        return json.loads(state.read_text())

    (folder / "1.jsonl").write_text("\n".join(good))
    first = run()
    assert (first["processed"], first["active"], first["remaining"], first["status"]) == (3, 1, 3, "running")
    (folder / "2.jsonl").write_text("\n".join(good))
    second = run()
    assert (second["processed"], second["http_status_counts"], second["status"]) == (6, {"200": 2, "404": 2, "none": 2}, "complete")


def test_a_run_with_another_total_is_another_run(spark, tmp_path):
    folder = tmp_path / "results"
    folder.mkdir()
    (folder / "1.jsonl").write_text("\n".join(v for _, v in views.RESULT_LINES))

    def run(total):
        liveness.watch(spark, str(folder), str(tmp_path / "state.json"), str(tmp_path / "checkpoint"), total).awaitTermination()
        return json.loads((tmp_path / "state.json").read_text())

    assert [run(6)[k] for k in ("total", "processed", "batch")] == [6, 3, 0]
    # all results count again towards the new total, from the first batch; the old run goes on where it was
    assert [run(3)[k] for k in ("total", "processed", "batch", "status")] == [3, 3, 0, "complete"]
    (folder / "2.jsonl").write_text('{"domain": "z.uk", "dns_active": true}')
    assert [run(6)[k] for k in ("total", "processed", "batch")] == [6, 4, 1]


def test_roll_up_of_machines(spark):
    rows = [("a", True, "complete", 5, 1, 2.0, "2026-01-02"), ("b", True, "complete", 6, 0, 1.0, "2026-01-03"), ("c", False, "running", 100, 9, 9.0, "2026-01-01")]
    states = spark.createDataFrame(rows, "machine string, available boolean, status string, processed long, remaining long, rate_per_second double, started_at string")
    total = results.combined(states).first()
    assert (total.status, total.processed, total.remaining, total.rate_per_second, total.started_at) == ("complete", 11, 1, 3.0, "2026-01-01")
    assert results.combined(states.where("not available")).first().status == "complete"
    assert results.combined(states.where("false")).first().status == "running"


def test_zones(spark):
    servers = spark.range(20).withColumnRenamed("id", "pos")
    assert [r.zone for r in lists.assign_zones(servers, ["x", " y ", "x", "z"]).orderBy("pos").collect()] == ["x"] * 8 + ["y"] * 8 + ["z"] * 4
    with pytest.raises(Exception, match="too few"):
        lists.assign_zones(servers, ["x", "y"]).collect()


def test_pushes(spark):
    rows = [("m", "{1}", "2026-01-01 00:00:00"), ("m", "{2}", "2026-01-01 00:00:10"), ("n", "[]", "2026-01-01 00:00:10"), ("o", "{3}", "2026-01-01 00:00:00")]
    pushes = spark.createDataFrame(rows, "machine string, payload string, at string").withColumn("at", F.to_timestamp("at"))
    got = results.latest_push(pushes, F.lit("2026-01-01 00:00:25").cast("timestamp")).collect()
    assert {r.machine: (r.payload, r.fresh) for r in got} == {"m": ("{2}", True), "o": ("{3}", False)}


def test_a_stream_appends_each_row_once(spark, tmp_path):
    folder, out, place = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    folder.mkdir()
    for n in (1, 2, 3):
        (folder / f"{n}.jsonl").write_text("\n".join(v for _, v in views.RESULT_LINES))
        liveness.append_records(liveness.result_stream(spark, str(folder)), out, place).awaitTermination()
        assert spark.read.parquet(out).count() == 3 * n
    spark.read.parquet(out).limit(1).write.mode("overwrite").parquet(f"{out}/batch=7")  # what a batch that died has left
    assert spark.read.parquet(out).select("batch").distinct().count() == 4
    (tmp_path / "file").write_text("x")
    (folder / "4.jsonl").write_text(views.RESULT_LINES[0][1])
    query = liveness.append_records(liveness.result_stream(spark, str(folder)), str(tmp_path / "file"), place, tries=2)
    with pytest.raises(Exception):
        query.awaitTermination()
    assert json.loads((tmp_path / "checkpoint" / "blocked.json").read_text())["status"] == "blocked"
    liveness.append_records(liveness.result_stream(spark, str(folder)), out, place).awaitTermination()
    assert spark.read.parquet(out).where("batch = 3").count() == 1
